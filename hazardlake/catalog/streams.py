"""Streaming queries over envelope files, run until all available input is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.catalog.quality import ALERTS, DETECTIONS, READING, SENSORS, ZONE_GAPS
from hazardlake.catalog.registry import query
from hazardlake.catalog.windows import COMPOSITE, SENSOR_AGGREGATES, SLIDE, WINDOW, edges, windowed
from hazardlake.functions.values import as_json
from hazardlake.operators import access, lake_checks, windows as w
from hazardlake.session import new_folder
from hazardlake.sinks import keyed, messages, tables
from hazardlake.sources import streams as src
from hazardlake.streaming import queries as sq

RECEIVED = "2024-02-01 00:00:00"
CLOSED = """janela_fim <= least((SELECT max(event_time) FROM fx_sensor), (SELECT max(event_time) FROM fx_hotspot),
 (SELECT max(event_time) FROM fx_weather)) - INTERVAL 2 MINUTES"""


def iso():
    return F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp")


def envelopes(rows, *fields):
    return rows.select(F.col("grid_id").alias("key"), as_json("grid_id", iso(), *fields).alias("value"))


def sensor_envelopes(rows):
    return envelopes(rows, "temp_celsius", "humidity_pct", "wind_kmh", "hotspot_count", "risk_score", "source")


def detection_envelopes(rows):
    """Half of the senders use the newer name of the radiative power field."""
    old = F.col("satelite") == "VIIRS S-NPP"
    return envelopes(rows, "latitude", "longitude", F.col("bright_ti4").alias("brightness"),
                     F.when(old, F.col("frp")).alias("frp"), F.when(~old, F.col("frp")).alias("frp_mw"), "confidence")


def weather_envelopes(rows):
    return envelopes(rows, "temp_max", "humidity_avg", "wind_max_kmh", "precipitation_mm")


def topic(t, name: str, rows) -> str:
    folder = new_folder(t.spark, name)
    messages.write_folder(rows, folder)
    return folder


def finish(frame, checkpoint: str, **options) -> None:
    """Run over the available input, with at most one state partition per core."""
    spark = frame.sparkSession
    partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    sq.start(frame, checkpoint, once=True, state_partitions=partitions, **options).awaitTermination()


def composite_frame(t):
    def stream(name, rows):
        return src.envelope_folder(t.spark, topic(t, name, rows))

    return sq.composite_stream(
        src.decode_sensors(stream("sensor-events", sensor_envelopes(t.sensor))),
        src.decode_detections(stream("satellite-hotspots", detection_envelopes(t.hotspot))),
        src.decode_weather(stream("weather-data", weather_envelopes(t.weather))), WINDOW, SLIDE)


def composite_output(t) -> str:
    out = new_folder(t.spark, "composite")
    finish(composite_frame(t), new_folder(t.spark, "checkpoint"), path=out)
    return out


# --- decoding ----------------------------------------------------------------------------

@query("src_01", """SELECT grid_id, event_time, round(temp_celsius, 6) AS temp_celsius, humidity_pct, wind_kmh, hotspot_count,
 risk_score, source FROM fx_sensor""")
def decode(t):
    rows = src.envelope_batch(t.spark, topic(t, "sensor-events", sensor_envelopes(t.sensor)))
    return src.decode_sensors(rows).select(
        "grid_id", "event_time", "temp_celsius", "humidity_pct", "wind_kmh", "hotspot_count", "risk_score", "source")


def simulated_then_stations(t, frame_of, **options) -> str:
    """Two runs with one checkpoint: the station events arrive after the first run ended."""
    first, late = (t.sensor.filter(F.col("source") == s) for s in ("iot_simulator_v1", "ipma_real"))
    folder, checkpoint = topic(t, "sensor-events", sensor_envelopes(first)), new_folder(t.spark, "checkpoint")
    finish(frame_of(src.envelope_folder(t.spark, folder)), checkpoint, **options)
    messages.write_folder(sensor_envelopes(late), folder)
    finish(frame_of(src.envelope_folder(t.spark, folder)), checkpoint, **options)
    return folder


@query("src_02", """SELECT source, CAST(CASE source WHEN 'ipma_real' THEN 1 ELSE 0 END AS BIGINT) AS batch_id, count(*) AS events
FROM fx_sensor GROUP BY 1, 2""")
def only_new_data(t):
    out = new_folder(t.spark, "events")
    simulated_then_stations(t, src.decode_sensors, sink=sq.partitioned_sink(out))
    counts = t.spark.read.parquet(out).groupBy("source", "batch_id").agg(F.count("*").alias("events"))
    return counts.withColumn("batch_id", F.col("batch_id").cast("bigint"))


# --- validating ingestion ---------------------------------------------------------------------

def received():
    return F.lit(RECEIVED).cast("timestamp")


@query("src_03", f"WITH {SENSORS} SELECT {READING} FROM checked WHERE reason = ''")
def sensor_ingestion(t):
    root = new_folder(t.spark, "ingest")
    rows = src.envelope_folder(t.spark, topic(t, "sensor-events", sensor_envelopes(t.sensor)))
    finish(sq.sensor_candidates(rows), new_folder(t.spark, "checkpoint"), sink=sq.sensor_sink(root, received()))
    stored = keyed.read_latest(t.spark, f"{root}/sensor_readings")
    return stored.select("grid_id", "hour_bucket", "event_time", "source", "temp_celsius", "humidity_pct", "wind_kmh",
                         "hotspot_count", "risk_score")


@query("src_04", f"""WITH {DETECTIONS} SELECT grid_id, event_time, 'nasa_firms' AS source, brightness AS temp_celsius,
 round(frp_mw, 6) AS risk_score, 1 AS hotspot_count, round(latitude, 6) AS latitude FROM checked WHERE reason = ''""")
def detection_ingestion(t):
    root = new_folder(t.spark, "ingest")
    gaps = t.hotspot.withColumn("grid_id", F.expr(ZONE_GAPS))
    rows = src.envelope_folder(t.spark, topic(t, "satellite-hotspots", detection_envelopes(gaps)))
    finish(sq.detection_candidates(rows), new_folder(t.spark, "checkpoint"), sink=sq.detection_sink(root, received()))
    stored = keyed.read_latest(t.spark, f"{root}/detection_readings")
    return stored.select("grid_id", "event_time", "source", "temp_celsius", "risk_score", "hotspot_count", "latitude")


@query("str_06", f"""WITH {ALERTS} SELECT 'sensor_readings' AS stored, count(*) AS linhas FROM checked WHERE reason = ''
UNION ALL SELECT 'fire_alerts', count(*) FROM alerts UNION ALL SELECT 'quarantine', count(*) FROM checked WHERE reason <> ''
UNION ALL SELECT 'rejected_event_detail', count(*) FROM checked WHERE reason <> ''
UNION ALL SELECT 'pipeline_latency', count(*) FROM checked WHERE reason = ''
UNION ALL SELECT 'data_quality', 2""")
def restart(t):
    """Ingestion stopped and started again: every table holds each event once."""
    root = new_folder(t.spark, "ingest")
    simulated_then_stations(t, sq.sensor_candidates, sink=sq.sensor_sink(root, received()))
    names = ("sensor_readings", "fire_alerts", "quarantine", "rejected_event_detail", "pipeline_latency", "data_quality")
    return access.union_all([
        tables.scan(t.spark, f"{root}/{n}").agg(F.lit(n).alias("stored"), F.count("*").alias("linhas")) for n in names])


# --- windows and joins ---------------------------------------------------------------------------

@query("str_01", f"""WITH {windowed('fx_sensor', 'x')}, a AS (SELECT max(event_time) - INTERVAL 2 MINUTES AS m FROM fx_sensor
 WHERE source = 'iot_simulator_v1'), b AS (SELECT max(event_time) - INTERVAL 2 MINUTES AS m FROM fx_sensor)
SELECT w AS janela_inicio, w + INTERVAL 12 HOURS AS janela_fim, grid_id, {SENSOR_AGGREGATES} FROM x, a, b
WHERE w + INTERVAL 12 HOURS <= b.m AND (source = 'iot_simulator_v1' OR w + INTERVAL 12 HOURS > a.m) GROUP BY w, grid_id""")
def late_events(t):
    """Station events that arrive after their window closed are dropped."""
    out = new_folder(t.spark, "windows")
    simulated_then_stations(
        t, lambda rows: edges(w.sensor_windows(src.decode_sensors(rows), WINDOW, SLIDE, "2 minutes")), path=out)
    return t.spark.read.parquet(out)


@query("str_03", COMPOSITE + f"SELECT * FROM composite WHERE {CLOSED}")
def composite_stream(t):
    return t.spark.read.parquet(composite_output(t))


@query("str_04", COMPOSITE + f"""SELECT count(*) AS linhas, count(*) FILTER ({CLOSED}) AS emitidas,
 count(*) FILTER (NOT ({CLOSED})) AS pendentes, max(janela_fim) FILTER ({CLOSED}) AS ultima FROM composite""")
def closed_windows(t):
    """Windows of the batch table that the stream has closed, and those it still holds."""
    emitted = t.spark.read.parquet(composite_output(t)).select("janela_inicio", "grid_id", F.lit(True).alias("seen"))
    batch = w.composite(t.sensor, t.detection_events, t.weather, WINDOW, SLIDE)
    return batch.join(emitted, ["janela_inicio", "grid_id"], "left").agg(
        F.count("*").alias("linhas"), F.count("seen").alias("emitidas"),
        F.count_if(F.col("seen").isNull()).alias("pendentes"),
        F.max(F.when(F.col("seen"), F.col("janela_fim"))).alias("ultima"))


@query("str_07", COMPOSITE + f"""SELECT 'archive' AS sink, count(*) AS linhas FROM composite WHERE {CLOSED}
UNION ALL SELECT 'preview', least(15, count(*)) FROM composite WHERE {CLOSED}""")
def fan_out(t):
    archive, preview = fanned_out(t)
    return access.union_all([
        t.spark.read.parquet(path).agg(F.lit(name).alias("sink"), F.count("*").alias("linhas"))
        for name, path in (("archive", archive), ("preview", preview))])


def fanned_out(t) -> tuple[str, str]:
    """One query, two sinks: the archive and a stored copy of the 15-row preview."""
    archive, preview = new_folder(t.spark, "archive"), new_folder(t.spark, "preview")
    store = sq.partitioned_sink(preview)

    def keep_preview(batch, batch_id):
        store(batch.orderBy("janela_inicio", "grid_id").limit(15), batch_id)

    finish(composite_frame(t), new_folder(t.spark, "checkpoint"),
           sink=sq.fan_out([sq.partitioned_sink(archive), keep_preview]))
    return archive, preview


@query("snk_01", COMPOSITE + f"SELECT grid_id, count(*) AS linhas, min(janela_inicio) AS primeira FROM composite WHERE {CLOSED} GROUP BY 1")
def parquet_append(t):
    return t.spark.read.parquet(composite_output(t)).groupBy("grid_id").agg(
        F.count("*").alias("linhas"), F.min("janela_inicio").alias("primeira"))


@query("snk_02", COMPOSITE + f"SELECT * FROM composite WHERE {CLOSED} ORDER BY janela_inicio, grid_id LIMIT 15")
def preview(t):
    return t.spark.read.parquet(fanned_out(t)[1]).drop("batch_id")


@query("lk_03", COMPOSITE + f"""SELECT count(*) AS rows, count(DISTINCT grid_id) AS zones, round(min(risco_composto), 6) AS risk_min,
 round(max(risco_composto), 6) AS risk_max FROM composite WHERE {CLOSED}""")
def streaming_output(t):
    return lake_checks.streaming_output(t.spark.read.parquet(composite_output(t)))
