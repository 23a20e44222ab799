"""Expectations, row validation, quarantine, metric points and stored readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake import constants as k
from hazardlake.catalog.fixtures import LEVEL
from hazardlake.catalog.registry import query
from hazardlake.functions import calendar
from hazardlake.operators import access, quality as q, stats
from hazardlake.session import new_folder
from hazardlake.sinks import keyed, messages
from hazardlake.sources import lake
from hazardlake.streaming.queries import partitioned_sink

AS_OF = "2024-02-01 00:00:00"


def reason_sql(column: str, low, high) -> str:
    return (f"CASE WHEN {column} IS NULL THEN '{column}_null' WHEN {column} NOT BETWEEN {low} AND {high} "
            f"THEN concat('{column}_out_of_range(', CAST({column} AS STRING), ')') END")


def present_reason_sql(column: str, low, high) -> str:
    return (f"CASE WHEN {column} NOT BETWEEN {low} AND {high} "
            f"THEN concat('{column}_out_of_range(', CAST({column} AS STRING), ')') END")


# concat_ws leaves nulls out, so absent reasons vanish
SENSOR_REASONS = "concat_ws(',', " + ", ".join((
    reason_sql("temp_celsius", -10, 60), reason_sql("humidity_pct", 0, 100), reason_sql("wind_kmh", 0, 150),
    reason_sql("risk_score", 0, 100), "CASE WHEN grid_id IS NULL THEN 'grid_id_null' END")) + ")"
DETECTION_REASONS = "concat_ws(',', " + ", ".join((
    *(f"CASE WHEN {c} IS NULL THEN '{c}_null' END" for c in ("grid_id", "latitude", "longitude", "frp_mw")),
    present_reason_sql("frp_mw", 0, 5000), reason_sql("brightness", 200, 500),
    present_reason_sql("latitude", 36.9, 42.2), present_reason_sql("longitude", -9.5, -6.2),
    "CASE WHEN grid_id IS NULL OR grid_id IN ('PT-UNKNOWN', '') "
    "THEN concat('grid_id_unknown(', coalesce(grid_id, 'None'), ')') END")) + ")"

# The zone is missing for some detections, so that the mandatory and unknown-zone rules fire.
ZONE_GAPS = "CASE confidence WHEN 'l' THEN NULL WHEN 'n' THEN 'PT-UNKNOWN' ELSE grid_id END"
SENSORS = f"checked AS (SELECT *, {SENSOR_REASONS} AS reason FROM fx_sensor)"
DETECTIONS = f"""gaps AS (SELECT * EXCLUDE (grid_id), {ZONE_GAPS} AS grid_id, frp AS frp_mw, bright_ti4 AS brightness
 FROM fx_hotspot), checked AS (SELECT *, {DETECTION_REASONS} AS reason FROM gaps)"""


def checked_sensors(t):
    return q.with_sensor_reasons(t.sensor)


def checked_detections(t):
    zone = F.when(F.col("confidence") == "n", "PT-UNKNOWN").when(F.col("confidence") == "h", F.col("grid_id"))
    return q.with_detection_reasons(t.detection_events.withColumn("grid_id", zone))


def joined_reasons():
    return F.array_join(q.REASONS, ",").alias("reason")


# --- suites -----------------------------------------------------------------------------

def suite_sql(ranges, required) -> str:
    rows = [f"SELECT '{c}_between' AS expectation, count({c}) AS evaluated, "
            f"count(*) FILTER ({c} NOT BETWEEN {lo} AND {hi}) AS unexpected FROM fx_sensor" for c, lo, hi in ranges]
    rows += [f"SELECT '{c}_not_null', count(*), count(*) FILTER ({c} IS NULL) FROM fx_sensor" for c in required]
    return "SELECT *, unexpected = 0 AS passed FROM (" + " UNION ALL ".join(rows) + ")"


@query("dq_01", suite_sql((("temp_celsius", -10, 60), ("humidity_pct", 0, 100), ("wind_kmh", 0, 150)),
                          ("grid_id", "risk_score")))
def live_suite(t):
    return q.expectation_results(t.sensor)


@query("dq_02", suite_sql((("temp_celsius", -10, 60), ("humidity_pct", 0, 100), ("wind_kmh", 0, 200),
                           ("risk_score", 0, 100)), ("grid_id", "temp_celsius", "humidity_pct", "wind_kmh")))
def ad_hoc_suite(t):
    return q.expectation_results(t.sensor, k.AD_HOC_SUITE)


def batched_sensors(t):
    return t.sensor.withColumn("batch", F.floor(F.col("event_id") / 100))


@query("dq_03", """SELECT batch, round(success_percent, 6) AS success_percent, successful_expectations, failed_expectations,
 total_rows FROM fx_quality""")
def suite_statistics(t):
    return q.suite_statistics(batched_sensors(t), by=("batch",))


@query("dq_04", """SELECT round((checks - failed) * 100.0 / checks, 2) AS success_percent, checks - failed AS successful_cells,
 failed AS failed_cells FROM (SELECT count(*) * 6 AS checks,
 count(*) FILTER (temp_celsius IS NULL OR temp_celsius NOT BETWEEN -10 AND 60)
 + count(*) FILTER (humidity_pct IS NULL OR humidity_pct NOT BETWEEN 0 AND 100)
 + count(*) FILTER (wind_kmh IS NULL OR wind_kmh NOT BETWEEN 0 AND 150)
 + count(*) FILTER (risk_score IS NULL OR risk_score NOT BETWEEN 0 AND 100)
 + count(*) FILTER (grid_id IS NULL) + count(*) FILTER (risk_score IS NULL) AS failed FROM fx_sensor)""")
def cell_score(t):
    return q.cell_score(t.sensor)


# --- rows ---------------------------------------------------------------------------------

@query("dq_05", f"WITH {SENSORS} SELECT event_id, reason, reason = '' AS valid FROM checked")
def sensor_reasons(t):
    return checked_sensors(t).select("event_id", joined_reasons(), q.is_valid().alias("valid"))


@query("scl_13", f"WITH {SENSORS} SELECT event_id, reason FROM checked WHERE reason <> ''")
def reason_strings(t):
    return q.split(checked_sensors(t).withColumn("reason", joined_reasons()))[1].select("event_id", "reason")


@query("dq_06", f"WITH {DETECTIONS} SELECT event_id, reason, reason = '' AS valid FROM checked")
def detection_reasons(t):
    return checked_detections(t).select("event_id", joined_reasons(), q.is_valid().alias("valid"))


@query("dq_07", f"""WITH {SENSORS} SELECT event_id // 100 AS batch, count(*) AS processed,
 count(*) FILTER (reason = '') AS valid, count(*) FILTER (reason <> '') AS rejected FROM checked GROUP BY 1""")
def batch_counts(t):
    return q.batch_counts(q.with_sensor_reasons(batched_sensors(t)), ("batch",))


QUARANTINE_COLUMNS = f"""coalesce(grid_id, 'UNKNOWN') AS grid_id, TIMESTAMP '{AS_OF}' AS rejected_at,
 strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS original_timestamp"""


def iso_text():
    return F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def sensor_record(t):
    checked = q.with_sensor_reasons(t.sensor.withColumn("timestamp", iso_text()))
    return q.sensor_quarantine(checked.filter(~q.is_valid()), as_of())


@query("dq_08", f"""WITH {SENSORS} SELECT {QUARANTINE_COLUMNS}, source, round(temp_celsius, 6) AS temp_celsius,
 humidity_pct, wind_kmh, risk_score, reason AS rejection_reasons FROM checked WHERE reason <> ''""")
def sensor_quarantine(t):
    return sensor_record(t).withColumn(q.REASONS, F.array_join(q.REASONS, ","))


def detection_record(t):
    checked = checked_detections(t).withColumn("timestamp", iso_text())
    return q.detection_quarantine(checked.filter(~q.is_valid()), as_of())


@query("dq_09", f"""WITH {DETECTIONS} SELECT {QUARANTINE_COLUMNS}, 'nasa_firms_real' AS source,
 round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, round(frp_mw, 6) AS frp_mw, brightness, confidence,
 reason AS rejection_reasons FROM checked WHERE reason <> ''""")
def detection_quarantine(t):
    return detection_record(t).withColumn(q.REASONS, F.array_join(q.REASONS, ","))


# --- metric points ----------------------------------------------------------------------------

@query("dq_10", """SELECT batch, _time, source, round(success_percent, 6) AS success_percent, successful_expectations,
 failed_expectations, total_rows FROM fx_quality""")
def quality_points(t):
    return q.quality_points(batched_sensors(t), "event_time", by=("batch",))


@query("dq_11", f"""WITH {SENSORS} SELECT TIMESTAMP '{AS_OF}' AS _time, grid_id, reason, count(*) AS count FROM checked
 WHERE reason <> '' GROUP BY grid_id, reason""")
def rejection_points(t):
    return q.rejection_points(sensor_record(t))


@query("dq_12", f"""WITH {SENSORS} SELECT TIMESTAMP '{AS_OF}' AS _time, grid_id, source,
 strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS original_timestamp, round(temp_celsius, 6) AS temp_celsius,
 humidity_pct, wind_kmh, risk_score, reason AS rejection_reasons FROM checked WHERE reason <> ''""")
def rejection_details(t):
    return q.rejection_details(sensor_record(t))


@query("dq_13", f"""WITH {SENSORS} SELECT TIMESTAMP '{AS_OF}' AS _time, 'sensor-events' AS topic, grid_id,
 round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(event_time)) / 1000.0, 6) AS latency_ms FROM checked WHERE reason = ''""")
def latency_points(t):
    valid = q.split(checked_sensors(t))[0]
    return q.latency_points(valid, calendar.latency_ms(F.col("event_time"), as_of()), k.SENSOR_TOPIC, as_of())


@query("dq_14", f"""WITH {SENSORS}, per AS (SELECT source, event_id // 100 AS batch, count(*) AS processed,
 count(*) FILTER (reason = '') AS valid, count(*) FILTER (reason <> '') AS rejected FROM checked GROUP BY 1, 2)
SELECT source, batch, CAST(sum(processed) OVER w AS BIGINT) AS total_processed,
 CAST(sum(valid) OVER w AS BIGINT) AS total_valid, CAST(sum(rejected) OVER w AS BIGINT) AS total_rejected
FROM per WINDOW w AS (PARTITION BY source ORDER BY batch)""")
def running_totals(t):
    per_batch = q.batch_counts(q.with_sensor_reasons(batched_sensors(t)), ("source", "batch"))
    return q.running_totals(per_batch, "source", "batch", ("processed", "valid", "rejected"))


def histogram_sql(column: str, bins: int) -> str:
    return f"""SELECT '{column}' AS variable, CAST(b AS INT) AS bin, round(lo + (hi - lo) / {bins} * b, 6) AS lower,
 round(lo + (hi - lo) / {bins} * (b + 1), 6) AS upper, (SELECT count(*) FROM fx_sensor
   WHERE least({bins - 1}, floor(({column} - lo) / (hi - lo) * {bins})) = b AND {column} IS NOT NULL) AS n
FROM (SELECT min({column}) AS lo, max({column}) AS hi FROM fx_sensor), generate_series(0, {bins - 1}) g(b)"""


@query("dq_15", " UNION ALL ".join(histogram_sql(c, 30) for c in ("temp_celsius", "humidity_pct", "wind_kmh")))
def histograms(t):
    return stats.histogram(t.sensor, ("temp_celsius", "humidity_pct", "wind_kmh"), 30)


# --- stored readings, alerts, messages -------------------------------------------------------------

def readings(t):
    """Valid sensor events in table layout; the base view has no coordinates."""
    located = t.sensor.withColumns({c: F.lit(None).cast("double") for c in ("latitude", "longitude")})
    return access.sensor_rows(q.split(q.with_sensor_reasons(located))[0])


READING = """grid_id, strftime(date_trunc('hour', event_time), '%Y-%m-%dT%H:%M:%S') AS hour_bucket, event_time, source,
 round(temp_celsius, 6) AS temp_celsius, humidity_pct, wind_kmh, hotspot_count, risk_score"""


@query("snk_05", f"""WITH {SENSORS} SELECT {READING} FROM checked WHERE reason = ''""")
def keyed_upsert(t):
    """A first batch, the same batch once more, then a batch with each key twice, the true values last."""
    path = new_folder(t.spark, "sensor_readings")
    outdated = readings(t).withColumns({"risk_score": F.lit(-1.0), "arrival": F.lit(2)})
    keyed.append_versions(outdated, path, 0)
    keyed.append_versions(outdated, path, 0)
    current = readings(t).withColumn("arrival", F.lit(1))
    keyed.append_versions(current.unionByName(outdated.withColumn("arrival", F.lit(0))), path, 1)
    return keyed.read_latest(t.spark, path).drop("dia_evento", "batch_id", "arrival", "latitude", "longitude", "kind")


@query("snk_06", f"""WITH {SENSORS} SELECT {READING} FROM checked WHERE reason = ''
 AND event_time >= (SELECT max(event_time) FROM fx_sensor) - INTERVAL 72 HOURS""")
def retention(t):
    written = readings(t).withColumn("written_at", F.col("event_time"))
    newest = t.sensor.agg(F.max("event_time")).scalar()
    return access.within_retention(written, "written_at", newest).drop("written_at", "latitude", "longitude", "kind")


ALERT_ID = """sha256(concat_ws('|', grid_id, CAST(epoch_us(event_time) AS STRING), source, CAST(risk_score AS STRING),
 CAST(temp_celsius AS STRING), CAST(humidity_pct AS STRING), CAST(wind_kmh AS STRING)))"""
ALERTS = f"""{SENSORS}, alerts AS (SELECT {ALERT_ID} AS alert_id, grid_id, event_time AS alert_time, risk_score,
 {LEVEL} AS risk_level, round(temp_celsius, 6) AS trigger_temp, humidity_pct AS trigger_humidity, wind_kmh AS trigger_wind,
 hotspot_count FROM checked WHERE reason = '' AND risk_score >= 60)"""


@query("snk_07", f"WITH {ALERTS} SELECT * FROM alerts")
def alert_append(t):
    """The batch is written twice, as after a failure, and stored once."""
    path = new_folder(t.spark, "fire_alerts")
    store = partitioned_sink(path)
    store(access.alert_rows(readings(t)), 0)
    store(access.alert_rows(readings(t)), 0)
    return t.spark.read.parquet(path).drop("batch_id")


@query("snk_08", f"""WITH {SENSORS}, {DETECTIONS.replace('checked AS', 'checked_hot AS')}
SELECT 'sensor' AS stream, grid_id AS key, count(*) AS messages FROM checked WHERE reason <> '' GROUP BY grid_id
UNION ALL SELECT 'satellite', coalesce(grid_id, 'UNKNOWN'), count(*) FROM checked_hot WHERE reason <> '' GROUP BY 2""")
def quarantine_messages(t):
    path = new_folder(t.spark, "quarantine")
    for stream, record in (("sensor", sensor_record(t)), ("satellite", detection_record(t))):
        out = q.as_messages(record, "grid_id").withColumn("stream", F.lit(stream))
        out.write.mode("append").json(path)
    stored = t.spark.read.schema("key string, value string, stream string").json(path)
    readable = F.get_json_object("value", "$.rejection_reasons[0]").isNotNull()
    return stored.filter(readable).groupBy("stream", "key").agg(F.count("*").alias("messages"))


@query("snk_09", f"""WITH {SENSORS} SELECT grid_id AS key, risk_score, {LEVEL} AS risk_level,
 concat('temp>', CAST(temp_celsius AS STRING), 'C hum<', CAST(humidity_pct AS STRING), '% vento>',
 CAST(wind_kmh AS STRING), 'kmh') AS trigger FROM checked
WHERE reason = '' AND temp_celsius > 35 AND humidity_pct < 20 AND wind_kmh > 30""")
def alert_messages(t):
    valid = q.split(q.with_sensor_reasons(t.sensor.withColumn("timestamp", iso_text())))[0]
    parsed = F.from_json("value", "risk_score double, risk_level string, trigger string")
    return messages.critical_weather_alerts(valid).select("key", parsed.alias("v")).select("key", "v.*")


@query("snk_10", """SELECT topic, grid_id AS key, event_id AS numero, round(temp_max, 6) AS valor FROM fx_weather,
 (VALUES ('weather-data'), ('sensor-events')) x(topic)
UNION ALL SELECT 'sensor-events', 'ICNF', p_partkey, NULL FROM part""")
def publications(t):
    """Every message with its content; the second batch is sent twice, as after a failure."""
    path = new_folder(t.spark, "topics")
    weather = messages.message_sink(lambda rows: messages.publications(rows, [k.WEATHER_TOPIC, k.SENSOR_TOPIC]), path)
    vegetation = messages.message_sink(messages.vegetation_publications, path)
    weather(t.weather, 0)
    for _ in range(2):
        vegetation(t.table("part").select("p_partkey", "p_type"), 1)
    stored = t.spark.read.schema("key string, value string, topic string").json(path)
    parsed = F.from_json("value", "event_id long, p_partkey long, temp_max double")
    return stored.select("topic", "key", parsed.alias("v")).select(
        "topic", "key", F.coalesce("v.event_id", "v.p_partkey").alias("numero"), F.col("v.temp_max").alias("valor"))


# --- access patterns ----------------------------------------------------------------------------------

@query("qry_01", f"""WITH {SENSORS} SELECT {READING} FROM checked WHERE reason = '' AND grid_id = 'Z5'
 AND strftime(date_trunc('hour', event_time), '%Y-%m-%dT%H:%M:%S') = '2024-01-10T17:00:00' ORDER BY event_time DESC LIMIT 5""")
def newest_readings(t):
    path = new_folder(t.spark, "sensor_readings")
    keyed.append_versions(readings(t), path, 0)
    rows = access.newest_in_bucket(keyed.read_latest(t.spark, path), "Z5", "2024-01-10T17:00:00", 5)
    return rows.drop("dia_evento", "batch_id", "latitude", "longitude", "kind")


@query("qry_02", f"""WITH {ALERTS}, newest AS (SELECT * FROM alerts ORDER BY alert_time DESC, alert_id LIMIT 10)
SELECT alert_id, alert_time, (SELECT count(*) FROM checked WHERE reason = '') AS readings FROM newest""")
def alert_preview(t):
    total = readings(t).agg(F.count("*")).scalar()
    newest = access.newest_alerts(access.alert_rows(readings(t)), 10)
    return newest.select("alert_id", "alert_time").withColumn("readings", total)


@query("qry_04", f"""WITH {ALERTS} SELECT grid_id, CAST(year(alert_time) AS INT) AS ano,
 CAST(month(alert_time) AS INT) AS mes, risk_level, count(*) AS alertas FROM alerts GROUP BY 1, 2, 3, 4""")
def alert_history(t):
    return access.alert_history(access.alert_rows(readings(t)))


@query("srt_02", f"""WITH {SENSORS} SELECT {READING} FROM checked WHERE reason = ''""")
def clustering_order(t):
    return keyed.newest_first(readings(t)).drop("latitude", "longitude", "kind")


@query("src_15", """SELECT least(1000, (SELECT count(*) FROM fx_sensor)) AS linhas""")
def limited_read(t):
    path = new_folder(t.spark, "readings")
    t.sensor.write.parquet(path)
    columns = ["grid_id", "event_time", "temp_celsius", "humidity_pct", "wind_kmh", "risk_score"]
    return lake.read_readings(t.spark, path, columns, 1000).agg(F.count("*").alias("linhas"))
