"""Streaming runs over envelope files: late rows, restart, parity, counters."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hazardlake.functions.calendar import hour_bucket
from hazardlake.operators import access, quality as q, windows as w
from hazardlake.session import new_folder
from hazardlake.sinks import keyed
from hazardlake.sources import streams as src
from hazardlake.streaming import queries as sq

START = dt.datetime(2024, 1, 1)


def put(spark, folder, *events):
    rows = [(e["grid_id"], json.dumps(e), None) for e in events]
    spark.createDataFrame(rows, "key string, value string, topic string").coalesce(1).write.mode("append").json(folder)


def reading(minute, **extra):
    return {"grid_id": "Z1", "timestamp": (START + dt.timedelta(minutes=minute)).isoformat() + "Z", "temp_celsius": 20.0,
            "humidity_pct": 50.0, "wind_kmh": 10.0, "hotspot_count": 0, "risk_score": 40.0, "source": "iot_simulator_v1", **extra}


def detection(minute, **extra):
    return {"grid_id": "Z1", "timestamp": (START + dt.timedelta(minutes=minute)).isoformat() + "Z", "latitude": 40.0,
            "longitude": -8.0, "brightness": 320.0, "frp_mw": 100.0, "confidence": "h", **extra}


def weather(minute):
    return {"grid_id": "Z1", "timestamp": (START + dt.timedelta(minutes=minute)).isoformat() + "Z", "temp_max": 30.0,
            "humidity_avg": 30.0, "wind_max_kmh": 75.0, "precipitation_mm": 0.0}


def test_an_event_falls_in_two_windows(spark):
    frame = spark.createDataFrame([("Z1", dt.datetime(2024, 1, 1, 19, 7))], "grid_id string, event_time timestamp")
    rows = frame.select(F.window("event_time", "10 minutes", "5 minutes").alias("w")).select(
        F.date_format("w.start", "HH:mm").alias("a"), F.date_format("w.end", "HH:mm").alias("b")).collect()
    assert sorted((r.a, r.b) for r in rows) == [("19:00", "19:10"), ("19:05", "19:15")]


def test_composite_join_drops_late_rows_and_survives_restart(spark):
    folders = {name: new_folder(spark, name) for name in ("sensors", "detections", "weather")}
    out, checkpoint = new_folder(spark, "out"), new_folder(spark, "checkpoint")

    def run():
        frame = sq.composite_stream(
            src.decode_sensors(src.envelope_folder(spark, folders["sensors"])),
            src.decode_detections(src.envelope_folder(spark, folders["detections"])),
            src.decode_weather(src.envelope_folder(spark, folders["weather"])))
        query = sq.start(frame, checkpoint, once=True, path=out)
        query.awaitTermination()
        return query

    put(spark, folders["sensors"], reading(1), reading(3, risk_score=60.0), reading(40), reading(2, grid_id=None))
    put(spark, folders["detections"], detection(2), detection(40))
    put(spark, folders["weather"], weather(4), weather(40))
    run()
    first = {r.janela_inicio: r for r in spark.read.parquet(out).collect()}
    assert sorted(first) == [START - dt.timedelta(minutes=5), START]
    row = first[START]
    assert (row.n_leituras_sensor, row.risk_medio_sensor, row.n_hotspots, row.vento_max_ipma) == (2, 50.0, 1, 75.0)
    assert abs(row.risco_composto - (30 + 12.5 + 7.5)) < 1e-9

    # every input moves on, one sensor row is older than the watermark
    put(spark, folders["sensors"], reading(4, risk_score=99.0), reading(80))
    put(spark, folders["detections"], detection(80))
    put(spark, folders["weather"], weather(80))
    query = run()
    dropped = sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in json.loads(p.json)["stateOperators"])
    assert dropped == 2
    second = {r.janela_inicio: r for r in spark.read.parquet(out).collect()}
    assert second[START] == row
    assert START + dt.timedelta(minutes=40) in second and len(second) == 4
    assert second[START + dt.timedelta(minutes=35)].n_hotspots == 1


def test_batch_windows_equal_direct_windows(spark):
    events = spark.range(3_000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("z"), F.col("id") % 5)).alias("grid_id"),
        F.timestamp_seconds(F.col("id") * 37 - 20_000).alias("event_time"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 100).cast("double")).alias("risk_score"),
        (F.col("id") % 40).cast("double").alias("temp_celsius"), F.lit(None).cast("double").alias("humidity_pct"),
        F.lit(1.0).alias("wind_kmh"))
    for window, slide in (("10 minutes", "5 minutes"), ("1 hour", "10 minutes"), ("10 minutes", "4 minutes")):
        direct = events.groupBy(F.window("event_time", window, slide), "grid_id").agg(*[m.direct() for m in w.SENSOR_MEASURES])
        merged = w.sensor_windows(events, window, slide)
        assert merged.columns == direct.columns
        rounded = [frame.select("window.*", "grid_id", "n_leituras_sensor", F.round("risk_medio_sensor", 9), "risk_maximo_sensor",
                                F.round("temp_media", 9), "humidade_media", "vento_medio") for frame in (merged, direct)]
        assert rounded[0].exceptAll(rounded[1]).count() == 0 and rounded[1].exceptAll(rounded[0]).count() == 0


def test_windows_without_matches_read_zero(spark):
    sensors = spark.createDataFrame([("Z1", START, 10.0, 20.0, 50.0, 5.0)], "grid_id string, event_time timestamp, "
                                    "risk_score double, temp_celsius double, humidity_pct double, wind_kmh double")
    detections = spark.createDataFrame([(None, START, 9.0, 300.0)], "grid_id string, event_time timestamp, frp double, brightness double")
    forecasts = spark.createDataFrame([], "grid_id string, event_time timestamp, temp_max double, humidity_avg double, "
                                      "wind_max_kmh double, precipitation_mm double")
    rows = w.composite(sensors, detections, forecasts).collect()
    assert len(rows) == 2 and len(rows[0]) == 17
    assert {(r.n_hotspots, r.frp_medio, r.temp_max_media) for r in rows} == {(0, 0.0, None)}


def test_ingestion_stores_each_event_once(spark):
    folder, root, checkpoint = (new_folder(spark, n) for n in ("sensors", "ingest", "checkpoint"))
    put(spark, folder, reading(1), reading(2, temp_celsius=999.9), reading(3, temp_celsius=40.0, humidity_pct=10.0, wind_kmh=45.0,
                                                                          risk_score=96.5, hotspot_count=3))

    def run():
        frame = sq.sensor_candidates(src.envelope_folder(spark, folder))
        sq.start(frame, checkpoint, once=True, sink=sq.sensor_sink(root)).awaitTermination()

    run()
    put(spark, folder, reading(1, risk_score=55.0))
    run()
    readings = {r.event_time: r for r in keyed.read_latest(spark, f"{root}/sensor_readings").collect()}
    assert len(readings) == 2
    assert readings[START + dt.timedelta(minutes=1)].risk_score == 55.0
    alert = spark.read.parquet(f"{root}/fire_alerts").collect()
    assert [(a.risk_level, a.trigger_temp) for a in alert] == [("CRITICAL", 40.0)]
    message = json.loads(spark.read.parquet(f"{root}/alert_messages").collect()[0].value)
    assert message["trigger"] == "temp>40.0C hum<10.0% vento>45.0kmh" and message["hotspot_count"] == 3
    record = json.loads(spark.read.parquet(f"{root}/quarantine").collect()[0].value)
    assert record["rejection_reasons"] == ["temp_celsius_out_of_range(999.9)"]
    points = {p.total_rows: p for p in spark.read.parquet(f"{root}/data_quality").collect()}
    assert points[3].failed_expectations == 1 and points[1].success_percent == 100.0


def test_detection_ingestion_keeps_row_kinds_apart(spark):
    folder, root = new_folder(spark, "detections"), new_folder(spark, "ingest")
    put(spark, folder, detection(1), detection(2, grid_id="PT-UNKNOWN"))
    frame = sq.detection_candidates(src.envelope_folder(spark, folder))
    sq.start(frame, new_folder(spark, "checkpoint"), once=True, sink=sq.detection_sink(root)).awaitTermination()
    row = keyed.read_latest(spark, f"{root}/detection_readings").collect()[0]
    assert (row.kind, row.source, row.temp_celsius, row.risk_score, row.humidity_pct) == ("detection", "nasa_firms", 320.0, 100.0, 0.0)
    assert spark.read.parquet(f"{root}/detection_quarantine").count() == 1
    point = spark.read.parquet(f"{root}/detection_quality").collect()
    assert [(p.source, p.total_rows, p.failed_expectations, p.success_percent) for p in point] == [("detection_readings", 2, 0, 100.0)]


def test_detections_outside_the_rules_lower_the_quality_of_their_batch(spark):
    folder, root = new_folder(spark, "detections"), new_folder(spark, "ingest")
    put(spark, folder, detection(1), detection(2, brightness=900.0), detection(3, grid_id=None, latitude=50.0))
    frame = sq.detection_candidates(src.envelope_folder(spark, folder))
    sq.start(frame, new_folder(spark, "checkpoint"), once=True, sink=sq.detection_sink(root)).awaitTermination()
    point = spark.read.parquet(f"{root}/detection_quality").collect()[0]
    assert (point.total_rows, point.successful_expectations, point.failed_expectations) == (3, 5, 3)


def test_both_streams_are_read_as_one_table(spark):
    root = new_folder(spark, "ingest")
    with pytest.raises(FileNotFoundError):
        keyed.read_readings(spark, root)
    for candidates, sink, rows in ((sq.sensor_candidates, sq.sensor_sink, (reading(1), reading(2))),
                                   (sq.detection_candidates, sq.detection_sink, (detection(1),))):
        folder = new_folder(spark, "topic")
        put(spark, folder, *rows)
        for _ in range(2):  # the second run finds nothing new
            sq.start(candidates(src.envelope_folder(spark, folder)), f"{folder}-checkpoint", once=True, sink=sink(root)).awaitTermination()
        kinds = sorted(r.kind for r in keyed.read_readings(spark, root).collect())
        assert kinds == (["sensor"] * 2 if sink is sq.sensor_sink else ["detection", "sensor", "sensor"])


def test_unreadable_times_are_quarantined(spark):
    folder, root = new_folder(spark, "sensors"), new_folder(spark, "ingest")
    put(spark, folder, reading(1), *[reading(1, timestamp=t) for t in ("soon", "at 12", "", "32/13/2024", None)],
        reading(2, grid_id=None))
    frame = sq.sensor_candidates(src.envelope_folder(spark, folder))
    sq.start(frame, new_folder(spark, "checkpoint"), once=True, sink=sq.sensor_sink(root)).awaitTermination()
    assert spark.read.parquet(f"{root}/sensor_readings").count() == 1
    points = spark.read.parquet(f"{root}/rejected_events").filter("_time <= current_timestamp()").collect()
    assert {(p.reason, p["count"]) for p in points} == {("timestamp_invalid", 4), ("timestamp_null", 1), ("grid_id_null", 1)}


def test_the_last_line_of_a_batch_wins(spark):
    folder, root, checkpoint = (new_folder(spark, n) for n in ("sensors", "ingest", "checkpoint"))

    def stored():
        frame = sq.sensor_candidates(src.envelope_folder(spark, folder))
        sq.start(frame, checkpoint, once=True, sink=sq.sensor_sink(root)).awaitTermination()
        return [r.risk_score for r in keyed.read_latest(spark, f"{root}/sensor_readings").collect()]

    put(spark, folder, *[reading(1, risk_score=float(i % 90)) for i in range(500)], reading(1, risk_score=95.0))
    assert stored() == [95.0]
    put(spark, folder, reading(1, risk_score=7.0), reading(1, risk_score=3.0))
    assert stored() == [3.0]


def test_arrival_decides_whatever_the_partitions(spark):
    versions = spark.range(2_000).select(
        F.lit("Z1").alias("grid_id"), F.lit("b").alias("hour_bucket"), F.lit(START).alias("event_time"),
        F.col("id").alias("arrival"), F.col("id").cast("double").alias("risk_score"))
    for parts in (1, 4, 8):
        path = new_folder(spark, "readings")
        keyed.append_versions(versions.repartition(parts), path, 0)
        assert [r.risk_score for r in keyed.read_latest(spark, path).collect()] == [1999.0]


def test_a_bucket_reads_one_day(spark):
    path = new_folder(spark, "readings")
    rows = spark.range(200).select(
        F.lit("Z1").alias("grid_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("event_time"))
    keyed.append_versions(rows.withColumn("hour_bucket", hour_bucket(F.col("event_time"))), path, 0)
    found = access.newest_in_bucket(keyed.read_latest(spark, path), "Z1", "2024-01-03T05:00:00", 5)
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dia_evento" in plan


def test_rows_without_a_zone_take_no_part_in_batch_either(spark):
    sensors = spark.createDataFrame([("Z1", START, 10.0, 20.0, 50.0, 5.0), (None, START, 10.0, 20.0, 50.0, 5.0)],
                                    "grid_id string, event_time timestamp, risk_score double, temp_celsius double, "
                                    "humidity_pct double, wind_kmh double")
    detections = spark.createDataFrame([], "grid_id string, event_time timestamp, frp double, brightness double")
    forecasts = spark.createDataFrame([], "grid_id string, event_time timestamp, temp_max double, humidity_avg double, "
                                      "wind_max_kmh double, precipitation_mm double")
    assert {r.grid_id for r in w.composite(sensors, detections, forecasts).collect()} == {"Z1"}


def test_running_counts_in_update_mode(spark):
    folder, out, checkpoint = (new_folder(spark, n) for n in ("sensors", "counts", "checkpoint"))

    def run():
        frame = sq.running_counts(sq.sensor_candidates(src.envelope_folder(spark, folder)))
        sq.start(frame, checkpoint, mode="update", once=True, sink=sq.partitioned_sink(out)).awaitTermination()

    put(spark, folder, reading(1), reading(2, temp_celsius=None))
    run()
    put(spark, folder, reading(3))
    run()
    newest = keyed.latest_per_key(spark.read.parquet(out), key=("source",)).collect()[0]
    assert (newest.processed, newest.valid, newest.rejected) == (3, 2, 1)


def test_a_replayed_batch_changes_nothing(spark):
    path = new_folder(spark, "readings")
    rows = spark.createDataFrame([("Z1", "b", START, 1.0), ("Z2", "b", START, 2.0)],
                                 "grid_id string, hour_bucket string, event_time timestamp, risk_score double")
    keyed.append_versions(rows, path, 0)
    keyed.append_versions(rows.withColumn("risk_score", F.lit(9.0)), path, 1)
    before = sorted(keyed.read_latest(spark, path).collect())
    keyed.append_versions(rows, path, 0)
    assert sorted(keyed.read_latest(spark, path).collect()) == before
    assert {r.risk_score for r in before} == {9.0}
    target = new_folder(spark, "compacted")
    keyed.compact(spark, path, target)
    assert spark.read.parquet(target).count() == 2
    assert sorted(r.risk_score for r in keyed.read_latest(spark, target).collect()) == [9.0, 9.0]


def test_partitioned_sink_owns_its_batch(spark):
    path = new_folder(spark, "sink")
    sink = sq.partitioned_sink(path)
    sink(spark.range(3), 0)
    sink(spark.range(5), 1)
    sink(spark.range(3), 0)
    assert spark.read.parquet(path).count() == 8


def test_validity_split(spark):
    frame = q.with_sensor_reasons(spark.createDataFrame(
        [("a", 20.0, 50.0, 5.0, 10.0), ("b", None, 50.0, 5.0, 10.0)],
        "grid_id string, temp_celsius double, humidity_pct double, wind_kmh double, risk_score double"))
    good, bad = q.split(frame)
    assert good.count() == 1 and bad.count() == 1 and q.REASONS not in good.columns


def test_expired_versions_are_left_out(spark):
    path = new_folder(spark, "readings")
    rows = spark.createDataFrame([("Z1", "b", START, 1.0), ("Z2", "b", START, 2.0)],
                                 "grid_id string, hour_bucket string, event_time timestamp, risk_score double")
    keyed.append_versions(rows.withColumn("written_at", F.lit(START)), path, 0)
    renewed = rows.filter("grid_id = 'Z2'").withColumn("written_at", F.lit(START + dt.timedelta(hours=10)))
    keyed.append_versions(renewed, path, 1)
    as_of = F.lit(START + dt.timedelta(hours=75))
    assert [r.grid_id for r in keyed.read_latest(spark, path, as_of=as_of).collect()] == ["Z2"]


def test_newest_first_splits_a_hot_key_in_order(spark):
    rows = spark.range(20_000).select(
        F.lit("Z1").alias("grid_id"), F.lit("h").alias("hour_bucket"), F.timestamp_seconds("id").alias("event_time"))
    # few rows would be merged into one partition otherwise
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = keyed.newest_first(rows).withColumn("part", F.spark_partition_id()).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert ordered.part.nunique() > 1
    assert ordered.event_time.is_monotonic_decreasing
