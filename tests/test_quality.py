"""Validation reasons, suites, scores and running totals."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from hazardlake import constants as k
from hazardlake.operators import quality as q
from hazardlake.sources import streams
from hazardlake.streaming import queries as sq


def candidates(spark, *events, decode=None):
    rows = spark.createDataFrame([(json.dumps(e),) for e in events], "value string")
    return (decode or sq.sensor_candidates)(rows)


def reasons(frame):
    return [r[q.REASONS] for r in frame.select(q.REASONS).collect()]


GOOD = {"grid_id": "Z1", "timestamp": "2024-01-01T00:00:00Z", "temp_celsius": 20.0, "humidity_pct": 40, "wind_kmh": 10.0,
        "risk_score": 30.5}


def test_sensor_reasons(spark):
    events = (
        GOOD, {**GOOD, "temp_celsius": 999.9}, {k: v for k, v in GOOD.items() if k not in ("humidity_pct", "wind_kmh")},
        {**GOOD, "temp_celsius": "hot", "grid_id": None}, {**GOOD, "risk_score": None}, {**GOOD, "temp_celsius": 60, "wind_kmh": 0},
    )
    assert reasons(q.with_sensor_reasons(candidates(spark, *events))) == [
        [], ["temp_celsius_out_of_range(999.9)"], ["humidity_pct_null", "wind_kmh_null"],
        ["temp_celsius_invalid_type(hot)", "grid_id_null"], ["risk_score_null"], []]


def test_detection_reasons(spark):
    good = {"grid_id": "Z1", "latitude": 40.0, "longitude": -8.0, "frp_mw": 10.0, "brightness": 300.0}
    events = (
        good, {**good, "frp_mw": 99999.0}, {**good, "latitude": 0.0}, {**good, "grid_id": "PT-UNKNOWN"},
        {k: v for k, v in good.items() if k != "brightness"}, {"longitude": -8.0, "brightness": "x"},
        {**{k: v for k, v in good.items() if k != "frp_mw"}, "frp": 5.0},
    )
    assert reasons(q.with_detection_reasons(candidates(spark, *events, decode=sq.detection_candidates))) == [
        [], ["frp_mw_out_of_range(99999.0)"], ["latitude_out_of_range(0.0)"], ["grid_id_unknown(PT-UNKNOWN)"],
        ["brightness_null"],
        ["grid_id_null", "latitude_null", "frp_mw_null", "brightness_invalid_type(x)", "grid_id_unknown(None)"], []]


def test_typed_decode_turns_wrong_types_and_times_to_null(spark):
    rows = spark.createDataFrame([('{"grid_id":"a","temp_celsius":"20","timestamp":"soon","extra":1}',)], "value string")
    row = streams.decode_sensors(rows).collect()[0]
    assert (row.grid_id, row.temp_celsius, row.event_time) == ("a", None, None)


def test_detection_power_is_read_under_both_names(spark):
    rows = spark.createDataFrame([('{"frp":1.0}',), ('{"frp_mw":2.0}',)], "value string")
    assert [r.frp for r in streams.decode_detections(rows).collect()] == [1.0, 2.0]


def test_expectations_ignore_nulls_in_ranges(spark):
    frame = spark.createDataFrame([("a", None, 50.0, 10.0, 1.0), (None, 70.0, 50.0, 10.0, None)],
                                  "grid_id string, temp_celsius double, humidity_pct double, wind_kmh double, risk_score double")
    rows = {r.expectation: (r.evaluated, r.unexpected, r.passed) for r in q.expectation_results(frame).collect()}
    assert rows["temp_celsius_between"] == (1, 1, False)
    assert rows["humidity_pct_between"] == (2, 0, True)
    assert rows["grid_id_not_null"] == (2, 1, False)
    stats = q.suite_statistics(frame).collect()[0]
    assert (stats.success_percent, stats.successful_expectations, stats.failed_expectations, stats.total_rows) == (40.0, 2, 3, 2)


def test_cell_score_counts_null_scores_twice(spark):
    frame = spark.createDataFrame([("a", None), ("b", 50.0)], "grid_id string, risk_score double")
    row = q.cell_score(frame).collect()[0]
    assert (row.successful_cells, row.failed_cells, row.success_percent) == (4, 2, 66.67)
    assert q.cell_score(frame.limit(0)).collect()[0].success_percent == 100.0


def test_quarantine_defaults(spark):
    bad = q.with_sensor_reasons(candidates(spark, {"temp_celsius": 999.9}))
    record = q.sensor_quarantine(bad.filter(~q.is_valid()), F.lit("2024-01-01").cast("timestamp")).collect()[0]
    assert (record.grid_id, record.source, record.original_timestamp, record.temp_celsius) == ("UNKNOWN", "unknown", None, "999.9")
    detail = q.rejection_details(q.sensor_quarantine(bad)).collect()[0]
    assert (detail.temp_celsius, detail.original_timestamp) == (999.9, "None")


def test_running_totals_with_a_hot_source(spark):
    batches = spark.range(5_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.col("id").alias("batch"), (F.col("id") % 5).alias("n"))
    got = q.running_totals(batches, "source", "batch", ("n",), block=64).toPandas()
    data = batches.toPandas().sort_values("batch")
    data["total_n"] = data.groupby("source", dropna=False).n.cumsum()
    assert got.source.isna().any()
    merged = got.merge(data, on="batch", suffixes=("", "_wanted"))
    assert len(merged) == 5_000
    assert (merged.total_n == merged.total_n_wanted).all()


def test_rule_tables_are_closed_ranges():
    assert [r.column for r in k.SENSOR_RANGES] == ["temp_celsius", "humidity_pct", "wind_kmh", "risk_score"]
