"""Dashboard queries over the metric series."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.catalog.quality import batched_sensors
from hazardlake.catalog.registry import query
from hazardlake.operators import quality as q, timeseries as ts

FIELDS = ["success_percent", "successful_expectations", "failed_expectations", "total_rows"]
LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT _time, source, '{f}' AS _field, CAST({f} AS DOUBLE) AS _value FROM fx_quality" for f in FIELDS) + ")"


def points(t):
    return q.quality_points(batched_sensors(t), "event_time", by=("batch",))


def long_points(t):
    return ts.to_long(points(t), ["source"], FIELDS)


@query("ts_01", f"""WITH {LONG} SELECT source, _field, _time, round(_value, 6) AS _value FROM (SELECT *,
 row_number() OVER (PARTITION BY source, _field ORDER BY _time DESC, _value DESC) AS rn FROM long) WHERE rn = 1""")
def last(t):
    return ts.last(long_points(t), ["source"])


def every_sql(aggregate: str, value: str) -> str:
    return (f"SELECT time_bucket(INTERVAL 6 HOURS, _time) + INTERVAL 6 HOURS AS _time, source, {aggregate} AS {value} "
            f"FROM fx_quality GROUP BY 1, 2")


@query("ts_02", every_sql("round(avg(success_percent), 6)", "success_percent"))
def interval_mean(t):
    return ts.every(points(t), "6 hours", {"success_percent": F.avg}, ["source"])


@query("ts_03", """SELECT time_bucket(INTERVAL 6 HOURS, _time) + INTERVAL 6 HOURS AS _time, source,
 CAST(sum(total_rows) AS BIGINT) AS total_rows, CAST(sum(failed_expectations) AS BIGINT) AS failed_expectations
FROM fx_quality GROUP BY 1, 2""")
def interval_sum(t):
    return ts.every(points(t), "6 hours", {"total_rows": F.sum, "failed_expectations": F.sum}, ["source"])


WIDE = "SELECT _time, source, " + ", ".join(f"round(CAST({f} AS DOUBLE), 6) AS {f}" for f in FIELDS) + " FROM fx_quality"


@query("ts_04", WIDE)
def pivoted(t):
    return ts.fields_to_columns(long_points(t), ["source"], FIELDS)


@query("ts_05", WIDE + " ORDER BY _time DESC, source LIMIT 50")
def newest(t):
    return ts.newest(ts.fields_to_columns(long_points(t), ["source"], FIELDS), 50, ("source",))


@query("ts_06", """SELECT topic, grid_id, round(avg(latency_ms), 6) AS media, max(latency_ms) AS maxima,
 min(latency_ms) AS minima FROM fx_latency GROUP BY topic, grid_id""")
def latency_summary(t):
    return ts.latency_summary(t.latency)


@query("ts_07", """SELECT time_bucket(INTERVAL 6 HOURS, _time) + INTERVAL 6 HOURS AS _time, topic, grid_id,
 round(avg(latency_ms), 6) AS latency_ms FROM fx_latency GROUP BY 1, 2, 3""")
def latency_by_topic(t):
    return ts.latency_by_topic(t.latency, "6 hours")


@query("ts_08", """SELECT DISTINCT source FROM fx_sensor
WHERE event_time >= (SELECT max(event_time) FROM fx_sensor) - INTERVAL 1 HOUR""")
def recent_sources(t):
    rows = t.sensor.select(F.col("event_time").alias("_time"), "source")
    newest_time = rows.agg(F.max("_time")).scalar()
    return ts.recent_tag_values(rows, "source", newest_time - F.expr("INTERVAL 1 HOUR"))


@query("src_16", """SELECT _time, topic, grid_id, latency_ms FROM fx_latency WHERE topic = 'sensor-events'
 AND _time >= TIMESTAMP '2024-01-10 00:00:00' AND _time < TIMESTAMP '2024-01-12 00:00:00'""")
def range_read(t):
    return ts.read_range(t.latency, F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-12").cast("timestamp"),
                         {"topic": "sensor-events"})
