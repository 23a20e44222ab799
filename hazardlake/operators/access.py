"""Access patterns of the stored tables, previews and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hazardlake import constants as k
from hazardlake.functions.calendar import hour_bucket
from hazardlake.functions.hazard import risk_level
from hazardlake.functions.values import or_default


def _arrival(events: DataFrame) -> list[str]:
    return [c for c in events.columns if c == "arrival"]


def sensor_rows(events: DataFrame) -> DataFrame:
    """Valid sensor events in the layout of the readings table."""
    return events.select(
        "grid_id", hour_bucket(F.col("event_time")).alias("hour_bucket"), "event_time",
        or_default(F.col("source"), k.SIMULATED_SOURCE).alias("source"),
        F.col("temp_celsius").cast("double"), F.col("humidity_pct").cast("double"),
        F.col("wind_kmh").cast("double"),
        or_default(F.col("hotspot_count").cast("int"), 0).alias("hotspot_count"),
        F.col("risk_score").cast("double"),
        or_default(F.col("latitude").cast("double"), 0.0).alias("latitude"),
        or_default(F.col("longitude").cast("double"), 0.0).alias("longitude"),
        F.lit("sensor").alias("kind"), *_arrival(events),
    )


def detection_rows(detections: DataFrame) -> DataFrame:
    """Valid detections in the same layout: brightness and FRP take the temperature and risk
    slots, and ``kind`` tells the two row types apart."""
    return detections.select(
        "grid_id", hour_bucket(F.col("event_time")).alias("hour_bucket"), "event_time",
        F.lit(k.STORED_DETECTION_SOURCE).alias("source"),
        or_default(F.col("brightness").cast("double"), 0.0).alias("temp_celsius"),
        F.lit(0.0).alias("humidity_pct"), F.lit(0.0).alias("wind_kmh"),
        F.lit(1).alias("hotspot_count"),
        or_default(F.col("frp_mw").cast("double"), 0.0).alias("risk_score"),
        or_default(F.col("latitude").cast("double"), 0.0).alias("latitude"),
        or_default(F.col("longitude").cast("double"), 0.0).alias("longitude"),
        F.lit("detection").alias("kind"), *_arrival(detections),
    )


def alert_rows(readings: DataFrame) -> DataFrame:
    """Readings at alert level. The id is derived from the row, so a replay repeats it."""
    level = risk_level(F.col("risk_score"))
    return readings.filter(level.isin(*k.ALERT_LEVELS)).select(
        F.sha2(F.concat_ws("|", "grid_id", F.unix_micros("event_time").cast("string"), "source",
                           "risk_score", "temp_celsius", "humidity_pct", "wind_kmh"), 256).alias("alert_id"),
        "grid_id", F.col("event_time").alias("alert_time"), "risk_score", level.alias("risk_level"),
        F.col("temp_celsius").alias("trigger_temp"), F.col("humidity_pct").alias("trigger_humidity"),
        F.col("wind_kmh").alias("trigger_wind"), "hotspot_count",
    )


def newest_in_bucket(readings: DataFrame, grid_id: str, bucket: str, n: int) -> DataFrame:
    """The newest readings of a zone and hour; of a stored table, only that day's folder is read."""
    rows = readings.filter((F.col("grid_id") == grid_id) & (F.col("hour_bucket") == bucket))
    if "dia_evento" in readings.columns:
        rows = rows.filter(F.col("dia_evento") == F.to_date(F.lit(bucket[:10])))
    return rows.orderBy(F.desc("event_time")).limit(n)


def newest_alerts(alerts: DataFrame, n: int = 10) -> DataFrame:
    return alerts.orderBy(F.desc("alert_time"), "alert_id").limit(n)


def alert_history(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(
        "grid_id", F.year("alert_time").alias("ano"), F.month("alert_time").alias("mes"), "risk_level"
    ).agg(F.count("*").alias("alertas"))


def lake_slice(lake: DataFrame, year: int, month: int, zone: str) -> DataFrame:
    """One partition of the detections lake; the filters prune directories."""
    return lake.filter((F.col("ano") == year) & (F.col("mes") == month) & (F.col("grid_id") == zone))


def preview(df: DataFrame, columns, order, n: int) -> DataFrame:
    """First ``n`` rows of the columns that exist, in a stated order."""
    return df.orderBy(*order).limit(n).select(*[c for c in columns if c in df.columns])


def within_retention(readings: DataFrame, written_at: str, as_of: Column,
                     hours: int = k.RETENTION_HOURS) -> DataFrame:
    """Rows not yet expired; the lifetime starts when the row was written."""
    return readings.filter(F.col(written_at) >= as_of - F.expr(f"INTERVAL {int(hours)} HOURS"))


def sorted_years(df: DataFrame) -> DataFrame:
    return df.select("ano").distinct().agg(F.array_sort(F.collect_list("ano")).alias("anos"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; columns missing in one of them become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_sources(simulated: DataFrame, stations: DataFrame) -> DataFrame:
    """Rows per source of two producers that publish to one topic."""
    return union_all([simulated, stations]).groupBy("source").agg(F.count("*").alias("leituras"))
