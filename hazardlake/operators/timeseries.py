"""Dashboard queries over metric tables with ``_time``, tag and field columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazardlake.sinks import tables


def read_range(points: DataFrame, start, stop, tags: dict[str, str] | None = None) -> DataFrame:
    """Points of a half-open time range, optionally with fixed tag values."""
    rows = points.filter((F.col("_time") >= start) & (F.col("_time") < stop))
    for tag, value in (tags or {}).items():
        rows = rows.filter(F.col(tag) == value)
    return rows


def read_stored(spark: SparkSession, path: str, start: dt.datetime, stop: dt.datetime,
                tags: dict[str, str] | None = None) -> DataFrame:
    """Points of a half-open time range from a committed table cut by the day of ``_time``.

    Only the range's days are listed and read; within them, time and tags are pushed to the scan, whose files are sorted by them.
    """
    days = (F.col("dia") >= F.lit(start.date())) & (F.col("dia") <= F.lit(stop.date()))
    rows = tables.scan(spark, path, start.date(), (stop - dt.timedelta(microseconds=1)).date()).filter(days)
    return read_range(rows, F.lit(start), F.lit(stop), tags)


def to_long(points: DataFrame, tags: list[str], fields: list[str]) -> DataFrame:
    """Wide points to (_time, tags, _field, _value) rows; absent values give no row."""
    cells = [F.struct(F.lit(f).alias("_field"), F.col(f).cast("double").alias("_value")) for f in fields]
    return (points.select("_time", *tags, F.explode(F.array(*cells)).alias("c"))
            .select("_time", *tags, "c.*").filter("_value IS NOT NULL"))


def last(long: DataFrame, tags: list[str]) -> DataFrame:
    """Newest value of every series; among equal times the greatest value."""
    newest = F.max(F.struct("_time", "_value"))
    return (long.groupBy(*tags, "_field").agg(newest.alias("p"))
            .select(*tags, "_field", "p._time", "p._value"))


def every(points: DataFrame, interval: str, how: dict[str, Callable], tags: list[str]) -> DataFrame:
    """Aggregate fields per fixed interval and series, labelled with the interval's end.

    Intervals without points are left out.
    """
    return (points.groupBy(F.window("_time", interval), *tags)
            .agg(*[f(value).alias(value) for value, f in how.items()])
            .select(F.col("window.end").alias("_time"), *tags, *how))


def fields_to_columns(long: DataFrame, tags: list[str], fields: list[str]) -> DataFrame:
    return long.groupBy("_time", *tags).pivot("_field", fields).agg(F.first("_value"))


def newest(points: DataFrame, n: int = 50, ties: tuple[str, ...] = ()) -> DataFrame:
    return points.orderBy(F.desc("_time"), *ties).limit(n)


def latency_summary(points: DataFrame) -> DataFrame:
    return points.groupBy("topic", "grid_id").agg(
        F.avg("latency_ms").alias("media"), F.max("latency_ms").alias("maxima"),
        F.min("latency_ms").alias("minima"))


def latency_by_topic(points: DataFrame, interval: str) -> DataFrame:
    """Interval means per topic and zone. Grouping by topic only reorders them, so the rows
    of a topic are kept together by a range partition instead of one global sort task."""
    means = every(points, interval, {"latency_ms": F.avg}, ["topic", "grid_id"])
    return means.repartitionByRange("topic", "_time", "grid_id").sortWithinPartitions(
        "topic", "_time", "grid_id")


def recent_tag_values(points: DataFrame, tag: str, start) -> DataFrame:
    return points.filter(F.col("_time") >= start).select(tag).distinct()
