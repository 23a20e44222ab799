"""Expectation suites, row validation with reasons, quarantine records and quality metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from hazardlake import constants as k
from hazardlake.functions.values import as_json, or_default, safe_double, unknown_zone

REASONS = "rejection_reasons"


# --- expectations over whole batches --------------------------------------------------

def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _out_of_range(rule: k.Range) -> Column:
    """Unexpected values of a range expectation; nulls are not evaluated."""
    return ~F.col(rule.column).between(rule.low, rule.high)


def _expectations(suite) -> list[tuple[str, Column, Column]]:
    """(name, evaluated rows, unexpected rows) of each expectation of a suite."""
    ranges, required = suite
    return [
        (f"{rule.column}_between", F.count(rule.column), F.count_if(_out_of_range(rule)))
        for rule in ranges
    ] + [
        (f"{name}_not_null", F.count("*"), F.count_if(F.col(name).isNull())) for name in required
    ]


def expectation_results(df: DataFrame, suite=k.LIVE_SUITE, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per expectation: rows evaluated, rows unexpected, passed. One pass, no join."""
    checks = _expectations(suite)
    counts = df.groupBy(*by).agg(*[
        F.struct(F.lit(name).alias("expectation"), evaluated.alias("evaluated"),
                 unexpected.alias("unexpected")).alias(f"check_{i}")
        for i, (name, evaluated, unexpected) in enumerate(checks)
    ])
    return (
        counts
        .select(*by, F.explode(F.array(*[f"check_{i}" for i in range(len(checks))])).alias("c"))
        .select(*by, "c.*", (F.col("c.unexpected") == 0).alias("passed"))
    )


def suite_statistics(df: DataFrame, suite=k.LIVE_SUITE, by: tuple[str, ...] = (),
                     **extra: Column) -> DataFrame:
    """Percentage of expectations passed, passed, failed and row count per batch.

    ``extra`` names further aggregates of the same pass.
    """
    checks = _expectations(suite)
    counts = df.groupBy(*by).agg(
        F.count("*").alias("total_rows"), *[column.alias(name) for name, column in extra.items()],
        *[unexpected.alias(f"bad_{i}") for i, (_, _, unexpected) in enumerate(checks)],
    )
    passed = sum(((F.col(f"bad_{i}") == 0).cast("bigint") for i in range(len(checks))), F.lit(0))
    return counts.select(
        *by, *extra,
        (passed * 100.0 / len(checks)).alias("success_percent"),
        passed.alias("successful_expectations"),
        (len(checks) - passed).alias("failed_expectations"),
        "total_rows",
    )


def cell_score(df: DataFrame, ranges=k.SENSOR_RANGES, required=k.SENSOR_REQUIRED) -> DataFrame:
    """Share of good cells over rows x checks. A null fails a range check as well.

    Absent columns are not checked; a frame without checks or rows scores 100.
    """
    failures = [
        F.count_if(F.col(r.column).isNull() | _out_of_range(r)) for r in ranges if r.column in df.columns
    ] + [F.count_if(F.col(name).isNull()) for name in required if name in df.columns]
    totals = df.agg(
        (F.count("*") * len(failures)).alias("checks"),
        sum(failures, F.lit(0)).cast("bigint").alias("failed"),
    )
    good = F.col("checks") - F.col("failed")
    return totals.select(
        F.when(F.col("checks") > 0, F.round(good * 100.0 / F.col("checks"), 2)).otherwise(100.0)
        .alias("success_percent"),
        good.alias("successful_cells"),
        F.col("failed").alias("failed_cells"),
    )


# --- row validation ---------------------------------------------------------------------

def _null_reason(df: DataFrame, name: str) -> Column:
    return F.when(_column(df, name).isNull(), F.lit(f"{name}_null"))


def _range_reason(df: DataFrame, rule: k.Range) -> Column:
    """Reason why a present value breaks its range rule, or null."""
    raw = _column(df, rule.column)
    text, number = raw.cast("string"), safe_double(raw)
    return (
        F.when(raw.isNull(), F.lit(None))
        .when(number.isNull(), F.concat(F.lit(f"{rule.column}_invalid_type("), text, F.lit(")")))
        .when(~number.between(rule.low, rule.high),
              F.concat(F.lit(f"{rule.column}_out_of_range("), text, F.lit(")")))
    )


def with_sensor_reasons(df: DataFrame) -> DataFrame:
    """Add every reason for rejecting a sensor event, rules first, then mandatory fields."""
    ruled = {rule.column for rule in k.SENSOR_RANGES}
    checks = [
        F.coalesce(_null_reason(df, rule.column), _range_reason(df, rule)) for rule in k.SENSOR_RANGES
    ] + [_null_reason(df, name) for name in k.SENSOR_REQUIRED if name not in ruled]
    return df.withColumn(REASONS, F.array_compact(F.array(*checks)))


def with_detection_reasons(df: DataFrame) -> DataFrame:
    """Reasons for a satellite event: mandatory nulls, ranges, unknown zone, in that order."""
    ranges = []
    for rule in k.DETECTION_RANGES:
        reason = _range_reason(df, rule)
        if rule.column not in k.DETECTION_REQUIRED:
            reason = F.coalesce(_null_reason(df, rule.column), reason)
        ranges.append(reason)
    zone = _column(df, "grid_id")
    zone_reason = F.when(
        unknown_zone(zone),
        F.concat(F.lit("grid_id_unknown("), F.coalesce(zone, F.lit("None")), F.lit(")")),
    )
    mandatory = [_null_reason(df, name) for name in k.DETECTION_REQUIRED]
    return df.withColumn(REASONS, F.array_compact(F.array(*mandatory, *ranges, zone_reason)))


def with_time_reason(validated: DataFrame, time: str = "event_time", text: str = "timestamp") -> DataFrame:
    """Add a reason where the event time is absent or cannot be read: a keyed table has no place for the row."""
    reason = F.when(F.col(time).isNull(), F.when(F.col(text).isNull(), "timestamp_null").otherwise("timestamp_invalid"))
    return validated.withColumn(REASONS, F.array_compact(F.concat(F.col(REASONS), F.array(reason))))


def is_valid() -> Column:
    return F.size(REASONS) == 0


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return validated.filter(is_valid()).drop(REASONS), validated.filter(~is_valid())


def batch_counts(validated: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return validated.groupBy(*by).agg(
        F.count("*").alias("processed"),
        F.count_if(is_valid()).alias("valid"),
        F.count_if(~is_valid()).alias("rejected"),
    )


# --- quarantine records and metric points -------------------------------------------------

def sensor_quarantine(rejected: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    return rejected.select(
        or_default(F.col("grid_id"), "UNKNOWN").alias("grid_id"),
        (F.current_timestamp() if rejected_at is None else rejected_at).alias("rejected_at"),
        _column(rejected, "timestamp").alias("original_timestamp"),
        or_default(_column(rejected, "source"), "unknown").alias("source"),
        *[_column(rejected, rule.column).alias(rule.column) for rule in k.SENSOR_RANGES],
        REASONS,
    )


def detection_quarantine(rejected: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    kept = ("latitude", "longitude", "frp_mw", "brightness", "confidence")
    return rejected.select(
        or_default(F.col("grid_id"), "UNKNOWN").alias("grid_id"),
        (F.current_timestamp() if rejected_at is None else rejected_at).alias("rejected_at"),
        _column(rejected, "timestamp").alias("original_timestamp"),
        or_default(_column(rejected, "source"), k.DETECTION_SOURCE).alias("source"),
        *[_column(rejected, name).alias(name) for name in kept],
        REASONS,
    )


def as_messages(records: DataFrame, key: str | None = None) -> DataFrame:
    """Records as (key, value) messages with a JSON value."""
    message_key = F.col(key) if key else F.lit(None).cast("string")
    return records.select(message_key.alias("key"), as_json(*records.columns).alias("value"))


def quality_points(df: DataFrame, time: str, source: str = "sensor_readings",
                   by: tuple[str, ...] = (), suite=k.LIVE_SUITE) -> DataFrame:
    """``data_quality`` points: suite statistics per batch, stamped with its newest event."""
    stats = suite_statistics(df, suite, by, _time=F.max(time))
    return stats.select(*by, "_time", F.lit(source).alias("source"), "success_percent",
                        "successful_expectations", "failed_expectations", "total_rows")


def rejection_points(quarantined: DataFrame) -> DataFrame:
    """``rejected_events`` points: totals per time of rejection, zone and joined reasons."""
    return (
        quarantined
        .groupBy(F.col("rejected_at").alias("_time"), "grid_id", F.array_join(REASONS, ",").alias("reason"))
        .agg(F.count("*").alias("count"))
    )


def rejection_details(quarantined: DataFrame) -> DataFrame:
    """``rejected_event_detail`` points: numbers where the value is one, null elsewhere."""
    return quarantined.select(
        F.col("rejected_at").alias("_time"), "grid_id", "source",
        # an absent event time is recorded as text, like every other value of the field
        F.coalesce(F.col("original_timestamp").cast("string"), F.lit("None")).alias("original_timestamp"),
        *[safe_double(F.col(rule.column)).alias(rule.column) for rule in k.SENSOR_RANGES],
        F.array_join(REASONS, ",").alias(REASONS),
    )


def latency_points(events: DataFrame, latency: Column, topic: str, time: Column) -> DataFrame:
    return events.select(time.alias("_time"), F.lit(topic).alias("topic"), "grid_id",
                         latency.alias("latency_ms"))


def running_totals(per_batch: DataFrame, group: str, order: str, counters: tuple[str, ...],
                   block: int = 4096) -> DataFrame:
    """Counters accumulated over batches in order, without one task per group.

    ``order`` is a whole-number batch position. Batches are cut into blocks of consecutive
    positions: totals run inside each block, and each block starts from the sum of the
    blocks before it. A group with a third of all batches is spread over its blocks, and
    the only per-group window sees one row per block.
    """
    # both key parts are free of nulls or compared null-safely, so no filter is inferred for
    # one side only and the two uses of the counts share one shuffle
    blocked = per_batch.withColumn("_block", F.coalesce(F.floor(F.col(order) / block), F.lit(-1)))
    earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy(group, "_block").agg(*[F.sum(c).alias(f"_{c}") for c in counters])
        .select(F.col(group).alias("_group"), F.col("_block").alias("_of"),
                *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in counters])
    )
    inside = (Window.partitionBy(group, "_block").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_block") == F.col("_of"))
    return blocked.join(offsets, same).select(
        group, order,
        *[(F.sum(c).over(inside) + F.col(f"_{c}")).alias(f"total_{c}") for c in counters],
    )
