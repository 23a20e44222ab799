"""Keyed tables on a file lake: last write wins, newest first, bounded lifetime.

A write appends an immutable version of its rows under (day, batch). Writing a batch again
replaces only that batch, so a replay after a failure changes nothing. Readers keep the
latest version per key: of the last batch and, within it, by ``arrival`` where rows carry it. No
stored file is rewritten by a later batch.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, Window

from hazardlake import constants as k
from hazardlake.operators.access import within_retention
from hazardlake.sinks import tables

KEY = ("grid_id", "hour_bucket", "event_time")
READINGS = ("sensor_readings", "detection_readings")
ORDER = ("batch_id", "arrival")


def latest_per_key(versions: DataFrame, key: tuple[str, ...] = KEY, order: tuple[str, ...] = ("batch_id",),
                   ) -> DataFrame:
    """The last version of each key.

    The rank filter is applied per task before the shuffle (window group limit), so a key
    with very many versions sends one row per task.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.desc_nulls_last(c) for c in order])
    return versions.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def append_versions(rows: DataFrame, path: str, batch_id: int, time: str = "event_time") -> None:
    (
        rows.withColumns({"dia_evento": F.to_date(time), "batch_id": F.lit(int(batch_id)).cast("bigint")})
        .hint("rebalance", "dia_evento")
        .sortWithinPartitions("dia_evento", "batch_id", "grid_id", F.desc(time))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("dia_evento", "batch_id").parquet(path)
    )


def numbered(batch: DataFrame) -> DataFrame:
    """Rows of a micro-batch with their line number added to their place of arrival.

    Lines of a file stay together and in order, so the number orders what one file holds.
    """
    source = [F.col("arrival").alias("source")] if "arrival" in batch.columns else []
    return batch.withColumn("arrival", F.struct(*source, F.monotonically_increasing_id().alias("line")))


def read_latest(spark: SparkSession, path: str, order: tuple[str, ...] = ORDER,
                as_of: Column | None = None, hours: int = k.RETENTION_HOURS) -> DataFrame:
    """Current rows of a keyed table, without those past their lifetime when ``as_of`` is given.

    Below a manifest, only committed versions are read.

    Later versions are written later, so a key whose last version has expired has only
    expired ones: the lifetime can be checked on the scan, where it skips old files.
    """
    versions = tables.scan(spark, path)
    if as_of is not None:
        versions = within_retention(versions, "written_at", as_of, hours)
    # the day follows from the event time; as part of the key it lets filters on days reach the scan
    return latest_per_key(versions, ("dia_evento", *KEY), tuple(c for c in order if c in versions.columns))


def read_readings(spark: SparkSession, root: str, as_of: Column | None = None, hours: int = k.RETENTION_HOURS) -> DataFrame:
    """Current readings of the sensor and satellite streams below one root, as one table.

    ``kind`` tells the rows apart: a sensor and a detection of the same zone and instant are two rows, neither
    replaces the other. A stream that has not committed yet has no rows; without any commit there is nothing to read.
    """
    found = [name for name in READINGS if name in tables.manifest(spark, root).schemas]
    if not found:
        raise FileNotFoundError(f"{root}: no readings committed")
    first, *rest = [read_latest(spark, f"{root}/{name}", as_of=as_of, hours=hours).drop("arrival", "batch_id") for name in found]
    return reduce(DataFrame.unionByName, rest, first)


def newest_first(readings: DataFrame) -> DataFrame:
    """Rows of a key together, newest first.

    Range partitions follow the full order, so a zone and hour with very many rows is cut
    into consecutive partitions instead of filling one.
    """
    order = ("grid_id", "hour_bucket", F.desc("event_time"))
    return readings.repartitionByRange(*order).sortWithinPartitions(*order)


def compact(spark: SparkSession, path: str, target: str) -> None:
    """Write the current rows to a new location as a single version per day."""
    (
        read_latest(spark, path).hint("rebalance", "dia_evento")
        .sortWithinPartitions("dia_evento", "batch_id", "grid_id", F.desc("event_time"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("dia_evento", "batch_id").parquet(target)
    )


def newest_versions(versions: DataFrame) -> DataFrame:
    """What merging the versions of a day keeps."""
    return latest_per_key(versions, ("dia_evento", *KEY), tuple(c for c in ORDER if c in versions.columns))


def compact_days(spark: SparkSession, path: str, before: dt.date) -> int:
    """Merge the versions of each closed day of a committed table into one, with the last version of each key."""
    return tables.compact(spark, path, before, newest_versions, ("grid_id", F.desc("event_time")))
