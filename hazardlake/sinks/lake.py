"""Partitioned Parquet and CSV writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazardlake.session import new_folder

DETECTION_PARTITIONS = ("ano", "mes", "grid_id")
GRID_PARTITIONS = ("ano", "mes")


def write_partitioned(df: DataFrame, path: str, partitions: tuple[str, ...], fmt: str = "parquet",
                      mode: str = "overwrite", order: tuple = ()) -> None:
    """Replace the partitions the frame has rows for and leave all others alone.

    Publishing the same rows twice gives the same lake. The rebalance step gathers each
    partition's rows to avoid many small files, and lets AQE split a partition that
    outgrows one task, so a month or zone with a third of all rows is written by many.
    """
    gathered = df.hint("rebalance", *partitions)
    if order:
        gathered = gathered.sortWithinPartitions(*partitions, *order)
    writer = (gathered.write.mode(mode).partitionBy(*partitions)
              .option("partitionOverwriteMode", "dynamic"))
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def publish_detections(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, DETECTION_PARTITIONS)


def publish_grid(df: DataFrame, path: str) -> None:
    write_partitioned(df, path, GRID_PARTITIONS)


def write_yearly(df: DataFrame, csv_path: str, parquet_path: str) -> None:
    """Per-year CSV and Parquet; each root read as a whole is the combined dataset."""
    write_partitioned(df, csv_path, ("ano",), fmt="csv")
    write_partitioned(df, parquet_path, ("ano",))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back, so that its users do not run again what made it."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(tables: dict[str, DataFrame], path: str) -> None:
    """Report tables below one root, each as a Parquet dataset of its name."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")


def add_written_at(df: DataFrame, written_at=None) -> DataFrame:
    return df.withColumn("written_at", F.current_timestamp() if written_at is None else written_at)
