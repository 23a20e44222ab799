"""Lake scans: combined or per-year Parquet, partitioned datasets, keyed-table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazardlake.session import path_exists


def read_combined_or_yearly(spark: SparkSession, folder: str, prefix: str) -> DataFrame | None:
    """``<prefix>_todos`` when present, else all ``<prefix>_<year>`` files, else None."""
    combined = f"{folder}/{prefix}_todos.parquet"
    if path_exists(spark, combined):
        return spark.read.parquet(combined)
    if not path_exists(spark, folder):
        return None
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{prefix}_*.parquet")
    matches = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root)
    if not matches:
        return None
    return spark.read.option("mergeSchema", "true").parquet(f"{folder}/{prefix}_*.parquet")


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """Partitioned dataset with its path columns; year and month are whole numbers."""
    df = spark.read.parquet(path)
    for name, kind in (("ano", "int"), ("mes", "int"), ("grid_id", "string")):
        if name in df.columns and df.schema[name].dataType.simpleString() != kind:
            df = df.withColumn(name, F.col(name).cast(kind))
    return df


def read_readings(spark: SparkSession, path: str, columns: list[str], n: int | None = None) -> DataFrame:
    """Projection of a keyed table, with the row limit of an ad-hoc look where one is given."""
    df = spark.read.parquet(path).select(*columns)
    return df if n is None else df.limit(n)
