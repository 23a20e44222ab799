"""Gridded reanalysis as a long table, one row per instant and grid point."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazardlake import constants as k
from hazardlake.functions.calendar import with_calendar
from hazardlake.functions.climate import with_derived
from hazardlake.functions.geo import inside_box, wrap_longitude
from hazardlake.operators.access import union_all


def merge_by_coordinates(frames: list[DataFrame]) -> DataFrame:
    """Variables of several files in one table.

    Rows of the same instant and point are brought together; a variable present in more
    than one frame keeps its single non-null value.
    """
    aligned = [normalise_names(f) for f in frames]
    stacked = union_all(aligned)
    if len(aligned) == 1:
        return stacked
    key = ["time", "latitude", "longitude"]
    return stacked.groupBy(*key).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in key])


def normalise_names(df: DataFrame) -> DataFrame:
    if "valid_time" in df.columns and "time" not in df.columns:
        return df.withColumnRenamed("valid_time", "time")
    return df


def country_points(df: DataFrame) -> DataFrame:
    """Points with coordinates inside the country box, longitudes east of 180 wrapped."""
    wrapped = normalise_names(df).dropna(subset=["latitude", "longitude"]).withColumn(
        "longitude",
        F.when(F.col("longitude") > 180, wrap_longitude(F.col("longitude"))).otherwise(F.col("longitude")))
    return wrapped.filter(inside_box(F.col("latitude"), F.col("longitude")))


def refine(df: DataFrame) -> DataFrame:
    """Derived variables, calendar parts and risk flag added to country points."""
    return with_calendar(with_derived(country_points(df)), "time", ("ano", "mes", "dia", "hora"))


def keep_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in k.GRID_COLUMNS if c in df.columns])


def read_grid(spark: SparkSession, paths: list[str]) -> DataFrame:
    return merge_by_coordinates([spark.read.parquet(p) for p in paths])
