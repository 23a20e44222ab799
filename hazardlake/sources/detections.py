"""Historical detections: CSV folders and the near-real-time feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazardlake import constants as k, schemas
from hazardlake.functions.calendar import with_calendar
from hazardlake.functions.geo import nearest_zone
from hazardlake.functions.values import known_confidence, satellite_of_file
from hazardlake.operators.access import union_all
from hazardlake.operators.detections import in_country
from hazardlake.session import path_exists


def read_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All detection files of the given files and folders, columns matched by name.

    Column types are declared, not inferred; a column without a declared type is text. The
    column order is taken from the header of each given path, paths with the same header
    share one scan, and columns a path lacks are null. A file whose header differs from
    the rest of its folder stops the scan instead of shifting values.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path in [paths] if isinstance(paths, str) else paths:
        header = tuple(spark.read.option("header", "true").csv(path).columns)
        layouts.setdefault(header, []).append(path)

    def scan(header: tuple[str, ...], members: list[str]) -> DataFrame:
        schema = ", ".join(f"`{c}` {schemas.DETECTION_CSV.get(c, 'string')}" for c in header)
        raw = (spark.read.schema(schema).option("header", "true").option("enforceSchema", "false")
               .csv(members))
        return raw.withColumn("satelite", satellite_of_file(F.col("_metadata.file_name")))

    named = union_all([scan(header, members) for header, members in layouts.items()])
    return with_calendar(named, "acq_date") if "acq_date" in named.columns else named


def keep_columns(df: DataFrame, columns=k.DETECTION_COLUMNS) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in columns if c in df.columns])


def clean(raw: DataFrame) -> DataFrame:
    """Historical cleaning: country box and stored columns; low confidence is kept."""
    return keep_columns(in_country(raw))


def with_zone(df: DataFrame) -> DataFrame:
    """Add the zone of each point unless the frame already has one."""
    if "grid_id" in df.columns:
        return df
    return df.withColumn("grid_id", nearest_zone(F.col("latitude"), F.col("longitude")))


def read_clean_or_raw(spark: SparkSession, clean_path: str, raw_paths: str | list[str]) -> DataFrame | None:
    """Cleaned Parquet when it exists, else those raw CSV folders that do through the same cleaning, else None."""
    if path_exists(spark, clean_path):
        return keep_columns(spark.read.parquet(clean_path))
    raw = [p for p in ([raw_paths] if isinstance(raw_paths, str) else raw_paths) if path_exists(spark, p)]
    return clean(read_csv(spark, raw)) if raw else None


def normalise_feed(feed: DataFrame, received_at: Column | None = None,
                   satellite: str = "VIIRS_SNPP_NRT") -> DataFrame:
    """Near-real-time feed rows as detection events.

    Low-confidence rows are dropped, brightness falls back to the older column name, and
    every row gets the zone of its nearest centroid.
    """
    def optional(*names: str) -> list[Column]:
        return [F.col(n) for n in names if n in feed.columns]

    confidence = F.col("confidence") if "confidence" in feed.columns else F.lit(None).cast("string")
    when = F.current_timestamp() if received_at is None else received_at
    return feed.filter(known_confidence(confidence)).select(
        nearest_zone(F.col("latitude"), F.col("longitude")).alias("grid_id"),
        "latitude", "longitude",
        when.alias("timestamp"),
        F.coalesce(*optional("bright_ti4", "brightness"), F.lit(0.0)).cast("double").alias("brightness"),
        F.coalesce(*optional("frp"), F.lit(0.0)).cast("double").alias("frp_mw"),
        F.lower(F.coalesce(confidence.cast("string"), F.lit("nominal"))).alias("confidence"),
        F.coalesce(*optional("satellite"), F.lit(satellite)).alias("satellite"),
        F.coalesce(*[c.cast("string") for c in optional("acq_date")], F.lit("")).alias("acq_date"),
        F.coalesce(*[c.cast("string") for c in optional("acq_time")], F.lit("")).alias("acq_time"),
        F.lit(k.DETECTION_SOURCE).alias("source"),
    )
