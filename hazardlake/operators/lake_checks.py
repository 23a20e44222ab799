"""Inventory, freshness, availability and readiness of a lake, from file metadata only; columns from its stored rows.

File facts come from the ``binaryFile`` source without its content column: one row per
file, nothing is read from the files. Checks of columns read the datasets: one aggregate each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hazardlake import constants as k
from hazardlake.session import path_exists

FILES = "dataset string, path string, length bigint, modified timestamp"


def files(spark: SparkSession, path: str, dataset: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per data file below a path; a path that does not exist has none.

    Hidden folders, such as a streaming sink's commit log, are not listed.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], FILES)
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern).load(path)
    )
    # the source plans about one task per large file, far more than listing them needs
    return listing.select(
        F.lit(dataset).alias("dataset"), "path", "length", F.col("modificationTime").alias("modified"),
    ).coalesce(spark.sparkContext.defaultParallelism)


def partition_value(column: str) -> Column:
    value = F.regexp_extract("path", f"/{column}=([^/]+)/", 1)
    return F.when(value != "", value)


def folder() -> Column:
    """The folder of a file, which is its partition."""
    return F.regexp_extract("path", "^(.*)/", 1)


def loaded_partitions(listing: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Values of the partition columns that files exist for, with files and bytes; null where a path lacks one."""
    return listing.groupBy(*[partition_value(c).alias(c) for c in columns]).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"))


def inventory(listing: DataFrame) -> DataFrame:
    """Files, folders, kilobytes, distinct years and zones per dataset."""
    return listing.groupBy("dataset").agg(
        F.count("*").alias("files"),
        F.count_distinct(folder()).alias("folders"),
        (F.sum("length") / 1024).alias("kilobytes"),
        F.count_distinct(partition_value("ano")).alias("years"),
        F.count_distinct(partition_value("grid_id")).alias("zones"),
    )


def files_per_prefix(listing: DataFrame, root: str) -> DataFrame:
    """Objects, and folders that hold them, per top-level folder below ``root``."""
    relative = F.regexp_replace("path", "^[a-z0-9]+:/+", "/")
    base = F.regexp_replace(F.lit(root.rstrip("/") + "/"), "^[a-z0-9]+:/+", "/")
    below = F.expr("substring(_relative, length(_base) + 1)")
    return (
        listing.withColumns({"_relative": relative, "_base": base})
        .filter(F.startswith("_relative", F.col("_base")))
        .groupBy(F.split(below, "/")[0].alias("prefix")).agg(
            F.count("*").alias("objects"), F.count_distinct(folder()).alias("folders"))
    )


def filled_columns(df: DataFrame, columns, dataset: str) -> DataFrame:
    """One row per wanted column: whether the frame has it, the frame's rows and those that hold a value in it.

    One aggregate over the frame; an empty frame has its columns, with no rows. Column names are matched exactly.
    """
    have = [c for c in columns if c in df.columns]
    counts = df.agg(F.count("*").alias("rows"), F.array(*[F.count(F.col(f"`{c}`")) for c in have]).alias("counts"))

    def entry(column: str) -> Column:
        present = column in have
        filled = F.col("counts")[have.index(column)] if present else F.lit(0).cast("bigint")
        return F.struct(F.lit(column).alias("column_name"), F.lit(present).alias("present"), filled.alias("filled"))

    return counts.select(F.lit(dataset).alias("dataset"), "rows", F.inline(F.array(*[entry(c) for c in columns])))


def required_columns(datasets: dict[str, DataFrame], expected=None) -> DataFrame:
    """The expected columns of every dataset, with ``present``, ``rows`` and ``filled``; the missing ones are not present.

    A dataset that is not there (None) misses all of its columns and has no rows.
    """
    wanted = expected or k.EXPECTED_COLUMNS
    spark = next(df for df in datasets.values() if df is not None).sparkSession
    nothing = spark.createDataFrame([], "nothing string")
    checked = [filled_columns(nothing if df is None else df, wanted[name], name) for name, df in datasets.items()]
    return reduce(DataFrame.unionByName, checked)


def output_versions(stored: DataFrame) -> DataFrame:
    """Files, rows, zones and span of windows of each version that a stored composite table holds.

    A file is of version ``v2`` when each of its rows has all columns that the join of the three streams adds, which are
    never null there, else ``v1``. Read the folder with ``mergeSchema``, so that files of both versions can lie in it;
    a folder of old files only lacks the columns and is ``v1`` throughout.
    """
    joined = [c for c in k.EXPECTED_COLUMNS["agregados_streaming"] if c in stored.columns]
    whole = F.lit(len(joined) == len(k.EXPECTED_COLUMNS["agregados_streaming"]))
    for column in joined:
        whole = whole & F.col(column).isNotNull()
    rows = stored.select(F.col("_metadata.file_path").alias("file"), "grid_id", "janela_inicio", whole.alias("whole"))
    per_file = rows.groupBy("file", "grid_id").agg(
        F.count("*").alias("n"), F.bool_and("whole").alias("whole"),
        F.min("janela_inicio").alias("first"), F.max("janela_inicio").alias("last"))
    # zones have a fixed bound, so a file is a few rows here
    version = F.when(F.bool_and("whole").over(Window.partitionBy("file")), "v2").otherwise("v1").alias("version")
    return per_file.select("*", version).groupBy("version").agg(
        F.count_distinct("file").alias("files"), F.sum("n").alias("rows"), F.count_distinct("grid_id").alias("zones"),
        F.min("first").alias("first_window"), F.max("last").alias("last_window"))


def streaming_output(composite: DataFrame) -> DataFrame:
    return composite.agg(
        F.count("*").alias("rows"), F.count_distinct("grid_id").alias("zones"),
        F.min("risco_composto").alias("risk_min"), F.max("risco_composto").alias("risk_max"))


def readiness(inventories: DataFrame, components=k.LAKE_PREFIXES) -> DataFrame:
    """One row per component with its state, plus the verdict over all of them.

    Detections need files from several years, every other component needs files.
    """
    spark = inventories.sparkSession
    wanted = spark.createDataFrame([(c,) for c in components], "dataset string")
    enough_years = (F.col("dataset") != "hotspots") | (F.col("years") >= k.MIN_DETECTION_YEARS)
    state = wanted.join(F.broadcast(inventories), "dataset", "left").select(
        "dataset", F.coalesce((F.col("files") > 0) & enough_years, F.lit(False)).alias("ready"))
    ready = state.agg(F.count_if("ready")).scalar()
    return state.withColumn("ready_count", ready).withColumn(
        "verdict",
        F.when(F.col("ready_count") == len(components), "complete")
        .when(F.col("ready_count") >= 2, "partial").otherwise("incomplete"))


def freshness(source: DataFrame, target: DataFrame) -> DataFrame:
    """Per dataset: reload when the target has no file or an older one than the source."""
    def newest(listing: DataFrame, name: str) -> DataFrame:
        return listing.groupBy("dataset").agg(F.max("modified").alias(name))

    both = newest(source, "source_time").join(newest(target, "target_time"), "dataset", "full")
    return both.withColumn(
        "decision",
        F.when(F.col("source_time").isNull(), "no source")
        .when(F.col("target_time").isNull(), "load")
        .when(F.col("source_time") > F.col("target_time"), "reload")
        .otherwise("skip"))


def availability(listing: DataFrame, datasets) -> DataFrame:
    """Files, folders and state of every registered dataset, found or not."""
    spark = listing.sparkSession
    wanted = spark.createDataFrame([(d,) for d in datasets], "dataset string")
    counts = listing.groupBy("dataset").agg(F.count("*").alias("files"), F.count_distinct(folder()).alias("folders"))
    return wanted.join(counts, "dataset", "left").select(
        "dataset", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("folders", F.lit(0)).alias("folders"),
        F.when(F.col("files") > 0, "ready").otherwise("missing").alias("state"))


def column_catalogue(df: DataFrame, dataset: str, catalogue=None) -> DataFrame:
    """Catalogued columns with origin and description, whether the frame has them, and its rows and filled ones.

    Columns that the frame has beyond the catalogue follow as ``uncatalogued``, without a description.
    """
    entries = {column: (origin, text) for origin, columns in (catalogue or k.CATALOGUE[dataset]).items()
               for column, text in columns.items()}
    for column in df.columns:
        entries.setdefault(column, ("uncatalogued", ""))
    described = df.sparkSession.createDataFrame(
        [(c, *facts) for c, facts in entries.items()], "column_name string, origin string, description string")
    return filled_columns(df, list(entries), dataset).join(F.broadcast(described), "column_name").select(
        "dataset", "origin", "column_name", "description", "present", "rows", "filled")
