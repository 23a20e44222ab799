"""Event streams: a broker or a folder of envelope files, decoded by one function.

An envelope row has a ``key``, a JSON ``value`` and its place of ``arrival``, which puts messages
in the order they were sent. Decoding does not depend on where a row came from, in batch or in
streaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazardlake import schemas
from hazardlake.functions.calendar import parse_instant


def broker_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_per_trigger: int | None = None) -> DataFrame:
    """Envelope stream of a topic, from new data on unless told otherwise.

    Needs the Kafka connector on the class path.
    """
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().withColumn("arrival", F.struct("timestamp", "partition", "offset"))


def envelope_folder(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Envelope stream of the JSON-lines files that arrive in a folder."""
    reader = spark.readStream.schema(schemas.ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_file_arrival(reader.json(path))


def envelope_batch(spark: SparkSession, path: str) -> DataFrame:
    return _with_file_arrival(spark.read.schema(schemas.ENVELOPE).json(path))


def _with_file_arrival(rows: DataFrame) -> DataFrame:
    """Files in the order they were written; lines of a file are numbered where they are stored."""
    parts = ("file_modification_time", "file_path", "file_block_start")
    return rows.select("*", F.struct(*[F.col(f"_metadata.{p}").alias(p) for p in parts]).alias("arrival"))


def decode(envelopes: DataFrame, schema: str, time_field: str = "timestamp",
           carried: tuple[str, ...] = ()) -> DataFrame:
    """Message bytes to typed columns and an event time, with the ``carried`` envelope columns.

    Undeclared fields are ignored; wrongly typed fields and unreadable times become null.
    """
    return (
        envelopes.select(F.from_json(F.col("value").cast("string"), schema).alias("d"), *carried)
        .select("d.*", *carried)
        .withColumn("event_time", parse_instant(F.col(time_field)))
    )


def decode_sensors(envelopes: DataFrame) -> DataFrame:
    return decode(envelopes, schemas.SENSOR)


def decode_detections(envelopes: DataFrame) -> DataFrame:
    """Detections with radiative power in ``frp``, whichever of its two names was sent."""
    return decode(envelopes, schemas.DETECTION).withColumn("frp", F.coalesce("frp", "frp_mw")).drop("frp_mw")


def decode_weather(envelopes: DataFrame) -> DataFrame:
    return decode(envelopes, schemas.WEATHER)


def decode_for_validation(envelopes: DataFrame, schema: str) -> DataFrame:
    """Candidate fields as text, see :mod:`hazardlake.schemas`, and the place of arrival where rows carry it."""
    return decode(envelopes, schema, carried=tuple(c for c in ("arrival",) if c in envelopes.columns))
