"""Keyed JSON messages for topics and queues."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from hazardlake import constants as k
from hazardlake.functions.hazard import critical_weather, risk_level, trigger_text
from hazardlake.functions.values import as_json, or_default


def critical_weather_alerts(events: DataFrame) -> DataFrame:
    """One message per valid event that is hot, dry and windy, keyed by zone."""
    temperature, humidity = or_default(F.col("temp_celsius"), 0.0), or_default(F.col("humidity_pct"), 100.0)
    wind = or_default(F.col("wind_kmh"), 0.0)
    body = as_json(
        "grid_id", "timestamp", "risk_score", risk_level(F.col("risk_score")).alias("risk_level"),
        temperature.alias("temp_celsius"), humidity.alias("humidity_pct"), wind.alias("wind_kmh"),
        or_default(F.col("hotspot_count"), 0).alias("hotspot_count"),
        or_default(F.col("source"), "unknown").alias("source"),
        trigger_text(temperature, humidity, wind).alias("trigger"),
    )
    return events.filter(critical_weather(temperature, humidity, wind)).select(
        F.col("grid_id").alias("key"), body.alias("value"))


def publications(events: DataFrame, topics: list[str], key: str | None = "grid_id",
                 constant_key: str | None = None) -> DataFrame:
    """Every event once per topic, keyed by a column or a constant."""
    message_key = F.lit(constant_key) if constant_key else F.col(key)
    return events.select(
        message_key.alias("key"), as_json(*events.columns).alias("value"),
        F.explode(F.array(*map(F.lit, topics))).alias("topic"))


def vegetation_publications(vegetation: DataFrame) -> DataFrame:
    return publications(vegetation, [k.SENSOR_TOPIC], constant_key=k.VEGETATION_KEY)


def message_sink(make: Callable[[DataFrame], DataFrame], path: str | None = None,
                 servers: str | None = None) -> Callable[[DataFrame, int], None]:
    """A sink for micro-batches: ``make(batch)`` is sent to a folder of envelope files, or to a broker.

    In a folder each batch owns its ``batch_id`` part, so a replay replaces its own messages and adds none. A broker
    gets a replayed batch again; its number is part of every message's headers, for consumers to drop what they have seen.
    """
    if (path is None) == (servers is None):
        raise ValueError("give a path or servers")

    def write(batch: DataFrame, batch_id: int) -> None:
        sent = make(batch)
        if path:
            sent.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")).write.mode("overwrite") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").json(path)
        else:
            number = F.struct(F.lit("batch_id").alias("key"), F.lit(str(int(batch_id))).cast("binary").alias("value"))
            write_broker(sent.withColumn("headers", F.array(number)), servers)

    return write


def write_folder(messages: DataFrame, path: str) -> None:
    """Append messages to a folder of envelope files, as a file-based topic."""
    messages.write.mode("append").json(path)


def write_broker(messages: DataFrame, servers: str) -> None:
    """Send messages to their topics; the connector orders them per key by partition."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
