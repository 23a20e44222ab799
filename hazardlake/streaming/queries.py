"""Streaming queries: composite hazard, validating ingestion, running totals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from hazardlake import constants as k, schemas
from hazardlake.functions.calendar import latency_ms
from hazardlake.functions.values import safe_double
from hazardlake.operators import access, quality
from hazardlake.operators.windows import composite
from hazardlake.sinks import keyed, messages, tables
from hazardlake.sources import streams


def start(frame: DataFrame, checkpoint: str, mode: str = "append", once: bool = False,
          every: str = k.TRIGGER, sink: Callable[[DataFrame, int], None] | None = None,
          path: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Start a query with its own checkpoint: every 30 seconds, or over what is there now.

    ``state_partitions`` is the number of shuffle and state partitions. It is fixed by the
    first start of a checkpoint; by default the session's setting applies.
    """
    conf = frame.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    conf.set("spark.sql.shuffle.partitions", str(state_partitions or before))
    try:
        return _start(frame, checkpoint, mode, once, every, sink, path)
    finally:
        conf.set("spark.sql.shuffle.partitions", before)


def _start(frame, checkpoint, mode, once, every, sink, path) -> StreamingQuery:
    writer = frame.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    if sink is not None:
        return writer.foreachBatch(sink).start()
    return writer.format("parquet").option("path", path).start()


# --- composite hazard ------------------------------------------------------------------

def composite_stream(sensors: DataFrame, detections: DataFrame, weather: DataFrame,
                     window: str = k.WINDOW, slide: str = k.SLIDE,
                     watermark: str = k.WATERMARK) -> DataFrame:
    """Three watermarked window aggregates joined per (window, zone)."""
    return composite(sensors, detections, weather, window, slide, watermark)


def fan_out(sinks: list[Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """Give every sink the same micro-batch, computed once.

    One query with several sinks reads its sources and keeps its state once; separate
    queries would do both per sink.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def preview_sink(rows: int = 15) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.orderBy("janela_inicio", "grid_id").show(rows, truncate=False)
    return write


def partitioned_sink(path: str, *partitions: str) -> Callable[[DataFrame, int], None]:
    """Replayable append: each batch owns its ``batch_id`` partition."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", *partitions).parquet(path))
    return write


# --- validating ingestion ------------------------------------------------------------------

def _numbers(validated: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return validated.withColumns({n: safe_double(F.col(n)) for n in names if n in validated.columns})


SENSOR_NUMBERS = ("temp_celsius", "humidity_pct", "wind_kmh", "risk_score", "hotspot_count",
                  "latitude", "longitude")
DETECTION_NUMBERS = ("frp_mw", "brightness", "latitude", "longitude")


def _moment(spark: SparkSession, as_of: Column | None) -> tuple[Column, dt.datetime]:
    """The time of a batch, the same for all its rows and tables."""
    micros = spark.range(1).select(F.unix_micros(F.current_timestamp() if as_of is None else as_of)).first()[0]
    return F.timestamp_micros(F.lit(micros)), dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)


def sensor_sink(root: str, as_of: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Micro-batch of text candidates to readings, alerts, alert messages, quarantine, metrics.

    All eight tables are cut by day and become visible in one commit, see :mod:`hazardlake.sinks.tables`.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        now, written = _moment(batch.sparkSession, as_of)
        checked = quality.with_time_reason(quality.with_sensor_reasons(keyed.numbered(batch)))
        validated = checked.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = quality.split(validated)
            typed = _numbers(good, SENSOR_NUMBERS)
            readings = access.sensor_rows(typed).withColumn("written_at", now)
            record = quality.sensor_quarantine(bad, now)
            out = tables.Batch(batch.sparkSession, root, batch_id, written)
            out.add("sensor_readings", readings, F.to_date("event_time"), ("grid_id", F.desc("event_time")), "dia_evento")
            out.add("fire_alerts", access.alert_rows(readings), F.to_date("alert_time"), ("grid_id", F.desc("alert_time")))
            out.add("alert_messages", messages.critical_weather_alerts(typed), F.to_date(now), ("key",))
            out.add("quarantine", quality.as_messages(record, "grid_id"), F.to_date(now), ("key",))
            _add_points(out, "data_quality", quality.quality_points(_numbers(validated, SENSOR_NUMBERS), "event_time"), "source")
            _add_points(out, "rejected_events", quality.rejection_points(record), "reason", "grid_id")
            _add_points(out, "rejected_event_detail", quality.rejection_details(record), "grid_id")
            _add_points(out, "pipeline_latency", quality.latency_points(
                typed, latency_ms(F.col("event_time"), now), k.SENSOR_TOPIC, now), "topic", "grid_id")
            out.commit()
        finally:
            validated.unpersist()
    return write


def detection_sink(root: str, as_of: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Micro-batch of satellite candidates to readings, quarantine and metrics, in one commit.

    No table has a name that :func:`sensor_sink` uses, so both may share a root, and ``keyed.read_readings`` reads the
    rows of both streams as one table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        now, written = _moment(batch.sparkSession, as_of)
        checked = quality.with_time_reason(quality.with_detection_reasons(keyed.numbered(batch)))
        validated = checked.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good, bad = quality.split(validated)
            typed = _numbers(good, DETECTION_NUMBERS)
            record = quality.detection_quarantine(bad, now)
            out = tables.Batch(batch.sparkSession, root, batch_id, written)
            out.add("detection_readings", access.detection_rows(typed).withColumn("written_at", now),
                    F.to_date("event_time"), ("grid_id", F.desc("event_time")), "dia_evento")
            out.add("detection_quarantine", quality.as_messages(record, "grid_id"), F.to_date(now), ("key",))
            _add_points(out, "detection_quality", quality.quality_points(
                _numbers(validated, DETECTION_NUMBERS), "event_time", "detection_readings", suite=k.DETECTION_SUITE), "source")
            _add_points(out, "detection_rejected_events", quality.rejection_points(record), "reason", "grid_id")
            _add_points(out, "detection_latency", quality.latency_points(
                typed, latency_ms(F.col("event_time"), now), k.DETECTION_TOPIC, now), "topic", "grid_id")
            out.commit()
        finally:
            validated.unpersist()
    return write


def _add_points(out: tables.Batch, name: str, points: DataFrame, *tags: str) -> None:
    """Metric points by day, with each series together in time order."""
    out.add(name, points, F.to_date("_time"), (*tags, "_time"))


def sensor_candidates(envelopes: DataFrame) -> DataFrame:
    return streams.decode_for_validation(envelopes, schemas.SENSOR_TEXT)


def detection_candidates(envelopes: DataFrame) -> DataFrame:
    """Satellite candidates; radiative power under its older name is accepted too."""
    decoded = streams.decode_for_validation(envelopes, schemas.DETECTION_TEXT)
    return decoded.withColumn("frp_mw", F.coalesce("frp_mw", "frp")).drop("frp")


# --- running totals ------------------------------------------------------------------------

def running_counts(candidates: DataFrame) -> DataFrame:
    """Processed, valid and rejected events per source since the query began (update mode)."""
    return quality.batch_counts(quality.with_time_reason(quality.with_sensor_reasons(candidates)), ("source",))
