"""Sliding-window aggregates per zone and their three-way join.

The same functions serve batch and streaming frames. Grouping is always by (window, zone):
partial aggregation keeps one row per task and group before the shuffle, so a zone that
holds a third of all events sends no more rows than any other.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from hazardlake import constants as k
from hazardlake.functions.hazard import composite_hazard
from hazardlake.functions.values import or_default

SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


class Measure(NamedTuple):
    """An aggregate of a window; ``how`` is count, avg or max."""

    name: str
    how: str
    column: str = "*"

    def direct(self) -> Column:
        return getattr(F, self.how)(self.column).alias(self.name)

    def parts(self) -> list[Column]:
        """What a part of a window contributes."""
        if self.how == "avg":
            return [F.sum(self.column).alias(f"{self.name}_sum"), F.count(self.column).alias(f"{self.name}_n")]
        return [self.direct()]

    def merged(self) -> Column:
        """The aggregate over the parts of a window."""
        if self.how == "avg":
            return F.try_divide(F.sum(f"{self.name}_sum"), F.sum(f"{self.name}_n")).alias(self.name)
        return (F.max if self.how == "max" else F.sum)(self.name).alias(self.name)


SENSOR_MEASURES = (
    Measure("n_leituras_sensor", "count"), Measure("risk_medio_sensor", "avg", "risk_score"),
    Measure("risk_maximo_sensor", "max", "risk_score"), Measure("temp_media", "avg", "temp_celsius"),
    Measure("humidade_media", "avg", "humidity_pct"), Measure("vento_medio", "avg", "wind_kmh"),
)
DETECTION_MEASURES = (
    Measure("n_hotspots", "count"), Measure("frp_medio", "avg", "frp"), Measure("frp_maximo", "max", "frp"),
    Measure("brightness_media", "avg", "brightness"),
)
WEATHER_MEASURES = (
    Measure("temp_max_media", "avg", "temp_max"), Measure("humidade_ipma", "avg", "humidity_avg"),
    Measure("vento_max_ipma", "avg", "wind_max_kmh"), Measure("precipitacao_media", "avg", "precipitation_mm"),
)


def _seconds(duration: str) -> int:
    amount, unit = duration.split()
    return int(amount) * SECONDS[unit.rstrip("s")]


def _summarise(events: DataFrame, measures: tuple[Measure, ...], window: str, slide: str,
               watermark: str | None, time: str) -> DataFrame:
    """One row per (window, zone).

    In batch, events are first summed up per slide, once each, and the few results are merged
    into the windows that overlap them; otherwise every event would be aggregated once per
    window it falls in. A stream decides per window whether an event is late, so there
    the windows are aggregated directly.
    """
    if watermark:
        events = events.withWatermark(time, watermark)
    length, step = _seconds(window), _seconds(slide)
    if events.isStreaming or length % step:
        return events.groupBy(F.window(time, window, slide), "grid_id").agg(*[m.direct() for m in measures])
    slices = events.groupBy(F.window(time, slide).alias("slice"), "grid_id").agg(
        *[part for m in measures for part in m.parts()])

    def shifted(seconds: int) -> Column:
        return F.col("slice.start") + F.expr(f"INTERVAL '{seconds}' SECOND")

    overlapping = F.array(*[
        F.struct(shifted(-back).alias("start"), shifted(length - back).alias("end"))
        for back in range(0, length, step)])
    return slices.withColumn("window", F.explode(overlapping)).groupBy("window", "grid_id").agg(
        *[m.merged() for m in measures])


def sensor_windows(events: DataFrame, window: str = k.WINDOW, slide: str = k.SLIDE,
                   watermark: str | None = None, time: str = "event_time") -> DataFrame:
    return _summarise(events, SENSOR_MEASURES, window, slide, watermark, time)


def detection_windows(events: DataFrame, window: str = k.WINDOW, slide: str = k.SLIDE,
                      watermark: str | None = None, time: str = "event_time") -> DataFrame:
    return _summarise(events, DETECTION_MEASURES, window, slide, watermark, time)


def weather_windows(events: DataFrame, window: str = k.WINDOW, slide: str = k.SLIDE,
                    watermark: str | None = None, time: str = "event_time") -> DataFrame:
    return _summarise(events, WEATHER_MEASURES, window, slide, watermark, time)


def join_sources(sensors: DataFrame, detections: DataFrame, weather: DataFrame) -> DataFrame:
    """Keep every sensor window; both inputs are already partitioned by the join key."""
    key = ["window", "grid_id"]
    return sensors.join(detections, key, "left").join(weather, key, "left")


def composite_columns(joined: DataFrame) -> DataFrame:
    """The 17 columns of the composite table."""
    as_is = k.COMPOSITE_CATALOGUE
    return joined.select(
        F.col("window.start").alias("janela_inicio"),
        F.col("window.end").alias("janela_fim"),
        "grid_id",
        *as_is["sensor-events"],
        or_default(F.col("n_hotspots"), 0).alias("n_hotspots"),
        or_default(F.col("frp_medio"), 0.0).alias("frp_medio"),
        or_default(F.col("frp_maximo"), 0.0).alias("frp_maximo"),
        *as_is["weather-data"],
        composite_hazard(F.col("risk_medio_sensor"), F.col("frp_medio"), F.col("vento_max_ipma"))
        .alias("risco_composto"),
    )


def composite(sensors: DataFrame, detections: DataFrame, weather: DataFrame, window: str = k.WINDOW,
              slide: str = k.SLIDE, watermark: str | None = None) -> DataFrame:
    """Composite table of zones, in batch and in streaming.

    Rows without a zone take no part: they can match nothing, and a stream need not keep state
    for them. Ingestion quarantines and counts them.
    """
    sensors, detections, weather = (frame.filter("grid_id IS NOT NULL") for frame in (sensors, detections, weather))
    return composite_columns(join_sources(
        sensor_windows(sensors, window, slide, watermark),
        detection_windows(detections, window, slide, watermark),
        weather_windows(weather, window, slide, watermark),
    ))
