"""Risk score, risk level, composite hazard and alert predicates as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from hazardlake import constants as k


def _points(term: Column, cap: int) -> Column:
    return F.least(F.lit(float(cap)), F.greatest(F.lit(0.0), term))


def risk_score(temperature: Column, humidity: Column, wind: Column, hotspots: Column) -> Column:
    """0-100 score with one decimal; null when any input is null."""
    score = (
        _points((temperature - 15) * 1.5, 40)
        + _points((100 - humidity) * 0.4, 30)
        + _points(wind * 0.5, 20)
        + F.least(F.lit(10.0), hotspots * 3.0)
    )
    # least() and greatest() skip nulls, so missing inputs have to be ruled out explicitly.
    complete = temperature.isNotNull() & humidity.isNotNull() & wind.isNotNull() & hotspots.isNotNull()
    return F.when(complete, F.round(F.least(F.lit(100.0), score), 1))


def stepped(value: Column, steps, otherwise) -> Column:
    """Label of the first step whose lower edge the value reaches; steps go downwards."""
    (edge, label), *rest = steps
    start = F.when(value >= edge, label)
    return reduce(lambda chain, step: chain.when(value >= step[0], step[1]), rest, start).otherwise(otherwise)


def risk_level(score: Column) -> Column:
    return stepped(score, k.RISK_LEVELS, k.LOWEST_LEVEL)


def is_alert(score: Column) -> Column:
    return risk_level(score).isin(*k.ALERT_LEVELS)


def composite_hazard(sensor_risk: Column, frp: Column, wind: Column, clamp: bool = False) -> Column:
    """Weighted index of the three sources; an absent source weighs nothing.

    The index is not limited to 100 unless ``clamp`` is set, since FRP has no such limit.
    """
    def share(part: Column, scale: float) -> Column:
        return F.coalesce(part, F.lit(0.0)) / scale * 100.0

    index = (
        F.coalesce(sensor_risk, F.lit(0.0)) * k.SENSOR_WEIGHT
        + share(frp, k.FRP_SCALE) * k.DETECTION_WEIGHT
        + share(wind, k.WIND_SCALE) * k.WEATHER_WEIGHT
    )
    return F.least(F.lit(100.0), index) if clamp else index


def critical_weather(temperature: Column | None = None, humidity: Column | None = None,
                     wind: Column | None = None) -> Column:
    """Hot, dry and windy at once, strictly; conditions on absent columns are left out."""
    tests = []
    if temperature is not None:
        tests.append(temperature > k.HOT_ABOVE)
    if humidity is not None:
        tests.append(humidity < k.DRY_BELOW)
    if wind is not None:
        tests.append(wind > k.WINDY_ABOVE)
    return reduce(Column.__and__, tests)


def trigger_text(temperature: Column, humidity: Column, wind: Column) -> Column:
    return F.concat(
        F.lit("temp>"), temperature.cast("string"), F.lit("C hum<"), humidity.cast("string"),
        F.lit("% vento>"), wind.cast("string"), F.lit("kmh"),
    )
