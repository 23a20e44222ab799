"""Casts, defaults, text classification, metric bands and record serialisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from hazardlake import constants as k


def safe_double(value: Column) -> Column:
    return value.try_cast("double")


def or_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def known_confidence(confidence: Column) -> Column:
    """True unless the detection is marked low; missing and numeric marks are kept."""
    return ~F.coalesce(F.lower(confidence.cast("string")), F.lit("nominal")).isin("low", "l")


def unknown_zone(grid_id: Column) -> Column:
    return grid_id.isNull() | grid_id.isin(*k.UNKNOWN_ZONES)


def zero_intensity(frp: Column) -> Column:
    """Valid but suspicious: a detection without radiative power."""
    return frp == 0


def _contains_any(text: Column, words) -> Column:
    return reduce(Column.__or__, (text.contains(word) for word in words))


def vegetation_risk(description: Column) -> Column:
    text = F.lower(description)
    chain = F
    for level, words in k.VEGETATION_WORDS:
        chain = chain.when(_contains_any(text, words), level)
    return chain.otherwise(k.VEGETATION_DEFAULT)


def satellite_of_file(file_name: Column) -> Column:
    text = F.lower(file_name)
    chain = F
    for satellite, marks in k.SATELLITE_FILE_MARKS:
        chain = chain.when(_contains_any(text, marks), satellite)
    return chain.otherwise(k.SATELLITE_DEFAULT)


def metric_band(metric: str, value: Column) -> Column:
    """Colour of the highest band whose lower edge the value reaches."""
    (base, _), *bands = k.METRIC_BANDS[metric]
    chain = F
    for colour, edge in reversed(bands):
        chain = chain.when(value >= edge, colour)
    return F.when(value.isNotNull(), chain.otherwise(base))


def as_json(*columns) -> Column:
    """JSON object text; null fields are written, as the record format has a fixed set of keys."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
