"""Derived weather variables of the gridded reanalysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazardlake.functions.hazard import critical_weather

SECONDS_PER_DAY = 86400


def celsius(kelvin: Column) -> Column:
    return kelvin - 273.15


def wind_speed_kmh(east: Column, north: Column) -> Column:
    return F.sqrt(east * east + north * north) * 3.6


def relative_humidity(temperature: Column, dew_point: Column) -> Column:
    """Magnus formula, limited to 0..100; null when an input is null."""
    def saturation(t: Column) -> Column:
        return F.exp(17.625 * t / (243.04 + t))

    humidity = 100 * saturation(dew_point) / saturation(temperature)
    return F.when(humidity.isNotNull(), F.least(F.lit(100.0), F.greatest(F.lit(0.0), humidity)))


def daily_precipitation(rate: Column) -> Column:
    return F.when(rate.isNotNull(), F.greatest(rate, F.lit(0.0)) * SECONDS_PER_DAY)


def daily_evaporation(rate: Column) -> Column:
    return F.abs(rate) * SECONDS_PER_DAY


# result column -> (columns it needs, expression)
DERIVATIONS = {
    "temp_c": (("t2m",), celsius),
    "dewpoint_c": (("d2m",), celsius),
    "wind_speed_kmh": (("u10", "v10"), wind_speed_kmh),
    "rh": (("temp_c", "dewpoint_c"), relative_humidity),
    "precip_mm_dia": (("mtpr",), daily_precipitation),
    "evap_mm_dia": (("mer",), daily_evaporation),
}


def with_derived(df: DataFrame) -> DataFrame:
    """Add each derived variable whose inputs are present, then the high-risk flag."""
    for name, (inputs, formula) in DERIVATIONS.items():
        if all(column in df.columns for column in inputs):
            df = df.withColumn(name, formula(*(F.col(column) for column in inputs)))
    present = {
        role: F.col(column)
        for role, column in (("temperature", "temp_c"), ("humidity", "rh"), ("wind", "wind_speed_kmh"))
        if column in df.columns
    }
    return df.withColumn("risco_alto", critical_weather(**present)) if present else df
