"""Profile of the gridded reanalysis.

Point frames carry ``time, latitude, longitude`` and the derived variables. The country
series (one row per instant) is the base of the monthly tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hazardlake.operators import stats

MEANS = ("temp_c", "dewpoint_c", "rh", "wind_speed_kmh", "precip_mm_dia", "evap_mm_dia")
CALENDAR = ("ano", "mes", "dia", "hora")
MONTHS = list(range(1, 13))
HOURS = list(range(24))


def country_series(points: DataFrame) -> DataFrame:
    """Mean of the variables over all grid points per instant, and whether any was high risk."""
    have = points.columns
    measures = [F.avg(c).alias(c) for c in MEANS if c in have]
    if "risco_alto" in have:
        measures.append(F.coalesce(F.bool_or("risco_alto"), F.lit(False)).alias("risco_alto"))
    # the calendar parts are functions of the instant, so any of their values will do
    measures += [F.min(c).alias(c) for c in CALENDAR if c in have]
    return points.groupBy("time").agg(*measures)


def monthly_temperature(series: DataFrame) -> DataFrame:
    return series.groupBy("mes").agg(
        F.avg("temp_c").alias("media"), F.max("temp_c").alias("maxima"), F.min("temp_c").alias("minima"))


def monthly_box(series: DataFrame, variable: str) -> DataFrame:
    return stats.box_statistics(series, variable, "mes", MONTHS)


def monthly_mean(series: DataFrame, variable: str) -> DataFrame:
    means = series.groupBy("mes").agg(F.avg(variable).alias("_mean"), F.count("*").alias("_instants"))
    # a month without instants reads 0, a month with only null values stays null
    return stats.every_month(means).select(
        "mes", F.when(F.col("_instants").isNull(), 0.0).otherwise(F.col("_mean")).alias(variable))


def monthly_sum(series: DataFrame, variable: str) -> DataFrame:
    sums = series.groupBy("mes").agg(F.coalesce(F.sum(variable), F.lit(0.0)).alias(variable))
    return stats.dense_months(sums, {variable: 0.0})


def monthly_count(series: DataFrame, condition, name: str) -> DataFrame:
    counts = series.filter(condition).groupBy("mes").agg(F.count("*").alias(name))
    return stats.dense_months(counts, {name: 0})


def dry_instants(series: DataFrame) -> DataFrame:
    return monthly_count(series, F.col("rh") < 20, "obs_secas")


def high_risk_instants(series: DataFrame) -> DataFrame:
    return monthly_count(series, F.col("risco_alto"), "obs_risco")


def temperature_by_hour(series: DataFrame) -> DataFrame:
    """One row per month, one mean-temperature column per hour of the day."""
    means = series.groupBy("mes").pivot("hora", HOURS).agg(F.avg("temp_c"))
    return means.select("mes", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in HOURS])


def correlations(series: DataFrame) -> DataFrame:
    return stats.correlations(
        series, ("temp_c", "rh", "wind_speed_kmh", "precip_mm_dia", "evap_mm_dia", "mes"))


def temperature_map(points: DataFrame) -> DataFrame:
    return points.groupBy("latitude", "longitude").agg(F.avg("temp_c").alias("temp_c"))


def temperature_map_matrix(points: DataFrame, longitudes) -> DataFrame:
    """The map as a latitude x longitude matrix for a given list of longitudes."""
    return points.groupBy("latitude").pivot("longitude", list(longitudes)).agg(F.avg("temp_c"))


def profile(points: DataFrame) -> DataFrame:
    """Headline figures of the point table in a single pass.

    Totals per (point, year) come first, as a plain hash aggregate over the rows; distinct
    points and years are counted on its result, which does not grow with the instants.
    """
    averaged = ("temp_c", "rh", "wind_speed_kmh")
    cells = points.groupBy("latitude", "longitude", "ano").agg(
        F.count("*").alias("n"), F.count_if("risco_alto").alias("risky"),
        F.min("time").alias("first"), F.max("time").alias("last"),
        F.min("temp_c").alias("coldest"), F.max("temp_c").alias("hottest"),
        F.max("wind_speed_kmh").alias("windiest"),
        *[F.sum(c).alias(f"sum_{c}") for c in averaged], *[F.count(c).alias(f"n_{c}") for c in averaged])

    def mean(c: str):
        return F.round(F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}")), 1)

    rows = F.coalesce(F.sum("n"), F.lit(0))
    risky = F.coalesce(F.sum("risky"), F.lit(0))
    return cells.agg(
        rows.alias("n_registos"),
        F.count_distinct("latitude", "longitude").alias("n_pts_grid"),
        F.date_format(F.min("first"), "yyyy-MM-dd").alias("periodo_ini"),
        F.date_format(F.max("last"), "yyyy-MM-dd").alias("periodo_fim"),
        F.array_join(F.array_sort(F.collect_set("ano")).cast("array<string>"), ",").alias("anos"),
        mean("temp_c").alias("temp_media"),
        F.round(F.max("hottest"), 1).alias("temp_max"), F.round(F.min("coldest"), 1).alias("temp_min"),
        mean("rh").alias("rh_media"), mean("wind_speed_kmh").alias("vento_medio"),
        F.round(F.max("windiest"), 1).alias("vento_max"),
        risky.alias("obs_risco"),
        F.round(risky * 100.0 / F.greatest(rows, F.lit(1)), 2).alias("pct_risco"),
    )
