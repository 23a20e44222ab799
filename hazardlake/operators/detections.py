"""Profile of the historical satellite detections.

Frames carry ``latitude, longitude, bright_ti4, bright_ti5, frp, acq_date, confidence,
daynight, satelite`` and the calendar parts ``ano, mes, dia``. Most tables can also be
taken from counted rows: ``cells`` for counts and means, ``frp_counts`` for distributions of FRP.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazardlake import constants as k
from hazardlake.functions.calendar import day_period, month_label, season
from hazardlake.functions.geo import inside_box, outside_box, region
from hazardlake.operators import stats

NUMERIC = ("latitude", "longitude", "bright_ti4", "bright_ti5", "frp")
MONTHS = list(range(1, 13))
SATELLITES = [name for name, _ in k.SATELLITE_FILE_MARKS] + [k.SATELLITE_DEFAULT]


def in_country(df: DataFrame) -> DataFrame:
    return df.filter(inside_box(F.col("latitude"), F.col("longitude")))


def out_of_country(df: DataFrame) -> DataFrame:
    return df.filter(outside_box(F.col("latitude"), F.col("longitude")))


# --- counted rows -------------------------------------------------------------------------

def cells(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Rows counted by month, satellite, region and rounded place, with what means of FRP need."""
    return df.groupBy(
        "ano", "mes", "satelite", region(F.col("latitude")).alias("regiao"),
        F.round("latitude", decimals).alias("latitude"), F.round("longitude", decimals).alias("longitude"),
    ).agg(F.count("*").alias("_n"), F.sum("frp").alias("_frp"), F.count("frp").alias("_frps"))


def frp_counts(df: DataFrame) -> DataFrame:
    """Rows counted by value of FRP, month and time of day."""
    return df.groupBy("frp", "mes", "daynight").agg(F.count("*").alias("_n"))


def _weight(df: DataFrame) -> str | None:
    return "_n" if "_n" in df.columns else None


def _hotspots(df: DataFrame) -> Column:
    return stats.rows_of(_weight(df)).alias("hotspots")


def _mean_frp(df: DataFrame) -> Column:
    if "_frps" in df.columns:
        return F.try_divide(F.sum("_frp"), F.sum("_frps"))
    if _weight(df):
        return F.try_divide(F.sum(F.col("frp") * F.col("_n")), F.sum(F.when(F.col("frp").isNotNull(), F.col("_n"))))
    return F.avg("frp")


def _region(df: DataFrame) -> Column:
    return F.col("regiao") if "_frps" in df.columns else region(F.col("latitude"))


# --- counts and means -----------------------------------------------------------------

def per_year(df: DataFrame) -> DataFrame:
    return df.groupBy("ano").agg(_hotspots(df))


def frp_per_year(df: DataFrame) -> DataFrame:
    return df.groupBy("ano").agg(_mean_frp(df).alias("frp_medio"))


def per_month(df: DataFrame) -> DataFrame:
    counts = df.groupBy("mes").agg(_hotspots(df))
    return stats.dense_months(counts, {"hotspots": 0})


def year_month_matrix(df: DataFrame) -> DataFrame:
    """One row per year, one count column per month label, zero where nothing was seen."""
    counts = df.groupBy("ano").pivot("mes", MONTHS).agg(_hotspots(df))
    return counts.select("ano", *[
        F.coalesce(F.col(f"`{m}`"), F.lit(0)).alias(k.MONTH_LABELS[m - 1]) for m in MONTHS])


def per_season(df: DataFrame) -> DataFrame:
    return df.groupBy(season(F.col("mes")).alias("epoca")).agg(_hotspots(df))


def per_region(df: DataFrame) -> DataFrame:
    counts = df.groupBy(_region(df).alias("regiao")).agg(_hotspots(df))
    return counts.orderBy(F.desc("hotspots"), "regiao")


def frp_per_region(df: DataFrame) -> DataFrame:
    means = df.groupBy(_region(df).alias("regiao")).agg(_mean_frp(df).alias("frp_medio"))
    return means.orderBy("frp_medio", "regiao")


def satellite_share(df: DataFrame) -> DataFrame:
    """Count and percentage per satellite; no rows when there is a single satellite."""
    counts = df.groupBy("satelite").agg(_hotspots(df))
    totals = counts.filter("satelite IS NOT NULL").agg(
        F.sum("hotspots").alias("_all"), F.count("*").alias("_satellites"))
    return (
        stats.attach(counts.filter("satelite IS NOT NULL"), totals)
        .filter("_satellites > 1")
        .select("satelite", "hotspots",
                F.round(F.col("hotspots") * 100.0 / F.col("_all"), 1).alias("pct"))
    )


def frp_year_satellite(df: DataFrame, satellites=SATELLITES) -> DataFrame:
    """Mean FRP with one row per year and one column per listed satellite; gaps stay null."""
    return df.groupBy("ano").pivot("satelite", list(satellites)).agg(_mean_frp(df))


def density(df: DataFrame, decimals: int = 2) -> DataFrame:
    """Detections and mean FRP per rounded location."""
    return df.groupBy(
        F.round("latitude", decimals).alias("latitude"), F.round("longitude", decimals).alias("longitude")
    ).agg(_hotspots(df), _mean_frp(df).alias("frp_medio"))


# --- FRP distribution -------------------------------------------------------------------

def frp_histogram(df: DataFrame, bins: int = 60) -> DataFrame:
    """Histogram of FRP limited to its 99th percentile, with the unlimited median."""
    limits = stats.quantiles(df, "frp", {"lo": 0.0, "hi": 0.99, "mediana": 0.5}, weight=_weight(df))
    values = df.select(F.col("frp").cast("double").alias("v"), *([_weight(df)] if _weight(df) else []))
    return stats.bars_of_one(values, limits, bins, _weight(df))


def frp_by_month(df: DataFrame) -> DataFrame:
    """Box statistics of FRP in the fire-season months."""
    labels = [k.MONTH_LABELS[m - 1] for m in k.FIRE_SEASON_MONTHS]
    rows = df.filter(F.col("mes").isin(*k.FIRE_SEASON_MONTHS)).withColumn("mes_l", month_label(F.col("mes")))
    return stats.box_statistics(rows, "frp", "mes_l", labels, _weight(df))


def frp_by_period(df: DataFrame) -> DataFrame:
    rows = df.withColumn("periodo", day_period(F.col("daynight")))
    return stats.box_statistics(rows, "frp", "periodo", list(k.DAY_PERIODS.values()), _weight(df))


def frp_axis_cap(df: DataFrame) -> DataFrame:
    return stats.quantiles(df, "frp", {"p95": 0.95}, weight=_weight(df))


def frp_summary(df: DataFrame) -> DataFrame:
    extremes = df.agg(F.round(_mean_frp(df), 1).alias("frp_media"), F.round(F.max("frp"), 1).alias("frp_max"))
    median = stats.quantiles(df, "frp", {"m": 0.5}, weight=_weight(df)).select(F.round("m", 1).alias("frp_mediana"))
    return stats.attach(extremes, median)


def frp_outliers(df: DataFrame) -> DataFrame:
    """Detections above the third quartile by more than three interquartile ranges."""
    quartiles = stats.quantiles(df, "frp", {"q1": 0.25, "q3": 0.75}, weight=_weight(df))
    limit = quartiles.select(F.col("q3") + 3 * (F.col("q3") - F.col("q1")))
    return df.agg(stats.rows_of(_weight(df), F.col("frp") > limit.scalar()).alias("frp_outliers"))


# --- single figures -------------------------------------------------------------------------

def profile(raw: DataFrame) -> DataFrame:
    """Row counts inside and outside the country, period, years and satellites, in one pass.

    Counting per (year, satellite) first keeps the pass over the rows a plain hash
    aggregate; the sets are collected from its few result rows.
    """
    inside = inside_box(F.col("latitude"), F.col("longitude"))
    parts = raw.groupBy("ano", "satelite").agg(
        F.count("*").alias("raw"), F.count_if(inside).alias("kept"),
        F.count_if(outside_box(F.col("latitude"), F.col("longitude"))).alias("outside"),
        F.min(F.when(inside, F.col("acq_date"))).alias("first"),
        F.max(F.when(inside, F.col("acq_date"))).alias("last"))

    def seen(name: str):
        values = F.array_sort(F.collect_set(F.when(F.col("kept") > 0, F.col(name))))
        return F.array_join(values.cast("array<string>"), ",")

    return parts.agg(
        F.coalesce(F.sum("raw"), F.lit(0)).alias("total_raw"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("total_pt"),
        F.coalesce(F.sum("outside"), F.lit(0)).alias("fora_bbox"),
        F.min("first").alias("periodo_ini"), F.max("last").alias("periodo_fim"),
        seen("ano").alias("anos"), seen("satelite").alias("satelites"),
        F.lit(len(raw.columns)).alias("colunas"),
    )


def peak_month(df: DataFrame) -> DataFrame:
    counts = df.groupBy("mes").agg(_hotspots(df))
    return (counts.orderBy(F.desc("hotspots"), "mes").limit(1)
            .select(month_label(F.col("mes")).alias("mes_pico"), "hotspots"))


def high_season_share(df: DataFrame) -> DataFrame:
    known = stats.rows_of(_weight(df), F.col("mes").isNotNull())
    share = F.try_divide(stats.rows_of(_weight(df), F.col("mes").between(7, 10)), known) * 100
    return df.agg(F.round(share, 1).alias("pct_verao"))


def top_region(df: DataFrame) -> DataFrame:
    return per_region(df).limit(1).select(F.col("regiao").alias("regiao_top"), "hotspots")


def outside_share(raw: DataFrame) -> DataFrame:
    outside = F.count_if(outside_box(F.col("latitude"), F.col("longitude")))
    return raw.agg(F.when(F.count("*") > 0, F.round(outside * 100.0 / F.count("*"), 2)).alias("fora_pct"))


def outside_share_of(profile: DataFrame) -> DataFrame:
    """The same from the one row of ``profile``."""
    return profile.select(F.when(
        F.col("total_raw") > 0, F.round(F.col("fora_bbox") * 100.0 / F.col("total_raw"), 2)).alias("fora_pct"))


def correlations(df: DataFrame) -> DataFrame:
    return stats.correlations(df, (*NUMERIC, "mes", "ano"))


def describe(df: DataFrame) -> DataFrame:
    return stats.describe(df, NUMERIC)
