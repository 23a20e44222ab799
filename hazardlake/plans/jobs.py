"""Batch jobs: refine detections, refine the climate grid, publish the lake, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazardlake import constants as k
from hazardlake.functions.calendar import with_calendar
from hazardlake.operators import climate_grid as grid_ops, detections as det_ops, lake_checks, stats
from hazardlake.sinks import lake as sink
from hazardlake.sources import climate_grid as grid_src, detections as det_src


def refine_detections(spark: SparkSession, raw_path: str, csv_out: str, parquet_out: str) -> DataFrame:
    """Raw CSV folder to per-year cleaned CSV and Parquet; returns the cleaned frame."""
    cleaned = det_src.clean(det_src.read_csv(spark, raw_path))
    sink.write_yearly(cleaned, csv_out, parquet_out)
    return cleaned


def refine_grid(spark: SparkSession, paths: list[str], csv_out: str, parquet_out: str) -> DataFrame:
    refined = grid_src.keep_columns(grid_src.refine(grid_src.read_grid(spark, paths)))
    sink.write_yearly(refined, csv_out, parquet_out)
    return refined


def publish(detections: DataFrame | None, grid: DataFrame | None, root: str) -> dict[str, bool]:
    """Write what is available to the lake; tells which datasets were loaded."""
    if detections is not None:
        sink.publish_detections(det_src.with_zone(detections), f"{root}/hotspots")
    if grid is not None:
        sink.publish_grid(with_calendar(grid, "time", ("ano", "mes")), f"{root}/meteorologia")
    return {"hotspots": detections is not None, "meteorologia": grid is not None}


def lake_listing(spark: SparkSession, root: str) -> DataFrame:
    listings = [lake_checks.files(spark, f"{root}/{name}", name) for name in k.LAKE_PREFIXES]
    first, *rest = listings
    for listing in rest:
        first = first.unionByName(listing)
    return first


# Tables of the detections report by the counted rows that they come from.
CELL_TABLES = {f.__name__: f for f in (
    det_ops.peak_month, det_ops.top_region, det_ops.per_year, det_ops.frp_per_year, det_ops.per_month, det_ops.per_season,
    det_ops.density, det_ops.per_region, det_ops.frp_per_region, det_ops.satellite_share, det_ops.frp_year_satellite,
)} | {"high_season": det_ops.high_season_share, "year_month": det_ops.year_month_matrix}
VALUE_TABLES = {f.__name__: f for f in (
    det_ops.frp_summary, det_ops.frp_outliers, det_ops.frp_histogram, det_ops.frp_by_month, det_ops.frp_by_period,
    det_ops.frp_axis_cap)}


def detection_report(raw: DataFrame) -> dict[str, DataFrame]:
    """Every table and chart of the detections report.

    The raw input is read twice: for the profile of all rows, and to store the rows inside the country with the columns of
    the report. These are counted once by cell and once by value of FRP, and the counts are stored; all
    tables but those on whole rows and on several columns come from the counts.
    """
    columns = [c for c in k.DETECTION_COLUMNS if c in raw.columns]
    needed = list(dict.fromkeys([*columns, *det_ops.NUMERIC, "ano", "mes", "daynight", "satelite"]))
    kept = sink.stored(det_ops.in_country(raw).select(*needed), "report-rows")
    totals = sink.stored(det_ops.profile(raw), "report-profile")
    cells = sink.stored(det_ops.cells(kept), "report-cells")
    values = sink.stored(det_ops.frp_counts(kept), "report-values")
    return {
        "profile": totals,
        "outside_share": det_ops.outside_share_of(totals),
        "nulls": stats.null_profile(kept, columns),
        "duplicates": stats.duplicate_rows(kept.select(*columns)),
        "describe": det_ops.describe(kept),
        "correlations": det_ops.correlations(kept),
    } | {name: table(cells) for name, table in CELL_TABLES.items()} | {name: table(values) for name, table in VALUE_TABLES.items()}


def grid_report(points: DataFrame) -> dict[str, DataFrame]:
    """Every table and chart of the reanalysis report."""
    series = grid_ops.country_series(points)
    measures = [c for c in grid_ops.MEANS if c in points.columns and c != "dewpoint_c"]
    return {
        "profile": grid_ops.profile(points),
        "nulls": stats.null_profile(points),
        "duplicates": stats.duplicate_rows(points),
        "describe": stats.describe(points, measures),
        "monthly_temperature": grid_ops.monthly_temperature(series),
        "temperature_box": grid_ops.monthly_box(series, "temp_c"),
        "monthly_humidity": grid_ops.monthly_mean(series, "rh"),
        "dry_instants": grid_ops.dry_instants(series),
        "monthly_wind": grid_ops.monthly_mean(series, "wind_speed_kmh"),
        "wind_box": grid_ops.monthly_box(series, "wind_speed_kmh"),
        "monthly_precipitation": grid_ops.monthly_sum(series, "precip_mm_dia"),
        "temperature_by_hour": grid_ops.temperature_by_hour(series),
        "high_risk": grid_ops.high_risk_instants(series),
        "correlations": grid_ops.correlations(series),
        "temperature_map": grid_ops.temperature_map(points),
    }
