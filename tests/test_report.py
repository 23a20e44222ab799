"""The detections report: every table from counted rows equals the table from the rows themselves."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hazardlake import constants as k
from hazardlake.operators import detections as ops, stats
from hazardlake.plans import jobs
from hazardlake.session import new_folder
from hazardlake.sinks import lake as sink


def archive(spark, n):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        day = dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(900))
        hot = i % 3 == 0  # one place, month, satellite and value hold a third of the rows
        rows.append((
            40.1234 if hot else rng.uniform(36.0, 43.0), -8.1 if hot else rng.uniform(-10.0, -6.0),
            rng.uniform(300, 360), None if i % 11 == 0 else rng.uniform(280, 300),
            7.5 if hot else None if i % 13 == 0 else round(rng.expovariate(0.1), 1), dt.date(2021, 8, 1) if hot else day,
            rng.choice(["D", "N", None]), "VIIRS S-NPP" if hot else rng.choice(["VIIRS S-NPP", "VIIRS NOAA-20", None])))
    rows += rows[:5]  # whole rows that repeat
    frame = spark.createDataFrame(rows, "latitude double, longitude double, bright_ti4 double, bright_ti5 double, frp double, "
                                  "acq_date date, daynight string, satelite string") if rows else None
    if frame is None:
        return archive(spark, 1).limit(0)
    return frame.withColumns({"ano": F.year("acq_date"), "mes": F.month("acq_date"), "dia": F.dayofmonth("acq_date")})


def plain(raw):
    """Each table from a scan of its own."""
    kept = ops.in_country(raw)
    columns = [c for c in k.DETECTION_COLUMNS if c in kept.columns]
    names = ("describe frp_summary frp_outliers peak_month top_region per_year frp_per_year per_month per_season density per_region "
             "frp_per_region frp_histogram frp_by_month frp_by_period satellite_share frp_year_satellite correlations frp_axis_cap")
    return {name: getattr(ops, name)(kept) for name in names.split()} | {
        "profile": ops.profile(raw), "outside_share": ops.outside_share(raw), "nulls": stats.null_profile(kept, columns),
        "duplicates": stats.duplicate_rows(kept.select(*columns)), "high_season": ops.high_season_share(kept),
        "year_month": ops.year_month_matrix(kept)}


def values(table):
    def rounded(v):
        return round(v, 6) + 0.0 if isinstance(v, float) else v

    return sorted(([rounded(v) for v in r] for r in table.collect()), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("n", [3000, 0])
def test_every_table_of_the_report(spark, n):
    raw = archive(spark, n)
    root = new_folder(spark, "report")
    report, expected = jobs.detection_report(raw), plain(raw)
    assert set(report) == set(expected) and len(report) == 25
    sink.write_report(report, root)
    for name, table in expected.items():
        ours = spark.read.parquet(f"{root}/{name}")
        assert ours.columns == table.columns, name
        assert values(ours) == values(table), name


def test_report_reads_the_raw_input_twice(spark, monkeypatch):
    folder = new_folder(spark, "archive")
    archive(spark, 300).write.parquet(folder)
    def reads_raw(df):
        return any(folder in file for file in df.inputFiles())

    scans, stored = [], sink.stored
    monkeypatch.setattr(sink, "stored", lambda df, label: scans.append(reads_raw(df)) or stored(df, label))
    tables = jobs.detection_report(spark.read.parquet(folder))
    assert sum(scans) == 2 and not [name for name, table in tables.items() if reads_raw(table)]
