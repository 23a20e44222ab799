"""Worked examples and edge cases of the scalar functions."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from hazardlake.functions import calendar, climate, geo, hazard, values


def lit(value):
    return F.lit(value) if value is not None else F.lit(None).cast("double")


@pytest.mark.parametrize("inputs, score", [
    ((40.0, 10.0, 40.0, 3), 96.5),
    ((60.0, 0.0, 150.0, 9), 100.0),
    ((-5.0, 100.0, 0.0, 0), 0.0),
    ((15.0, 25.0, 40.0, 0), 50.0),
    ((None, 10.0, 40.0, 3), None),
    ((40.0, None, 40.0, 3), None),
])
def test_risk_score(one, inputs, score):
    assert one(hazard.risk_score(*map(lit, inputs))) == score


@pytest.mark.parametrize("score, level", [
    (29.9, "LOW"), (30.0, "MEDIUM"), (59.9, "MEDIUM"), (60.0, "HIGH"), (79.9, "HIGH"), (80.0, "CRITICAL")])
def test_risk_level_edges(one, score, level):
    assert one(hazard.risk_level(F.lit(score))) == level


@pytest.mark.parametrize("inputs, expected", [
    ((35.0, 20.0, 30.0), False), ((35.1, 19.9, 30.1), True), ((35.1, 20.0, 30.1), False)])
def test_critical_weather_is_strict(one, inputs, expected):
    assert one(hazard.critical_weather(*map(F.lit, inputs))) is expected


def test_critical_weather_leaves_absent_columns_out(one):
    assert one(hazard.critical_weather(temperature=F.lit(36.0))) is True


def test_composite_hazard(one):
    assert one(hazard.composite_hazard(F.lit(50.0), F.lit(100.0), F.lit(75.0))) == pytest.approx(50.0)
    assert one(hazard.composite_hazard(lit(None), lit(None), lit(None))) == 0.0
    assert one(hazard.composite_hazard(F.lit(0.0), F.lit(5000.0), F.lit(0.0))) == pytest.approx(625.0)
    assert one(hazard.composite_hazard(F.lit(0.0), F.lit(5000.0), F.lit(0.0), clamp=True)) == 100.0


def test_trigger_text(one):
    assert one(hazard.trigger_text(F.lit(40.5), F.lit(10.0), F.lit(45.0))) == "temp>40.5C hum<10.0% vento>45.0kmh"


@pytest.mark.parametrize("text, expected", [
    ("2026-06-09T19:37:00Z", dt.datetime(2026, 6, 9, 19, 37)),
    ("2026-06-09T19:37:00+01:00", dt.datetime(2026, 6, 9, 18, 37)),
    ("not a time", None)])
def test_parse_instant(one, text, expected):
    assert one(calendar.parse_instant(F.lit(text)).cast("timestamp_ntz")) == expected


def test_hour_bucket(one):
    assert one(calendar.hour_bucket(F.lit("2026-06-09 19:37:00").cast("timestamp"))) == "2026-06-09T19:00:00"


def test_latency(one):
    times = [F.lit(t).cast("timestamp") for t in ("2024-01-01 00:00:00", "2024-01-01 00:00:01.5")]
    assert one(calendar.latency_ms(*times)) == 1500.0


def test_labels(one):
    assert one(calendar.month_label(F.lit(12))) == "Dez"
    assert one(calendar.season(F.lit(9))) == "Verão (Jun–Set)"
    assert one(calendar.season(F.lit(10))) == "Resto do ano"
    assert one(calendar.day_period(F.lit("N"))) == "Noturno"
    assert one(calendar.day_period(F.lit("X"))) is None


def test_nearest_zone(one):
    assert one(geo.nearest_zone(F.lit(38.5), F.lit(-8.0))) == "PT-ALENTEJO-01"
    assert one(geo.nearest_zone(lit(None), F.lit(-8.0))) is None


def test_nearest_zone_tie_takes_the_first_listed(one):
    from hazardlake.constants import Zone
    zones = (Zone("b", 1.0, 0.0, "", 0), Zone("a", -1.0, 0.0, "", 0))
    assert one(geo.nearest_zone(F.lit(0.0), F.lit(0.0), zones)) == "b"


@pytest.mark.parametrize("latitude, region", [
    (41.0, "Norte"), (39.5, "Centro"), (38.5, "Lisboa e VT"), (37.5, "Alentejo"), (37.4, "Algarve"), (None, "Algarve")])
def test_region(one, latitude, region):
    assert one(geo.region(lit(latitude))) == region


def test_box_and_complement_leave_null_out(spark):
    rows = spark.createDataFrame([(36.9, -9.5), (42.2, -6.2), (36.8, -8.0), (None, -8.0)], "a double, o double")
    assert rows.filter(geo.inside_box(F.col("a"), F.col("o"))).count() == 2
    assert rows.filter(geo.outside_box(F.col("a"), F.col("o"))).count() == 1


def test_longitude_wrap(one):
    assert one(geo.wrap_longitude(F.lit(351.0))) == -9.0
    assert one(geo.wrap_longitude(F.lit(-9.0))) == -9.0


def test_climate(one):
    assert one(climate.wind_speed_kmh(F.lit(3.0), F.lit(4.0))) == pytest.approx(18.0)
    assert one(climate.relative_humidity(F.lit(20.0), F.lit(20.0))) == pytest.approx(100.0)
    assert one(climate.relative_humidity(F.lit(20.0), F.lit(25.0))) == 100.0
    assert one(climate.relative_humidity(lit(None), F.lit(25.0))) is None
    assert one(climate.daily_precipitation(F.lit(-1.0))) == 0.0
    assert one(climate.daily_precipitation(lit(None))) is None
    assert one(climate.daily_evaporation(F.lit(-1.0))) == 86400.0


@pytest.mark.parametrize("text, level", [
    ("Mato com agua", "HIGH"), ("Floresta URBANA", "MEDIUM"), ("Tecido urbano", "LOW"), ("Eucaliptal", "MEDIUM")])
def test_vegetation(one, text, level):
    assert one(values.vegetation_risk(F.lit(text))) == level


@pytest.mark.parametrize("name, satellite", [
    ("fire_SNPP_1.csv", "VIIRS S-NPP"), ("x_s-npp.csv", "VIIRS S-NPP"), ("fire_NOAA20.csv", "VIIRS NOAA-20"),
    ("jpss2.csv", "VIIRS NOAA-20"), ("modis.csv", "VIIRS")])
def test_satellite_of_file(one, name, satellite):
    assert one(values.satellite_of_file(F.lit(name))) == satellite


@pytest.mark.parametrize("mark, kept", [("low", False), ("L", False), ("n", True), ("40", True), (None, True)])
def test_confidence(one, mark, kept):
    assert one(values.known_confidence(F.lit(mark).cast("string"))) is kept


@pytest.mark.parametrize("metric, value, colour", [
    ("success_percent", 79.9, "red"), ("success_percent", 80.0, "orange"), ("success_percent", 95.0, "green"),
    ("latency_ms", 2000.0, "red"), ("failed_expectations", 0.0, "green"), ("failed_expectations", 5.0, "red")])
def test_metric_band(one, metric, value, colour):
    assert one(values.metric_band(metric, F.lit(value))) == colour


def test_json_keeps_null_fields(one):
    text = one(values.as_json(F.lit(None).cast("int").alias("a"), F.lit("x").alias("b")))
    assert json.loads(text) == {"a": None, "b": "x"}


def test_safe_double(one):
    assert one(values.safe_double(F.lit("x1"))) is None
    assert one(values.safe_double(F.lit("1.5"))) == 1.5
