"""As-of join, rolling means, equal-area cells and the risk model, each against a plain version."""

from __future__ import annotations

import datetime as dt
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from hazardlake import constants as k
from hazardlake.functions.geo import cell_area, cell_centre
from hazardlake.operators import features, risk_model
from hazardlake.session import new_folder

START = dt.datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- as-of join -----------------------------------------------------------------------------

def test_the_last_instant_not_after(spark):
    rng = random.Random(4)
    right = sorted({(rng.choice("ab"), START + dt.timedelta(minutes=rng.randrange(3_000))) for _ in range(300)})
    right = [(c, t, float(i) if i % 7 else None) for i, (c, t) in enumerate(right)] + [("a", None, 1.0), (None, START, 2.0)]
    # a third of all rows in one cell and minute; exact hits, borders of the tolerance, nulls
    left = [(i, rng.choice(["a", "b", "c", None]), START + dt.timedelta(seconds=rng.randrange(-9_000, 200_000))) for i in range(600)]
    left += [(1000 + i, "a", START + dt.timedelta(minutes=777)) for i in range(300)]
    left += [(2000 + i, c, t + dt.timedelta(seconds=s)) for i, (c, t, _) in enumerate(right[:40]) for s in (0, 3600, 3601)]
    left += [(3000, "a", None)]
    a = spark.createDataFrame(left, "id long, cell string, seen timestamp")
    b = spark.createDataFrame(right, "cell string, time timestamp, temp_c double")
    found = features.asof_join(a, b, ("cell",), "seen", "time", 3600, ("temp_c",))

    def brute(cell, seen):
        fits = [(t, v) for c, t, v in right if c == cell and c is not None and seen and t
                and seen - dt.timedelta(hours=1) <= t <= seen]
        return max(fits, key=lambda f: f[0]) if fits else (None, None)

    rows = [(r.id, r.matched_time, r.temp_c) for r in found.collect()]
    assert sorted(rows, key=str) == sorted(((i, *brute(c, t)) for i, c, t in left), key=str)
    assert "CartesianProduct" not in plan_of(found) and "NestedLoop" not in plan_of(found)


def test_left_rows_move_by_key_alone(spark):
    """The hot side is not sorted by time nor gathered in a window, so a skewed join can split it."""
    left = spark.range(1000).select(F.floor(F.col("id") / 5000).alias("cell"), F.timestamp_seconds("id").alias("seen"))
    right = spark.range(10).select(F.floor(F.col("id") / 5000).alias("cell"), F.timestamp_seconds(F.col("id") * 60).alias("time"), F.lit(1.0).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(features.asof_join(left, right, ("cell",), "seen", "time", 600, ("v",)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window " not in plan
    assert re.search(r"SortMergeJoin(\(skew=\w+\))? \[cell.*LeftOuter", plan)


def test_slots_of_many_instants_are_searched_not_scanned(spark):
    """Slots of 0 to 40 rows and one of 20,000; the work of a left row must not grow with the rows of its slot."""
    hour = 3600
    times = [n * hour + (i * hour) // n for n in range(41) for i in range(n)] + sorted({50 * hour + i * 7919 % hour for i in range(3_600)})
    at = np.array(times) * 1_000_000
    at = np.sort(np.concatenate([at, 60 * hour * 1_000_000 + np.arange(20_000) * 170_001]))
    seen = np.concatenate([at[::7], at[::11] - 1, at[::13] + 1, np.arange(0, 64 * hour, 311) * 1_000_000])
    left = spark.createDataFrame([(i, 1, int(t)) for i, t in enumerate(seen)], "id long, cell int, us long") \
        .withColumn("seen", F.timestamp_micros("us"))
    right = spark.createDataFrame([(1, int(t), float(i)) for i, t in enumerate(at)], "cell int, us long, v double") \
        .select("cell", F.timestamp_micros("us").alias("time"), "v")
    found = features.asof_join(left, right, ("cell",), "seen", "time", hour, ("v",))
    place = np.searchsorted(at, seen, side="right") - 1
    expected = {i: float(n) if n >= 0 and seen[i] - at[n] <= hour * 1_000_000 else None for i, n in enumerate(place)}
    assert {r.id: r.v for r in found.collect()} == expected
    assert None in expected.values() and len(expected) == len(seen)
    assert "lambda" not in plan_of(found)


def test_empty_sides(spark):
    a = spark.createDataFrame([(1, START)], "cell int, seen timestamp")
    b = spark.createDataFrame([], "cell int, time timestamp, v double")
    assert [tuple(r) for r in features.asof_join(a, b, ("cell",), "seen", "time", 60, ("v",)).collect()] == [(1, START, None, None)]
    assert features.asof_join(a.limit(0), b, ("cell",), "seen", "time", 60, ("v",)).count() == 0


def test_locations_snap_to_the_nearest_point(spark):
    rows = spark.createDataFrame([(36.9, -9.5), (37.02, -9.38), (37.03, -9.37), (36.8, -9.7), (None, -9.0)], "latitude double, longitude double")
    assert [tuple(r)[2:] for r in features.on_grid(rows).collect()] == [(0, 0), (0, 0), (1, 1), (0, -1), (None, 2)]


# --- rolling means ----------------------------------------------------------------------------

def test_windows_of_days(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["n", "s", None]), START.date() + dt.timedelta(days=rng.randrange(200)), rng.choice([None, 1.0, 5.5, 20.0]))
            for _ in range(700)] + [("s", START.date() + dt.timedelta(days=64), 3.0)] * 400 + [("n", None, 1.0)]
    found = features.rolling_means(spark.createDataFrame(rows, "zone string, day date, frp double"), "zone", "day", "frp", (7, 30))

    def mean(zone, day, n):
        values = [v for z, d, v in rows if z == zone and d and v is not None and day - dt.timedelta(days=n) < d <= day]
        return round(sum(values) / len(values), 9) if values else None

    expected = sorted(((z, d, sum(1 for r in rows if r[:2] == (z, d)), mean(z, d, 7), mean(z, d, 30))
                       for z, d in {r[:2] for r in rows if r[1]}), key=str)
    got = [(r.zone, r.dia, r.observacoes, *[v if v is None else round(v, 9) for v in (r.media_7d, r.media_30d)]) for r in found.collect()]
    assert sorted(got, key=str) == expected


# --- cells --------------------------------------------------------------------------------------

def test_cells_have_one_area_and_their_centre(spark):
    edges = [(lat, lon) for lat in (36.9, 38.123, 42.2) for lon in (-9.5, -8.0, -6.2)]
    df = spark.createDataFrame(edges, "latitude double, longitude double")
    cell = cell_area(F.col("latitude"), F.col("longitude"))
    rows = df.select("latitude", "longitude", cell.alias("c")).select("*", *[v.alias(n) for v, n in zip(cell_centre(F.col("c")), "yx")]).collect()
    for r in rows:
        north = 6371 * math.radians(r.y - r.latitude)
        east = 6371 * math.cos(math.radians(r.latitude)) * math.radians(r.x - r.longitude)
        # half a cell at most, stretched by no more than the distance from the standard parallel asks
        assert abs(north) < 2.7 and abs(east) < 2.7
    again = spark.createDataFrame([(r.y, r.x) for r in rows], "latitude double, longitude double").select(cell.alias("c")).collect()
    assert [r.c for r in again] == [r.c for r in rows]


def test_neighbourhoods_at_the_edge(spark):
    """Cells beyond the edge have no rows; a lone cell is its own neighbourhood."""
    centre = [r for r in spark.range(1).select(*[v.alias(n) for v, n in zip(cell_centre(F.struct(
        F.lit(-170).alias("x"), F.lit(900).alias("y"))), ("lat", "lon"))]).collect()][0]
    step = spark.range(1).select(*[v.alias(n) for v, n in zip(cell_centre(F.struct(
        F.lit(-169).alias("x"), F.lit(901).alias("y"))), ("lat", "lon"))]).collect()[0]
    far = spark.range(1).select(*[v.alias(n) for v, n in zip(cell_centre(F.struct(
        F.lit(-100).alias("x"), F.lit(950).alias("y"))), ("lat", "lon"))]).collect()[0]
    rows = [(centre.lat, centre.lon, 1.0), (centre.lat, centre.lon, None), (step.lat, step.lon, 9.0), (far.lat, far.lon, None),
            (None, 1.0, 5.0)]
    found = {(r.celula_x, r.celula_y): r for r in features.per_cell(spark.createDataFrame(
        rows, "latitude double, longitude double, frp double")).collect()}
    assert set(found) == {(-170, 900), (-169, 901), (-100, 950)}
    one, lone = found[-170, 900], found[-100, 950]
    assert (one.hotspots, one.frp_medio, one.hotspots_vizinhanca, one.frp_vizinhanca, one.frp_max_vizinhanca) == (2, 1.0, 3, 5.0, 9.0)
    assert (lone.hotspots, lone.frp_medio, lone.frp_vizinhanca, lone.hotspots_vizinhanca) == (1, None, None, 1)


# --- risk model -----------------------------------------------------------------------------------

def zone_events(spark, days=40):
    """Risk follows yesterday's temperature, so a day ahead can be told and two days cannot."""
    rng = random.Random(2)
    heat = {(z, d): rng.uniform(10, 40) for z in "abc" for d in range(-1, days)}
    rows = [(z, START + dt.timedelta(days=d, hours=h), 20 + 1.5 * heat[z, d - 1] + rng.gauss(0, .5), heat[z, d], 50.0, 10.0, 1)
            for z in "abc" for d in range(days) for h in (3, 15)]
    rows += [(None, START, 1.0, 1.0, 1.0, 1.0, 1), ("a", None, 1.0, 1.0, 1.0, 1.0, 1), ("b", START, None, None, None, None, None)]
    sensors = spark.createDataFrame(rows, "grid_id string, event_time timestamp, risk_score double, temp_celsius double, "
                                          "humidity_pct double, wind_kmh double, hotspot_count int")
    fires = spark.createDataFrame([("a", START + dt.timedelta(days=3), 12.0), (None, START, 1.0)],
                                  "grid_id string, event_time timestamp, frp double")
    return sensors, fires


def test_held_out_error_like_a_plain_version(spark):
    days = risk_model.zone_days(*zone_events(spark))
    train, test = risk_model.split_by_time(days)
    model = risk_model.fit(train)
    scored = risk_model.predictions(model, test)
    errors = {r.horizon_hours: r.erro for r in risk_model.held_out_error(scored).collect()}

    names = list(risk_model.FEATURES)
    x, y = train.toPandas(), test.toPandas()
    means, spreads = x[names].mean().fillna(0), x[names].std(ddof=0).fillna(1).replace(0, 1)
    for hours, error in errors.items():
        def design(frame):
            return np.column_stack([np.ones(len(frame)), ((frame[names] - means) / spreads).fillna(0).to_numpy(float)])

        target = f"alvo_{hours}"
        known = x[x[target].notna()]
        a = design(known)
        penalty = risk_model.RIDGE * len(known) * np.diag([0] + [1] * len(names))
        weights = np.linalg.solve(a.T @ a + penalty, a.T @ known[target].to_numpy(float))
        told = y[y[target].notna()]
        plain = np.sqrt(np.mean((np.clip(design(told) @ weights, 0, 100) - told[target].to_numpy(float)) ** 2))
        assert abs(plain - error) < 1e-6
    persistence = np.sqrt(np.mean((y.alvo_24 - y.risk_score) ** 2))
    assert errors[24] < 1.5 < persistence / 3 and errors[48] > 5
    confidence = {r.horizon_hours: r.confidence for r in scored.collect()}
    assert confidence[24] > confidence[48]


def test_reruns_and_storage_agree(spark):
    days = risk_model.zone_days(*zone_events(spark, 20))
    train, test = risk_model.split_by_time(days)
    model = risk_model.fit(train)
    assert risk_model.fit(train.repartition(7)).version == model.version
    path = new_folder(spark, "model")
    model.save(path)
    assert risk_model.load(spark, path) == model
    scored = risk_model.predictions(model, test, F.lit(START))
    assert scored.groupBy("grid_id", "prediction_date", "horizon_hours").count().filter("count > 1").count() == 0
    assert {r.horizon_hours for r in scored.collect()} == set(k.HORIZON_HOURS)
    # the last days have no observed score yet, but a prediction
    last = scored.filter(F.col("prediction_date") == F.lit(START + dt.timedelta(days=19)).cast("date")).collect()
    assert last and all(r.observed is None and 0 <= r.predicted_risk <= 100 for r in last)


def test_model_of_nothing(spark):
    sensors, fires = zone_events(spark, 3)
    none = risk_model.zone_days(sensors.limit(0), fires.limit(0))
    train, test = risk_model.split_by_time(none)
    assert risk_model.predictions(risk_model.fit(train), test).count() == 0
