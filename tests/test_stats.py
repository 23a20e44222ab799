"""Distribution operators against brute force, including skewed and clustered inputs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from hazardlake.operators import stats

PROBS = {"q01": 0.01, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99}


def check_quantiles(spark, values, partitions=8):
    frame = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(partitions)
    row = stats.quantiles(frame, "v", PROBS).collect()[0]
    wanted = np.quantile(np.asarray(values), list(PROBS.values()))
    assert np.allclose([row[n] for n in PROBS], wanted, rtol=1e-12, atol=1e-12)


def distributions():
    random = np.random.default_rng(7)
    return {
        "uniform": random.random(60_000),
        "heavy tail": random.pareto(0.7, 60_000),
        "one value holds a third": np.where(random.random(60_000) < 0.34, 5.0, random.normal(5, 1, 60_000)),
        "two far clusters": np.concatenate([random.random(15_050), 1e9 + random.random(44_950)]),
        "tiny steps beside an outlier": np.concatenate([1 + random.random(59_999) * 1e-9, [1e300]]),
        "constant": np.full(5_000, 3.25),
        "single": np.array([4.0]),
        "two": np.array([1.0, 2.0]),
    }


@pytest.mark.parametrize("name", list(distributions()))
def test_quantiles_match_brute_force(spark, name):
    check_quantiles(spark, distributions()[name])


def test_quantiles_of_sorted_uneven_partitions(spark):
    ordered = spark.range(200_000).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    frame = ordered.repartitionByRange(37, "v").unionAll(ordered.limit(50_000).coalesce(1))
    values = np.concatenate([np.arange(200_000.0) ** 2, np.arange(50_000.0) ** 2])
    row = stats.quantiles(frame, "v", PROBS).collect()[0]
    assert np.allclose([row[n] for n in PROBS], np.quantile(values, list(PROBS.values())))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_quantiles_of_small_lists(spark, values):
    check_quantiles(spark, values, partitions=3)


def test_grouped_quantiles_skip_missing_values(spark):
    frame = spark.createDataFrame(
        [("a", 1.0), ("a", 3.0), ("a", None), ("a", float("nan")), ("b", 7.0), ("c", None),
         (None, 4.0), (None, 6.0)], "g string, v double")
    rows = {r.g: r.m for r in stats.quantiles(frame, "v", {"m": 0.5}, by="g").collect()}
    assert rows == {"a": 2.0, "b": 7.0, None: 5.0}


@pytest.mark.parametrize("edge, factor", [("lo", 2.0), ("hi", 0.5)])
def test_a_bracket_that_misses_raises(spark, monkeypatch, edge, factor):
    real = stats._brackets

    def shifted(values, probs):
        return real(values, probs).withColumn("targets", F.transform("targets", lambda t: t.withField(
            edge, t[edge] * factor if edge == "hi" else t["hi"] * factor - t["hi"] * 0.5)).cast(
            "array<struct<i:int,lo:double,hi:double,rank:double>>"))

    monkeypatch.setattr(stats, "_brackets", shifted)
    frame = spark.range(100_000).select(F.col("id").cast("double").alias("v"))
    with pytest.raises(Exception, match="outside its bracket"):
        stats.quantiles(frame, "v", {"a": 0.25, "b": 0.5}).collect()


def test_histogram_limits_enter_without_a_cross_join(spark):
    from hazardlake.operators.detections import frp_histogram

    frame = spark.range(1000).select(F.col("id").cast("double").alias("frp"))
    text = frp_histogram(frame)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert stats.quantiles(empty, "v", {"m": 0.5}).collect() == []
    assert stats.clip_upper(empty, "v").collect() == []


def test_box_statistics(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    frame = spark.createDataFrame([("x", v) for v in values] + [("other", 1.0)], "g string, v double")
    row = stats.box_statistics(frame, "v", "g", ["x"]).collect()
    assert len(row) == 1
    box = row[0].asDict()
    assert (box["n"], box["median"], box["outliers"]) == (6, 3.5, 1)
    assert (box["whisker_low"], box["whisker_high"]) == (1.0, 5.0)


def test_histogram_puts_the_maximum_in_the_last_bin(spark):
    frame = spark.createDataFrame([(0.0, 7.0), (5.0, 7.0), (10.0, None)], "a double, flat double")
    rows = {(r.variable, r.bin): (r.lower, r.upper, r.n) for r in stats.histogram(frame, ["a", "flat"], 5).collect()}
    assert len(rows) == 10
    assert [rows[("a", b)][2] for b in range(5)] == [1, 0, 1, 0, 1]
    assert rows[("flat", 0)][0] == 6.5 and rows[("flat", 4)][1] == 7.5
    assert sum(rows[("flat", b)][2] for b in range(5)) == 2


def test_correlations(spark):
    random = np.random.default_rng(3)
    data = pd.DataFrame({"a": random.random(500), "b": random.random(500), "flat": np.full(500, 0.1)})
    data["c"] = data.a * 2 - data.b
    data.loc[:20, "b"] = np.nan
    frame = spark.createDataFrame(data).select("a", F.nanvl("b", F.lit(None).cast("double")).alias("b"), "flat", "c")
    rows = {(r.column_a, r.column_b): r.r for r in stats.correlations(frame, ["a", "b", "flat", "c", "gone"]).collect()}
    assert len(rows) == 6
    wanted = data.corr()
    assert rows[("c", "a")] == pytest.approx(wanted.loc["c", "a"])
    assert rows[("b", "a")] == pytest.approx(wanted.loc["b", "a"])
    assert rows[("flat", "a")] is None
    assert stats.correlations(frame, ["a", "b"]).count() == 0


def test_describe(spark):
    data = pd.DataFrame({"x": [1.0, 2.0, 4.0, 9.0], "y": [5.0, 5.0, 6.0, 7.0]})
    rows = {r.variable: r for r in stats.describe(spark.createDataFrame(data), ["x", "y", "z"]).collect()}
    wanted = data.describe().round(2)
    for c in ("x", "y"):
        got = [rows[c][n] for n in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert got == pytest.approx(list(wanted[c]))


def test_duplicates_count_nulls_as_equal(spark):
    rows = [(1, None), (1, None), (1, None), (2, "a"), (2, "b")] + [(9, "hot")] * 3_000
    frame = spark.createDataFrame(rows, "a int, b string")
    row = stats.duplicate_rows(frame).collect()[0]
    assert row.duplicates == 2 + 2_999
    assert row.duplicates_pct == round(3_001 * 100 / 3_005, 2)


def test_duplicates_of_nothing(spark):
    row = stats.duplicate_rows(spark.createDataFrame([], "a int")).collect()[0]
    assert (row.duplicates, row.duplicates_pct) == (0, 0.0)


def test_null_profile(spark):
    frame = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    rows = {r.column_name: (r.nulls, r.null_pct) for r in stats.null_profile(frame).collect()}
    assert rows == {"a": (1, 33.33), "b": (2, 66.67), "TOTAL": (3, None)}


def test_dense_months(spark):
    months = stats.dense_months(spark.createDataFrame([(2, 5)], "mes int, n bigint"), {"n": 0})
    assert [r.n for r in months.orderBy("mes").collect()] == [0, 5] + [0] * 10


def test_correlations_of_uneven_parts(spark):
    """Gaps, large means, constants and a NaN, in partitions of different sizes, some without rows."""
    rng = np.random.default_rng(6)
    a = rng.normal(size=900) + 1e9
    data = {"a": a, "b": a * 0.5 + rng.normal(size=900), "c": rng.normal(size=900), "flat": np.full(900, 0.1), "nan": rng.normal(size=900)}
    data["nan"][5] = np.nan
    gaps = {c: rng.random(900) < 0.2 for c in data}
    rows = [tuple(None if gaps[c][i] and c != "nan" else float(v[i]) for c, v in data.items()) for i in range(900)]
    frame = spark.createDataFrame(rows[:5], "a double, b double, c double, flat double, nan double").unionAll(
        spark.createDataFrame(rows[5:], "a double, b double, c double, flat double, nan double").repartition(3)).unionAll(
        spark.createDataFrame([], "a double, b double, c double, flat double, nan double"))
    found = {(r.column_a, r.column_b): r.r for r in stats.correlations(frame, list(data)).collect()}
    assert len(found) == 10
    for x, y in (("b", "a"), ("c", "a"), ("c", "b")):
        both = ~gaps[x] & ~gaps[y]
        assert abs(found[x, y] - np.corrcoef(data[x][both], data[y][both])[0, 1]) < 1e-6
    assert found["flat", "a"] is None and math.isnan(found["nan", "c"])
    nothing = stats.correlations(frame.limit(0), list(data)).collect()
    assert len(nothing) == 10 and all(r.r is None for r in nothing)


def test_unique_rows_stay_where_they_are(spark):
    """Beyond the counting of fingerprints, only rows that the bit table lets through are exchanged."""
    frame = spark.range(4_000).select((F.col("id") % 3_990).alias("a"), F.lit("x" * 50).alias("wide")).repartition(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = stats.duplicate_rows(frame)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.collect()[0].duplicates == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "_bits" in plan and "BroadcastHashJoin" in plan
    # the exchange of whole rows lies above the join with the table
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    assert any("Exchange hashpartitioning(_print" in line for line in lines[:join])
    assert not any("Exchange hashpartitioning(a#" in line for line in lines[join:])
