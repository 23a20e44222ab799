"""Committed tables: batches of several tables, replays, compaction, expiry, conflicts."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from hazardlake.operators import timeseries as ts
from hazardlake.session import new_folder
from hazardlake.sinks import keyed, tables
from hazardlake.streaming import queries as sq

START = dt.datetime(2024, 1, 1)


def rows_of(spark, *rows):
    return spark.createDataFrame([(z, "b", START + dt.timedelta(hours=h), s) for z, h, s in rows],
                                 "grid_id string, hour_bucket string, event_time timestamp, risk_score double")


def put(spark, root, batch_id, *rows, written=START, also=()):
    out = tables.Batch(spark, root, batch_id, written)
    out.add("readings", rows_of(spark, *rows), F.to_date("event_time"), ("grid_id",), "dia_evento")
    for name in also:
        out.add(name, rows_of(spark, *rows), F.to_date("event_time"))
    out.commit()


def scores(spark, root):
    return sorted((r.grid_id, r.event_time.hour + 24 * (r.event_time.day - 1), r.risk_score)
                  for r in keyed.read_latest(spark, f"{root}/readings").collect())


def folders(spark, root, table="readings"):
    found = {}
    for f in tables.manifest(spark, root).live:
        if f.table == table:
            found.setdefault(f.dia.day, []).append(f.folder)
    return found


def on_disk(root, table="readings"):
    top = f"{root.removeprefix('file:')}/{table}"
    return sorted(os.path.relpath(os.path.join(d, x), top) for d, _, names in os.walk(top) for x in names if x.endswith(".parquet"))


def test_a_replay_replaces_only_itself(spark):
    root = new_folder(spark, "tables")
    put(spark, root, 0, ("a", 1, 1.0), ("b", 30, 2.0), also=("other",))
    put(spark, root, 1, ("a", 1, 5.0), also=("other",))
    before = scores(spark, root)
    assert before == [("a", 1, 5.0), ("b", 30, 2.0)]
    put(spark, root, 0, ("a", 1, 1.0), ("b", 30, 2.0), also=("other",))
    put(spark, root, 1, ("a", 1, 5.0), also=("other",))
    assert scores(spark, root) == before
    assert tables.scan(spark, f"{root}/readings").count() == 3 == tables.scan(spark, f"{root}/other").count()
    assert tables.scan(spark, f"{root}/other").columns[-2:] == ["batch_id", "dia"]


def test_a_batch_that_fails_between_tables_shows_nowhere(spark, monkeypatch):
    root = new_folder(spark, "tables")
    put(spark, root, 0, ("a", 1, 1.0), also=("second",))
    out = tables.Batch(spark, root, 1, START)
    out.add("readings", rows_of(spark, ("a", 1, 7.0)), F.to_date("event_time"), (), "dia_evento")
    broken = rows_of(spark, ("a", 1, 7.0)).withColumn("risk_score", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        out.add("second", broken, F.to_date("event_time"))
    assert scores(spark, root) == [("a", 1, 1.0)]
    assert tables.scan(spark, f"{root}/second").count() == 1
    # the next attempt of the batch brings both
    put(spark, root, 1, ("a", 1, 7.0), also=("second",))
    assert scores(spark, root) == [("a", 1, 7.0)] and tables.scan(spark, f"{root}/second").count() == 2


def test_the_sensor_sink_commits_once(spark, monkeypatch):
    """A micro-batch that fails at its last table leaves all eight as they were; its retry fills all."""
    root = new_folder(spark, "ingest")
    texts = ("grid_id", "timestamp", "temp_celsius", "humidity_pct", "wind_kmh", "hotspot_count", "risk_score", "source",
             "latitude", "longitude")
    rows = [("Z1", "2024-01-01T00:01:00Z", t, "10.0", "45.0", "1", "90.0", "s", None, None) for t in ("40.0", "999.0")]
    batch = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in texts)).withColumn("event_time", F.to_timestamp("timestamp"))
    sink = sq.sensor_sink(root, F.lit("2024-01-01 01:00:00").cast("timestamp"))
    sink(batch, 0)
    names = ("sensor_readings", "fire_alerts", "alert_messages", "quarantine", "data_quality", "rejected_events",
             "rejected_event_detail", "pipeline_latency")
    assert [tables.scan(spark, f"{root}/{n}").count() for n in names] == [1] * 8

    add, calls = tables.Batch.add, []

    def failing(self, table, *args, **options):
        calls.append(table)
        if table == "pipeline_latency":
            raise OSError("disk full")
        add(self, table, *args, **options)

    monkeypatch.setattr(tables.Batch, "add", failing)
    with pytest.raises(OSError):
        sink(batch, 1)
    assert len(calls) == 8
    assert [tables.scan(spark, f"{root}/{n}").count() for n in names] == [1] * 8
    monkeypatch.undo()
    sink(batch, 1)
    sink(batch, 1)
    assert [tables.scan(spark, f"{root}/{n}").count() for n in names] == [2] * 8
    assert keyed.read_latest(spark, f"{root}/sensor_readings").count() == 1


def test_closed_days_become_one_version(spark):
    root = new_folder(spark, "tables")
    for b in range(4):
        put(spark, root, b, ("a", 1, float(b)), (f"z{b}", 2, 1.0), ("a", 30, float(b)), ("a", 50, float(b)))
    before = scores(spark, root)
    assert {d: len(f) for d, f in folders(spark, root).items()} == {1: 4, 2: 4, 3: 4}
    assert keyed.compact_days(spark, f"{root}/readings", dt.date(2024, 1, 3)) == 2
    assert {d: len(f) for d, f in folders(spark, root).items()} == {1: 1, 2: 1, 3: 4}
    assert scores(spark, root) == before
    # one day's read touches one version, and outdated rows are gone from it
    day = tables.scan(spark, f"{root}/readings", dt.date(2024, 1, 1), dt.date(2024, 1, 1))
    assert day.count() == 5 and len({f.rsplit("/", 1)[0] for f in day.inputFiles()}) == 1
    assert keyed.compact_days(spark, f"{root}/readings", dt.date(2024, 1, 3)) == 0
    # a late row and a replay after the merge
    put(spark, root, 4, ("a", 1, 9.0))
    put(spark, root, 3, ("a", 1, 3.0), ("z3", 2, 1.0), ("a", 30, 3.0), ("a", 50, 3.0))
    assert scores(spark, root) == sorted({k[:2]: k for k in [*before, ("a", 1, 9.0)]}.values())
    assert keyed.compact_days(spark, f"{root}/readings", dt.date(2024, 1, 3)) == 1


def test_a_killed_compaction_changes_nothing(spark, monkeypatch):
    root = new_folder(spark, "tables")
    for b in range(3):
        put(spark, root, b, ("a", 1, float(b)))
    before, stored = tables.manifest(spark, root), on_disk(root)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        keyed.compact_days(spark, f"{root}/readings", dt.date(2024, 2, 1))
    monkeypatch.undo()
    assert tables.manifest(spark, root) == before and scores(spark, root) == [("a", 1, 2.0)]
    assert set(stored) < set(on_disk(root))
    assert tables.vacuum(spark, root, dt.timedelta(0)) == 1 and on_disk(root) == stored


def test_a_compaction_overtaken_by_another_change_gives_up(spark, monkeypatch):
    root = new_folder(spark, "tables")
    for b in range(2):
        put(spark, root, b, ("a", 1, float(b)))
    publish, once = tables._publish, []

    def overtaken(*args):
        if not once:
            once.append(True)
            tables.expire(spark, root, START + dt.timedelta(1))
        publish(*args)

    monkeypatch.setattr(tables, "_publish", overtaken)
    assert keyed.compact_days(spark, f"{root}/readings", dt.date(2024, 2, 1)) == 0
    assert tables.scan(spark, f"{root}/readings").count() == 0


def test_two_writers_take_turns(spark, monkeypatch):
    root = new_folder(spark, "tables")
    put(spark, root, 0, ("a", 1, 0.0))
    publish, once = tables._publish, []

    def overtaken(*args):
        if not once:
            once.append(True)
            put(spark, root, 2, ("c", 1, 2.0))
        publish(*args)

    monkeypatch.setattr(tables, "_publish", overtaken)
    put(spark, root, 1, ("b", 1, 1.0))
    assert scores(spark, root) == [("a", 1, 0.0), ("b", 1, 1.0), ("c", 1, 2.0)]
    assert tables.manifest(spark, root).number == 3


def test_expired_rows_leave_the_storage(spark):
    root = new_folder(spark, "tables")
    put(spark, root, 0, ("a", 1, 1.0), written=START)
    put(spark, root, 1, ("b", 1, 2.0), written=START + dt.timedelta(hours=60))
    reader = tables.scan(spark, f"{root}/readings")
    assert tables.expire(spark, root, START + dt.timedelta(hours=1)) == 1
    assert scores(spark, root) == [("b", 1, 2.0)] and len(on_disk(root)) == 2
    # removed just now: a reader that started before still finishes
    assert tables.vacuum(spark, root, dt.timedelta(hours=1)) == 0
    assert reader.count() == 2
    assert tables.vacuum(spark, root, dt.timedelta(0)) == 1
    assert len(on_disk(root)) == 1 and scores(spark, root) == [("b", 1, 2.0)]


def test_manifests_are_merged(spark, monkeypatch):
    monkeypatch.setattr(tables, "MERGED", 3)
    root = new_folder(spark, "tables")
    for b in range(7):
        put(spark, root, b, ("a", 1, float(b)))
    assert tables.expire(spark, root, START) == 0
    names = tables._children(spark, f"{root}/{tables.COMMITS}")
    assert [n for n in names if "all" in n] == ["000000000003.all.json", "000000000006.all.json"]
    assert scores(spark, root) == [("a", 1, 6.0)] and len(folders(spark, root)[1]) == 7
    # older files are not needed any more
    for n in names[:5]:
        os.remove(f"{root.removeprefix('file:')}/{tables.COMMITS}/{n}")
    assert scores(spark, root) == [("a", 1, 6.0)]


def test_a_range_of_points_reads_its_days(spark):
    root = new_folder(spark, "tables")
    points = spark.range(24 * 30).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("_time"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("topic"), F.col("id").cast("double").alias("latency_ms"))
    out = tables.Batch(spark, root, 0, START)
    out.add("latency", points, F.to_date("_time"), ("topic", "_time"))
    out.commit()
    found = ts.read_stored(spark, f"{root}/latency", START + dt.timedelta(days=4, hours=6), START + dt.timedelta(days=6), {"topic": "x"})
    assert sorted(r.latency_ms for r in found.collect()) == [float(i) for i in range(4 * 24 + 6, 6 * 24, 2)]
    assert len(found.inputFiles()) == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dia" in plan and "PushedFilters: [IsNotNull(_time), IsNotNull(topic)" in plan
    assert ts.read_stored(spark, f"{root}/latency", START - dt.timedelta(days=9), START).count() == 0
