"""CSV and Parquet sources, publishing, and lake checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.operators import climate_grid as grid_ops, lake_checks as checks
from hazardlake.plans import jobs
from hazardlake.session import new_folder, path_exists
from hazardlake.sinks import lake as sink
from hazardlake.sources import climate_grid as grid_src, detections as det, lake as src, payloads


def detections(spark, days):
    rows = [(40.0 + i % 3 * 0.1, -8.0, float(i), d) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "latitude double, longitude double, frp double, acq_date string").withColumn(
        "acq_date", F.to_date("acq_date"))


def test_csv_columns_are_matched_by_name(spark):
    a, b = new_folder(spark, "snpp"), new_folder(spark, "other")
    frame = detections(spark, ["2020-01-01", "2020-07-02"])
    frame.write.option("header", "true").csv(a)
    frame.select("acq_date", "frp", "longitude", "latitude", F.lit("x").alias("notes")).write.option("header", "true").csv(b)
    rows = det.read_csv(spark, [a, b])
    assert rows.filter("latitude BETWEEN 40 AND 41 AND longitude = -8.0").count() == 4
    assert {(r.ano, r.mes, r.dia) for r in rows.collect()} == {(2020, 1, 1), (2020, 7, 2)}
    assert det.keep_columns(rows).columns == ["latitude", "longitude", "frp", "acq_date", "satelite", "ano", "mes", "dia"]


def test_refine_publish_and_checks(spark):
    raw, csv, parquet, lake = (new_folder(spark, n) for n in ("raw", "csv", "parquet", "lake"))
    frame = detections(spark, ["2020-01-01", "2021-02-01", "2022-03-01", "2022-03-02"])
    outside = frame.limit(1).withColumn("latitude", F.lit(50.0))
    frame.unionAll(outside).write.option("header", "true").csv(raw)
    cleaned = jobs.refine_detections(spark, raw, csv, parquet)
    assert cleaned.count() == 4
    stored = det.read_clean_or_raw(spark, parquet, raw)
    assert stored.count() == 4 and spark.read.option("header", "true").csv(csv).count() == 4
    assert det.read_clean_or_raw(spark, lake + "-none", lake + "-none") is None

    grid = spark.createDataFrame([("2020-01-01 05:00:00", 40.0, 352.0, 300.0), ("2020-01-01 05:00:00", 50.0, 352.0, 300.0)],
                                 "valid_time string, latitude double, longitude double, t2m double")
    points = grid_src.refine(grid.withColumn("valid_time", F.to_timestamp("valid_time")))
    assert points.select("longitude", "hora").collect()[0] == (-8.0, 5) and points.count() == 1

    for _ in range(2):
        assert jobs.publish(stored, points, lake) == {"hotspots": True, "meteorologia": True}
    hot = src.read_lake(spark, f"{lake}/hotspots")
    assert hot.count() == 4 and dict(hot.dtypes)["ano"] == "int"
    plan = hot.filter("ano = 2022 AND mes = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan

    facts = {r.dataset: r for r in checks.inventory(jobs.lake_listing(spark, lake)).collect()}
    assert (facts["hotspots"].years, facts["hotspots"].zones) == (3, 1)
    ready = {r.dataset: (r.ready, r.verdict) for r in checks.readiness(
        checks.inventory(jobs.lake_listing(spark, lake))).collect()}
    assert ready == {"hotspots": (True, "partial"), "meteorologia": (True, "partial"), "agregados_streaming": (False, "partial")}
    assert checks.files(spark, lake + "-none", "x").count() == 0


def test_yearly_files_are_found_when_there_is_no_combined_one(spark):
    folder = new_folder(spark, "clean")
    assert src.read_combined_or_yearly(spark, folder, "c") is None
    spark.range(2).write.parquet(f"{folder}/c_2020.parquet")
    spark.range(3).write.parquet(f"{folder}/c_2021.parquet")
    assert src.read_combined_or_yearly(spark, folder, "c").count() == 5
    spark.range(9).write.parquet(f"{folder}/c_todos.parquet")
    assert src.read_combined_or_yearly(spark, folder, "c").count() == 9
    assert src.read_combined_or_yearly(spark, folder, "d") is None
    assert path_exists(spark, folder)


def test_a_hot_partition_is_written_by_several_tasks(spark):
    path = new_folder(spark, "hot")
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(0).cast("int").alias("ano"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        sink.write_partitioned(rows, path, ("ano",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = checks.files(spark, path, "hot").groupBy(checks.partition_value("ano").alias("ano")).count()
    counts = {r.ano: r["count"] for r in files.collect()}
    assert counts["0"] > 1 and len(counts) == 50
    assert spark.read.parquet(path).count() == 400_000


def test_station_payload(spark):
    document = """{"features":[
      {"geometry":{"coordinates":[-8.4,41.5]},"properties":{"idEstacao":1200535,"temperatura":30.0,"humidade":20.0}},
      {"geometry":{"coordinates":[-8.4,41.5]},"properties":{"idEstacao":1200562,"temperatura":null,"humidade":20.0}},
      {"geometry":{"coordinates":[-8.4,41.5]},"properties":{"idEstacao":7,"temperatura":30.0,"humidade":20.0}}]}"""
    rows = payloads.station_observations(spark.createDataFrame([(document,)], "value string"))
    row = rows.collect()
    assert len(row) == 1
    assert (row[0].grid_id, row[0].latitude, row[0].longitude, row[0].wind_kmh) == ("PT-NORTE-01", 41.5, -8.4, 0.0)
    scored = payloads.as_sensor_events(rows, scored=True).collect()[0]
    assert scored.risk_score == 52.5
    assert payloads.as_sensor_events(rows).collect()[0].risk_score is None
    assert payloads.as_weather_events(rows).collect()[0].humidity_avg == 20.0


def test_merge_by_coordinates(spark):
    a = spark.createDataFrame([(1, 1.0, 2.0, 5.0)], "time int, latitude double, longitude double, t2m double")
    b = spark.createDataFrame([(1, 1.0, 2.0, 7.0), (2, 1.0, 2.0, 8.0)], "valid_time int, latitude double, longitude double, d2m double")
    rows = sorted(grid_src.merge_by_coordinates([a, b]).select("time", "t2m", "d2m").collect())
    assert [tuple(r) for r in rows] == [(1, 5.0, 7.0), (2, None, 8.0)]


def test_grid_report(spark):
    hours = spark.range(48).select(
        F.timestamp_seconds(F.col("id") * 3600).alias("time"), F.lit(40.0).alias("latitude"), F.lit(-8.0).alias("longitude"),
        (F.lit(300.0) + F.col("id")).alias("t2m"), (F.lit(280.0) - F.col("id")).alias("d2m"), F.lit(3.0).alias("u10"),
        F.lit(4.0).alias("v10"), F.lit(1e-5).alias("mtpr"), F.lit(-1e-6).alias("mer"))
    tables = jobs.grid_report(grid_src.refine(hours))
    profile = tables["profile"].collect()[0]
    assert (profile.n_registos, profile.n_pts_grid, profile.anos, profile.vento_max) == (48, 1, "1970", 18.0)
    assert len(tables["monthly_precipitation"].collect()) == 12
    assert tables["temperature_by_hour"].collect()[0].h00 is not None
    assert grid_ops.temperature_map_matrix(grid_src.refine(hours), [-8.0]).columns == ["latitude", "-8.0"]


def test_required_columns_of_stored_datasets(spark):
    hot = spark.createDataFrame([(40.0, None), (41.0, "n")], "latitude double, confidence string")
    found = checks.required_columns(
        {"hotspots": hot, "agregados_streaming": None},
        {"hotspots": ("latitude", "confidence", "frp"), "agregados_streaming": ("risco_composto",)})
    assert sorted(tuple(r) for r in found.select("dataset", "column_name", "present", "filled", "rows").collect()) == [
        ("agregados_streaming", "risco_composto", False, 0, 0),
        ("hotspots", "confidence", True, 1, 2), ("hotspots", "frp", False, 0, 2), ("hotspots", "latitude", True, 2, 2)]
    empty = checks.filled_columns(hot.limit(0), ("latitude",), "hotspots").collect()
    assert [(r.present, r.filled, r.rows) for r in empty] == [(True, 0, 0)]


def test_a_column_without_a_file_is_no_part_of_an_old_output(spark):
    path = new_folder(spark, "versions")
    old = spark.createDataFrame([("Z1", 1), ("Z2", 5)], "grid_id string, janela_inicio int")
    new = old.selectExpr("grid_id", "janela_inicio + 10 AS janela_inicio", "0L AS n_hotspots", "0D AS frp_medio", "1D AS risco_composto")
    old.coalesce(1).write.parquet(path)
    only_old = checks.output_versions(spark.read.parquet(path)).collect()
    assert [(r.version, r.files, r.rows, r.zones) for r in only_old] == [("v1", 1, 2, 2)]
    new.coalesce(1).write.mode("append").parquet(path)
    both = checks.output_versions(spark.read.option("mergeSchema", "true").parquet(path)).orderBy("version").collect()
    assert [(r.version, r.files, r.rows, r.first_window, r.last_window) for r in both] == [("v1", 1, 2, 1, 5), ("v2", 1, 2, 11, 15)]


def test_a_file_is_old_when_one_of_its_zones_lacks_the_join(spark):
    path = new_folder(spark, "versions")
    rows = spark.createDataFrame([("Z1", 1, 0, 0.0, 1.0), ("Z2", 2, None, 0.0, 1.0)],
                                 "grid_id string, janela_inicio int, n_hotspots int, frp_medio double, risco_composto double")
    rows.coalesce(1).write.parquet(path)
    assert [r.version for r in checks.output_versions(spark.read.parquet(path)).collect()] == ["v1"]


def test_column_catalogue_names_origin_and_what_is_beyond_it(spark):
    frame = spark.createDataFrame([(1.0, 2, None)], "frp double, extra int, `odd.name` string")
    rows = {r.column_name: r for r in checks.column_catalogue(frame, "hotspots").collect()}
    assert (rows["frp"].origin, rows["frp"].present, rows["frp"].filled) == ("satellite file", True, 1)
    assert (rows["grid_id"].origin, rows["grid_id"].present, rows["grid_id"].filled) == ("load", False, 0)
    assert (rows["extra"].origin, rows["extra"].description, rows["extra"].filled) == ("uncatalogued", "", 1)
    assert (rows["odd.name"].origin, rows["odd.name"].filled) == ("uncatalogued", 0)


def test_loaded_partitions_come_from_paths(spark):
    path = new_folder(spark, "parts")
    spark.range(6).selectExpr("id", "CAST(id % 2 AS int) AS ano", "'Z' AS grid_id").write.partitionBy("ano", "grid_id").parquet(path)
    loaded = checks.loaded_partitions(checks.files(spark, path, "parts"), ("ano", "mes", "grid_id"))
    assert sorted(tuple(r) for r in loaded.select("ano", "mes", "grid_id").collect()) == [("0", None, "Z"), ("1", None, "Z")]
    assert {r.folders for r in checks.inventory(checks.files(spark, path, "parts")).collect()} == {2}
