"""Sources, sinks and checks of the lake: written below the shared folder, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake import constants as k
from hazardlake.catalog.fixtures import REGION
from hazardlake.catalog.registry import query
from hazardlake.catalog.scalars import VEGETATION_RISK, VEGETATION_TEXT
from hazardlake.catalog.windows import COMPOSITE, NEAREST, SLIDE, WINDOW, ZONE_ROWS, composite, edges, windowed
from hazardlake.operators import access, lake_checks as checks, windows as w
from hazardlake.plans import jobs
from hazardlake.session import new_folder
from hazardlake.sinks import lake as sink
from hazardlake.sources import detections as det, lake as src, payloads

RECEIVED = "2024-02-01 00:00:00"
PLACED = NEAREST + """, lake AS (SELECT k.* EXCLUDE (grid_id), n.zone AS grid_id FROM fx_kept k JOIN near n
 ON k.event_id = n.event_id AND n.rn = 1) """


def received():
    return F.lit(RECEIVED).cast("timestamp")


def zoned(t):
    return det.with_zone(t.kept.drop("grid_id"))


def published(t) -> str:
    """A lake with detections and a climate grid."""
    root = new_folder(t.spark, "lake")
    jobs.publish(t.kept.drop("grid_id"), t.points, root)
    return root


def name_parts(t, folder: str, mark: str) -> None:
    """Give the files of a folder a name that carries the satellite mark."""
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(t.spark._jsc.hadoopConfiguration())
    for i, status in enumerate(files.globStatus(path(f"{folder}/part-*"))):
        files.rename(status.getPath(), path(f"{folder}/fire_{mark}_{i}.csv"))


def raw_csv(t) -> list[str]:
    """Detections as one CSV folder per satellite, with differing column orders."""
    columns = ["latitude", "longitude", "bright_ti4", "acq_date", "confidence", "bright_ti5", "frp", "daynight"]
    folders = []
    for satellite, mark in (("VIIRS S-NPP", "SNPP"), ("VIIRS NOAA-20", "jpss1")):
        folder = new_folder(t.spark, f"csv-{mark}")
        rows = t.detections.filter(F.col("satelite") == satellite).select(*columns)
        rows.write.option("header", "true").csv(folder)
        name_parts(t, folder, mark)
        folders.append(folder)
        columns = columns[::-1]
    return folders


# --- sources ---------------------------------------------------------------------------------

CSV_ROW = """round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, bright_ti4, bright_ti5, round(frp, 6) AS frp,
 acq_date, confidence, daynight, satelite, ano, mes, dia"""


@query("src_05", f"SELECT {CSV_ROW} FROM fx_det")
def csv_scan(t):
    return det.keep_columns(det.read_csv(t.spark, raw_csv(t)))


@query("src_06", "SELECT satelite, count(*) AS hotspots FROM fx_det GROUP BY satelite")
def satellite_from_name(t):
    return det.read_csv(t.spark, raw_csv(t)).groupBy("satelite").agg(F.count("*").alias("hotspots"))


@query("src_08", """SELECT 'yearly' AS found, count(*) AS linhas FROM fx_arch_kept
UNION ALL SELECT 'combined', count(*) FROM fx_arch_kept WHERE ano < 1996""")
def preferred_parquet(t):
    folder, rows = new_folder(t.spark, "clean"), det.in_country(t.archive)
    early, late = rows.filter("ano < 1996"), rows.filter("ano >= 1996")
    early.write.parquet(f"{folder}/clean_1995.parquet")
    late.write.parquet(f"{folder}/clean_1996.parquet")
    yearly = src.read_combined_or_yearly(t.spark, folder, "clean").agg(F.count("*").alias("linhas"))
    counted = new_folder(t.spark, "counted")
    yearly.withColumn("found", F.lit("yearly")).write.parquet(counted)
    early.write.parquet(f"{folder}/clean_todos.parquet")
    combined = src.read_combined_or_yearly(t.spark, folder, "clean").agg(F.count("*").alias("linhas"))
    return t.spark.read.parquet(counted).unionByName(combined.withColumn("found", F.lit("combined"))).select("found", "linhas")


@query("src_09", PLACED + "SELECT ano, mes, grid_id, count(*) AS hotspots FROM lake GROUP BY 1, 2, 3")
def partitioned_scan(t):
    lake = src.read_lake(t.spark, published(t) + "/hotspots")
    return lake.groupBy("ano", "mes", "grid_id").agg(F.count("*").alias("hotspots"))


@query("src_10", """SELECT 'raw' AS origin, count(*) AS hotspots, round(max(frp), 6) AS frp_max FROM fx_kept
UNION ALL SELECT 'clean', count(*), round(max(frp), 6) FROM fx_kept""")
def clean_or_raw(t):
    raw, missing, clean = raw_csv(t), new_folder(t.spark, "absent"), new_folder(t.spark, "clean")
    det.clean(det.read_csv(t.spark, raw)).write.parquet(clean)
    stored = det.read_clean_or_raw(t.spark, clean, missing)
    fallback = det.read_clean_or_raw(t.spark, missing, [*raw, missing])

    def figures(df, origin):
        return df.agg(F.lit(origin).alias("origin"), F.count("*").alias("hotspots"), F.max("frp").alias("frp_max"))

    return figures(fallback, "raw").unionByName(figures(stored, "clean"))


STATION = "list_extract([1200535, 1200562, 1210713, 1200524, 1200514, 1200609, 1200519, 1200546, 1200502, 1200588, 1, 2], CAST(event_id % 12 AS INT) + 1)"


@query("src_12", f"""SELECT w.event_id AS evento, z.station AS estacao_id, z.zone AS grid_id, z.region AS regiao,
 CAST(w.event_id AS DOUBLE) AS latitude, -8.5 AS longitude, round(temp_max, 6) AS temp_celsius, humidity_avg AS humidity_pct,
 coalesce(CASE WHEN wind_max_kmh > 45 THEN wind_max_kmh END, 0) AS wind_kmh, precipitation_mm
FROM (SELECT *, {STATION} AS s FROM fx_weather) w JOIN {ZONE_ROWS} ON w.s = z.station""".replace("-8.5 AS longitude", "CAST(-8.5 AS DOUBLE) AS longitude"))
def station_payload(t):
    """One document per event, with a second feature that lacks its temperature."""
    stations = F.array(*[F.lit(z.station_id) for z in k.ZONES], F.lit(1), F.lit(2))
    station = F.element_at(stations, (F.col("event_id") % 12 + 1).cast("int"))

    def feature(temperature):
        return F.struct(
            F.struct(F.array(F.lit(-8.5), F.col("event_id").cast("double")).alias("coordinates")).alias("geometry"),
            F.struct(
                station.alias("idEstacao"), temperature.alias("temperatura"), F.col("humidity_avg").alias("humidade"),
                F.when(F.col("wind_max_kmh") > 45, F.col("wind_max_kmh")).alias("intensidadeVento"),
                F.col("precipitation_mm").alias("precAcum")).alias("properties"))

    document = F.to_json(F.struct(
        F.array(feature(F.col("temp_max")), feature(F.lit(None).cast("double"))).alias("features")))
    observed = payloads.station_observations(t.weather.select(document.alias("value")), received())
    return observed.select(
        F.col("latitude").cast("bigint").alias("evento"), F.col("estacao_id").cast("int"), "grid_id", "regiao",
        "latitude", "longitude", "temp_celsius", "humidity_pct", "wind_kmh", "precipitation_mm")


@query("src_13", NEAREST + f"""SELECT n.zone AS grid_id, round(h.latitude, 6) AS latitude, round(h.longitude, 6) AS longitude,
 TIMESTAMP '{RECEIVED}' AS timestamp, coalesce(bright_ti4, 0) AS brightness, round(frp, 6) AS frp_mw, confidence,
 'VIIRS_SNPP_NRT' AS satellite, CAST(acq_date AS STRING) AS acq_date, '' AS acq_time, 'nasa_firms_real' AS source
FROM fx_det h JOIN near n ON h.event_id = n.event_id AND n.rn = 1 WHERE confidence <> 'l'""")
def feed(t):
    return det.normalise_feed(t.detections.drop("grid_id", "satelite"), received())


@query("src_14", f"""SELECT d AS tipo_vegetacao, {VEGETATION_RISK} AS risco_vegetacao, count(*) AS n,
 round(sum(CASE WHEN p_partkey % 3 > 0 THEN p_retailprice ELSE 0 END), 2) AS area_ha
FROM (SELECT *, CASE WHEN p_size % 5 = 0 THEN 'Desconhecido' ELSE {VEGETATION_TEXT} END AS d FROM part) GROUP BY 1, 2""")
def vegetation_payload(t):
    described = t.table("part").selectExpr(
        "p_partkey", "p_retailprice", f"CASE WHEN p_size % 5 > 0 THEN {VEGETATION_TEXT} END AS DESCRICAO",
        "CASE WHEN p_partkey % 3 > 0 THEN p_retailprice END AS AREA_HA")
    document = F.to_json(F.struct(F.array(F.struct(F.struct("DESCRICAO", "AREA_HA").alias("attributes"))).alias("features")))
    rows = payloads.vegetation(described.select(document.alias("value")), received())
    return rows.groupBy("tipo_vegetacao", "risco_vegetacao").agg(
        F.count("*").alias("n"), F.round(F.sum("area_ha"), 2).alias("area_ha"))


# --- sinks --------------------------------------------------------------------------------------

@query("snk_03", PLACED + """SELECT event_id, ano, mes, grid_id, round(frp, 6) AS frp, round(latitude, 6) AS latitude FROM lake""")
def publish_twice(t):
    """The second load replaces the partitions of the first."""
    path = new_folder(t.spark, "hotspots")
    sink.publish_detections(zoned(t), path)
    sink.publish_detections(zoned(t), path)
    return src.read_lake(t.spark, path).select("event_id", "ano", "mes", "grid_id", "frp", "latitude")


@query("snk_04", """SELECT f AS format, ano, count(*) AS hotspots, sum(CAST(frp AS BIGINT)) AS frp FROM fx_arch_kept,
 (VALUES ('csv'), ('parquet')) x(f) GROUP BY 1, 2""".replace("sum(CAST(frp AS BIGINT))", "CAST(sum(CAST(frp AS BIGINT)) AS BIGINT)"))
def yearly_files(t):
    csv, parquet = new_folder(t.spark, "yearly-csv"), new_folder(t.spark, "yearly-parquet")
    rows = det.keep_columns(det.in_country(t.archive))
    sink.write_yearly(rows, csv, parquet)
    read = {
        "csv": t.spark.read.option("header", "true").csv(csv),
        "parquet": t.spark.read.parquet(parquet),
    }
    counts = [
        df.groupBy(F.lit(fmt).alias("format"), F.col("ano").cast("int").alias("ano"))
        .agg(F.count("*").alias("hotspots"), F.sum(F.col("frp").cast("double").cast("bigint")).alias("frp"))
        for fmt, df in read.items()
    ]
    return counts[0].unionByName(counts[1])


@query("snk_11", f"""SELECT {REGION} AS regiao, count(*) AS hotspots, (SELECT count(*) FROM fx_det) AS total_raw FROM fx_kept GROUP BY 1""")
def report(t):
    """The report's tables are stored; two of them are read back."""
    root = new_folder(t.spark, "report")
    sink.write_report(jobs.detection_report(t.detections), root)
    total = t.spark.read.parquet(f"{root}/profile").select("total_raw")
    return t.spark.read.parquet(f"{root}/per_region").withColumn("total_raw", total.scalar())


@query("qry_03", PLACED + """SELECT event_id, round(frp, 6) AS frp FROM lake WHERE ano = 2024 AND mes = 1 AND grid_id = 'PT-CENTRO-01'""")
def slice_of_lake(t):
    lake = src.read_lake(t.spark, published(t) + "/hotspots")
    return access.lake_slice(lake, 2024, 1, "PT-CENTRO-01").select("event_id", "frp")


# --- checks ----------------------------------------------------------------------------------------

@query("lk_01", PLACED + """SELECT 'hotspots' AS dataset, count(DISTINCT ano) AS years, count(DISTINCT grid_id) AS zones,
 count(DISTINCT (ano, mes, grid_id)) AS folders, TRUE AS has_files FROM lake
UNION ALL SELECT 'meteorologia', count(DISTINCT ano), 0, count(DISTINCT (ano, mes)), TRUE FROM fx_points""")
def inventory(t):
    facts = checks.inventory(jobs.lake_listing(t.spark, published(t)))
    return facts.select("dataset", "years", "zones", "folders", ((F.col("files") > 0) & (F.col("kilobytes") > 0)).alias("has_files"))


@query("lk_02", PLACED + """SELECT 'hotspots' AS prefix, count(DISTINCT (ano, mes, grid_id)) AS folders, TRUE AS has_objects FROM lake
UNION ALL SELECT 'meteorologia', count(DISTINCT (ano, mes)), TRUE FROM fx_points""")
def prefixes(t):
    root = published(t)
    counts = checks.files_per_prefix(checks.files(t.spark, root, "lake"), root)
    return counts.select("prefix", "folders", (F.col("objects") >= F.col("folders")).alias("has_objects"))


READY = """SELECT 'hotspots' AS dataset, (SELECT count(DISTINCT ano) >= 3 FROM fx_kept) AS ready
 UNION ALL SELECT 'meteorologia', (SELECT count(*) > 0 FROM fx_points) UNION ALL SELECT 'agregados_streaming', FALSE"""


@query("lk_04", f"""WITH s AS ({READY}) SELECT dataset, ready, (SELECT count(*) FILTER (ready) FROM s) AS ready_count,
 CASE (SELECT count(*) FILTER (ready) FROM s) WHEN 3 THEN 'complete' WHEN 2 THEN 'partial' ELSE 'incomplete' END AS verdict
FROM s""")
def readiness(t):
    return checks.readiness(checks.inventory(jobs.lake_listing(t.spark, published(t))))


@query("lk_05", """SELECT 'hotspots' AS dataset, CASE WHEN count(*) > 0 THEN 'skip' ELSE 'no source' END AS decision FROM fx_kept
UNION ALL SELECT 'meteorologia', CASE WHEN count(*) > 0 THEN 'reload' ELSE 'no source' END FROM fx_points
UNION ALL SELECT 'agregados_streaming', CASE WHEN count(*) > 0 THEN 'load' ELSE 'no source' END FROM fx_sensor""")
def freshness(t):
    """Detections loaded after their source, the grid's source renewed after its load, a third never loaded."""
    spark, root = t.spark, new_folder(t.spark, "sources")
    t.kept.write.parquet(f"{root}/hotspots")
    lake = published(t)
    t.points.write.parquet(f"{root}/meteorologia")
    t.sensor.write.parquet(f"{root}/agregados_streaming")
    facts = checks.freshness(jobs.lake_listing(spark, root), jobs.lake_listing(spark, lake))
    return facts.select("dataset", "decision")


@query("lk_06", """SELECT 'hotspots' AS dataset, count(DISTINCT (ano, mes)) AS folders,
 CASE WHEN count(*) > 0 THEN 'ready' ELSE 'missing' END AS state FROM fx_kept UNION ALL SELECT 'vegetacao', 0, 'missing'""")
def availability(t):
    folder = new_folder(t.spark, "hotspots")
    sink.write_partitioned(t.kept, folder, ("ano", "mes"))
    return checks.availability(checks.files(t.spark, folder, "hotspots"), ["hotspots", "vegetacao"]).drop("files")


def filled_sql(dataset: str, relation: str, present, absent=()) -> str:
    """Rows and filled ones per column of a relation; absent columns have none."""
    names = [*present, *absent]
    counts = [f"count({c})" for c in present] + ["0"] * len(absent)
    return (f"SELECT '{dataset}' AS dataset, unnest([{', '.join(repr(c) for c in names)}]) AS column_name, rows, "
            f"unnest([{', '.join(['TRUE'] * len(present) + ['FALSE'] * len(absent))}]) AS present, unnest(c) AS filled "
            f"FROM (SELECT count(*) AS rows, [{', '.join(counts)}] AS c FROM {relation})")


def lake_with_streams(t, detections, composite) -> str:
    """A published lake of three datasets."""
    root = new_folder(t.spark, "lake")
    jobs.publish(detections, t.points, root)
    sink.write_partitioned(composite, f"{root}/agregados_streaming", ("grid_id",))
    return root


@query("prj_09", f"""WITH {windowed('fx_sensor', 'ws')}, {windowed('fx_hotspot', 'wh')},
a AS (SELECT w, grid_id FROM ws GROUP BY w, grid_id), b AS (SELECT w, grid_id, count(*) AS n, avg(frp) AS f FROM wh GROUP BY w, grid_id),
s AS (SELECT b.n AS n_hotspots, b.f AS frp_medio FROM a LEFT JOIN b ON a.w = b.w AND a.grid_id = b.grid_id)
""" + filled_sql("hotspots", "fx_kept", ("latitude", "longitude", "frp", "acq_date"), ("confidence",))
    + " UNION ALL " + filled_sql("meteorologia", "fx_points", ("temp_c", "rh", "wind_speed_kmh"))
    + " UNION ALL " + filled_sql("agregados_streaming", "s", ("n_hotspots", "frp_medio"), ("risco_composto",)))
def required_columns(t):
    """Three stored datasets: one lacks a column, one is whole, one was joined with detections alone."""
    windows = w.sensor_windows(t.sensor, WINDOW, SLIDE).join(
        w.detection_windows(t.detection_events, WINDOW, SLIDE), ["window", "grid_id"], "left")
    root = lake_with_streams(t, t.kept.drop("grid_id", "confidence"), edges(windows))
    return checks.required_columns({name: src.read_lake(t.spark, f"{root}/{name}") for name in k.LAKE_PREFIXES})


@query("prj_10", COMPOSITE + """SELECT CASE WHEN day(janela_inicio) % 2 = 0 THEN 'v1' ELSE 'v2' END AS version, count(*) AS rows,
 count(DISTINCT grid_id) AS zones, min(janela_inicio) AS first_window, max(janela_inicio) AS last_window FROM composite GROUP BY 1""")
def output_versions(t):
    """One folder with files of two versions: sensors alone on even days, all three streams on the others."""
    path, even = new_folder(t.spark, "agregados"), F.day("janela_inicio") % 2 == 0
    edges(w.sensor_windows(t.sensor, WINDOW, SLIDE)).filter(even).write.parquet(path)
    composite(t).filter(~even).write.mode("append").parquet(path)
    return checks.output_versions(t.spark.read.option("mergeSchema", "true").parquet(path)).drop("files")


HOTSPOT_COLUMNS = ("latitude", "longitude", "bright_ti4", "bright_ti5", "frp", "acq_date", "confidence", "daynight",
                   "satelite", "ano", "mes", "dia", "grid_id", "event_id", "event_time")
DESCRIBED = "(VALUES " + ", ".join(
    f"('{dataset}', '{origin}', '{column}', '{text}')" for dataset, origins in k.CATALOGUE.items()
    for origin, columns in origins.items() for column, text in columns.items()) + ") d(dataset, origin, column_name, description)"


@query("lk_07", COMPOSITE + ", found AS (" + filled_sql("hotspots", "fx_kept", HOTSPOT_COLUMNS, ("acq_time", "satellite"))
       + " UNION ALL " + filled_sql("agregados_streaming", "composite", [c for o in k.COMPOSITE_CATALOGUE.values() for c in o])
       + f""") SELECT f.dataset, coalesce(d.origin, 'uncatalogued') AS origin, f.column_name, coalesce(d.description, '') AS description,
 f.present, f.rows, f.filled FROM found f LEFT JOIN {DESCRIBED} ON f.dataset = d.dataset AND f.column_name = d.column_name""")
def catalogue(t):
    root = lake_with_streams(t, t.kept.drop("grid_id"), composite(t))
    tables = [checks.column_catalogue(src.read_lake(t.spark, f"{root}/{name}"), name) for name in k.CATALOGUE]
    return tables[0].unionByName(tables[1])


@query("lk_08", PLACED + "SELECT DISTINCT CAST(ano AS VARCHAR) AS ano, CAST(mes AS VARCHAR) AS mes, grid_id FROM lake")
def post_load(t):
    listing = checks.files(t.spark, published(t) + "/hotspots", "hotspots")
    return checks.loaded_partitions(listing, sink.DETECTION_PARTITIONS).filter("bytes > 0").select(*sink.DETECTION_PARTITIONS)
