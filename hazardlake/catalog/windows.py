"""Window aggregates, joins and the composite table in batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.catalog.registry import query
from hazardlake.operators import windows as w
from hazardlake.sources import detections, payloads

# Windows wide enough for sparse events: 12 hours sliding by 6.
WINDOW, SLIDE = "12 hours", "6 hours"


def windowed(view: str, label: str) -> str:
    """Every event once per window it falls in."""
    return (f"{label} AS (SELECT e.*, time_bucket(INTERVAL 6 HOURS, e.event_time) "
            f"- s.k * INTERVAL 6 HOURS AS w FROM {view} e, (VALUES (0), (1)) s(k))")


SENSOR_AGGREGATES = """count(*) AS n_leituras_sensor, round(avg(risk_score), 6) AS risk_medio_sensor,
  max(risk_score) AS risk_maximo_sensor, round(avg(temp_celsius), 6) AS temp_media,
  round(avg(humidity_pct), 6) AS humidade_media, round(avg(wind_kmh), 6) AS vento_medio"""
DETECTION_AGGREGATES = """count(*) AS n_hotspots, round(avg(frp), 6) AS frp_medio,
  round(max(frp), 6) AS frp_maximo, round(avg(bright_ti4), 6) AS brightness_media"""
WEATHER_AGGREGATES = """round(avg(temp_max), 6) AS temp_max_media, round(avg(humidity_avg), 6) AS humidade_ipma,
  round(avg(wind_max_kmh), 6) AS vento_max_ipma, round(avg(precipitation_mm), 6) AS precipitacao_media"""

COMPOSITE = f"""WITH {windowed('fx_sensor', 'ws')}, {windowed('fx_hotspot', 'wh')}, {windowed('fx_weather', 'ww')},
a AS (SELECT w, grid_id, count(*) AS n, avg(risk_score) AS r, max(risk_score) AS rx, avg(temp_celsius) AS t,
  avg(humidity_pct) AS h, avg(wind_kmh) AS v FROM ws GROUP BY w, grid_id),
b AS (SELECT w, grid_id, count(*) AS n, avg(frp) AS f, max(frp) AS fx FROM wh GROUP BY w, grid_id),
c AS (SELECT w, grid_id, avg(temp_max) AS t, avg(humidity_avg) AS h, avg(wind_max_kmh) AS v,
  avg(precipitation_mm) AS p FROM ww GROUP BY w, grid_id),
composite AS (SELECT a.w AS janela_inicio, a.w + INTERVAL 12 HOURS AS janela_fim, a.grid_id,
  a.n AS n_leituras_sensor, round(a.r, 6) AS risk_medio_sensor, a.rx AS risk_maximo_sensor,
  round(a.t, 6) AS temp_media, round(a.h, 6) AS humidade_media, round(a.v, 6) AS vento_medio,
  coalesce(b.n, 0) AS n_hotspots, round(coalesce(b.f, 0), 6) AS frp_medio, round(coalesce(b.fx, 0), 6) AS frp_maximo,
  round(c.t, 6) AS temp_max_media, round(c.h, 6) AS humidade_ipma, round(c.v, 6) AS vento_max_ipma,
  round(c.p, 6) AS precipitacao_media,
  round(coalesce(a.r, 0) * 0.60 + coalesce(b.f, 0) / 200.0 * 100.0 * 0.25
    + coalesce(c.v, 0) / 150.0 * 100.0 * 0.15, 6) AS risco_composto
FROM a LEFT JOIN b ON a.w = b.w AND a.grid_id = b.grid_id LEFT JOIN c ON a.w = c.w AND a.grid_id = c.grid_id)
"""


def edges(frame):
    rest = [c for c in frame.columns if c != "window"]
    return frame.select(F.col("window.start").alias("janela_inicio"), F.col("window.end").alias("janela_fim"), *rest)


def window_sql(view: str, aggregates: str) -> str:
    return (f"WITH {windowed(view, 'x')} SELECT w AS janela_inicio, w + INTERVAL 12 HOURS AS janela_fim, "
            f"grid_id, {aggregates} FROM x GROUP BY w, grid_id")


@query("agg_01", window_sql("fx_sensor", SENSOR_AGGREGATES))
def sensor_windows(t):
    return edges(w.sensor_windows(t.sensor, WINDOW, SLIDE))


@query("agg_02", window_sql("fx_hotspot", DETECTION_AGGREGATES))
def detection_windows(t):
    return edges(w.detection_windows(t.detection_events, WINDOW, SLIDE))


@query("agg_03", window_sql("fx_weather", WEATHER_AGGREGATES))
def weather_windows(t):
    return edges(w.weather_windows(t.weather, WINDOW, SLIDE))


def composite(t):
    return w.composite(t.sensor, t.detection_events, t.weather, WINDOW, SLIDE)


query("agg_04", COMPOSITE + "SELECT * FROM composite")(composite)


@query("jn_01", f"""WITH {windowed('fx_sensor', 'ws')}, {windowed('fx_hotspot', 'wh')}, {windowed('fx_weather', 'ww')},
a AS (SELECT w, grid_id, {SENSOR_AGGREGATES} FROM ws GROUP BY w, grid_id),
b AS (SELECT w, grid_id, {DETECTION_AGGREGATES} FROM wh GROUP BY w, grid_id),
c AS (SELECT w, grid_id, {WEATHER_AGGREGATES} FROM ww GROUP BY w, grid_id)
SELECT a.w AS janela_inicio, a.w + INTERVAL 12 HOURS AS janela_fim, a.* EXCLUDE (w),
  b.* EXCLUDE (w, grid_id), c.* EXCLUDE (w, grid_id)
FROM a LEFT JOIN b ON a.w = b.w AND a.grid_id = b.grid_id LEFT JOIN c ON a.w = c.w AND a.grid_id = c.grid_id""")
def joined(t):
    return edges(w.join_sources(
        w.sensor_windows(t.sensor, WINDOW, SLIDE),
        w.detection_windows(t.detection_events, WINDOW, SLIDE),
        w.weather_windows(t.weather, WINDOW, SLIDE)))


@query("prj_14", COMPOSITE + """SELECT janela_inicio, grid_id, n_hotspots, frp_medio, frp_maximo
FROM composite WHERE n_hotspots = 0""")
def null_to_zero(t):
    empty = composite(t).filter("n_hotspots = 0")
    return empty.select("janela_inicio", "grid_id", "n_hotspots", "frp_medio", "frp_maximo")


@query("scl_03", COMPOSITE + """SELECT grid_id, count(*) AS windows, round(avg(risco_composto), 5) AS mean_index,
  round(max(risco_composto), 5) AS max_index FROM composite GROUP BY grid_id""")
def composite_index(t):
    index = composite(t).groupBy("grid_id").agg(
        F.count("*").alias("windows"), F.avg("risco_composto").alias("m"), F.max("risco_composto").alias("x"))
    return index.select("grid_id", "windows", F.round("m", 5).alias("mean_index"), F.round("x", 5).alias("max_index"))


@query("str_02", f"""WITH {windowed('fx_sensor', 'x')} SELECT event_id, w AS janela_inicio,
  w + INTERVAL 12 HOURS AS janela_fim FROM x""")
def sliding_windows(t):
    return t.sensor.select("event_id", F.window("event_time", WINDOW, SLIDE).alias("window")).select(
        "event_id", F.col("window.start").alias("janela_inicio"), F.col("window.end").alias("janela_fim"))


@query("prj_01", f"""WITH {windowed('fx_weather', 'x')} SELECT w AS inicio, w + INTERVAL 12 HOURS AS fim,
  count(*) AS n FROM x GROUP BY w""")
def struct_fields(t):
    return (t.weather.select(F.struct("*").alias("d")).select("d.*")
            .groupBy(F.window("event_time", WINDOW, SLIDE)).agg(F.count("*").alias("n"))
            .select(F.col("window.start").alias("inicio"), F.col("window.end").alias("fim"), "n"))


# --- dimension joins ---------------------------------------------------------------------

ZONE_ROWS = """(VALUES (0, 'PT-NORTE-01', 41.55, -8.42, 'Braga', 1200535),
 (1, 'PT-NORTE-02', 41.69, -7.91, 'Braganca', 1200562), (2, 'PT-CENTRO-01', 40.20, -8.41, 'Coimbra', 1210713),
 (3, 'PT-CENTRO-02', 39.82, -7.49, 'Castelo Branco', 1200524), (4, 'PT-CENTRO-03', 40.64, -8.65, 'Aveiro', 1200514),
 (5, 'PT-LVT-01', 39.35, -8.13, 'Santarem', 1200609), (6, 'PT-LVT-02', 38.71, -9.14, 'Lisboa', 1200519),
 (7, 'PT-ALENTEJO-01', 38.57, -7.91, 'Evora', 1200546), (8, 'PT-ALENTEJO-02', 37.80, -7.49, 'Beja', 1200502),
 (9, 'PT-ALGARVE-01', 37.10, -8.67, 'Faro', 1200588))
 z(pos, zone, zlat, zlon, region, station)"""

NEAREST = f"""WITH near AS (SELECT h.event_id, z.zone, row_number() OVER (PARTITION BY h.event_id ORDER BY
  (CAST(z.zlat AS DOUBLE) - h.latitude) * (CAST(z.zlat AS DOUBLE) - h.latitude)
  + (CAST(z.zlon AS DOUBLE) - h.longitude) * (CAST(z.zlon AS DOUBLE) - h.longitude), z.pos) AS rn
 FROM fx_hotspot h, {ZONE_ROWS}) """


@query("spa_01", NEAREST + "SELECT event_id, zone AS grid_id FROM near WHERE rn = 1")
def nearest_zone(t):
    return detections.with_zone(t.hotspot.drop("grid_id")).select("event_id", "grid_id")


@query("jn_03", NEAREST + """SELECT zone AS grid_id, count(*) AS hotspots FROM near WHERE rn = 1 GROUP BY zone""")
def points_per_zone(t):
    return (detections.with_zone(t.hotspot.drop("grid_id"))
            .groupBy("grid_id").agg(F.count("*").alias("hotspots")))


STATION_OF_EVENT = """CASE CAST(user_id % 12 AS INT) WHEN 0 THEN 1200535 WHEN 1 THEN 1200562 WHEN 2 THEN 1210713
 WHEN 3 THEN 1200524 WHEN 4 THEN 1200514 WHEN 5 THEN 1200609 WHEN 6 THEN 1200519 WHEN 7 THEN 1200546
 WHEN 8 THEN 1200502 WHEN 9 THEN 1200588 WHEN 10 THEN 1 ELSE 2 END"""


@query("jn_02", f"""SELECT e.event_id, z.station AS estacao_id, z.zone AS grid_id, z.region AS regiao
FROM (SELECT event_id, {STATION_OF_EVENT} AS s FROM events) e JOIN {ZONE_ROWS} ON e.s = z.station""")
def station_lookup(t):
    events = t.table("events").selectExpr("event_id", f"CAST({STATION_OF_EVENT} AS INT) AS estacao_id")
    known = payloads.with_station_zone(events)
    return known.select("event_id", F.col("estacao_id").cast("int"), "grid_id", "regiao")


@query("jn_04", NEAREST + f""", placed AS (SELECT event_id, zone AS grid_id FROM near WHERE rn = 1)
SELECT p.event_id, p.grid_id, CAST(z.zlat AS DOUBLE) AS zone_latitude, CAST(z.zlon AS DOUBLE) AS zone_longitude,
 z.region AS regiao FROM placed p LEFT JOIN {ZONE_ROWS} ON p.grid_id = z.zone""")
def zone_facts(t):
    placed = detections.with_zone(t.hotspot.drop("grid_id")).select("event_id", "grid_id")
    return payloads.with_zone_facts(placed)
