"""Projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake import constants as k
from hazardlake.catalog.fixtures import BOX, LEVEL, REGION
from hazardlake.catalog.registry import query
from hazardlake.functions import calendar, climate, geo, hazard, values
from hazardlake.operators import access, detections as det_ops, stats
from hazardlake.sources import detections

CRITICAL = "temp_celsius > 35 AND humidity_pct < 20 AND wind_kmh > 30"
MONTH_LIST = "['Jan','Fev','Mar','Abr','Mai','Jun','Jul','Ago','Set','Out','Nov','Dez']"
AS_OF = "2024-02-01 00:00:00"


# --- scores and levels -------------------------------------------------------------------

@query("scl_01", "SELECT event_id, risk_score FROM fx_sensor")
def risk_score(t):
    return t.sensor.select("event_id", "risk_score")


@query("scl_02", f"SELECT event_id, {LEVEL} AS risk_level FROM fx_sensor")
def risk_level(t):
    return t.sensor.select("event_id", hazard.risk_level(F.col("risk_score")).alias("risk_level"))


@query("scl_12", f"SELECT event_id, {CRITICAL} AS critical FROM fx_sensor")
def critical_weather(t):
    flag = hazard.critical_weather(F.col("temp_celsius"), F.col("humidity_pct"), F.col("wind_kmh"))
    return t.sensor.select("event_id", flag.alias("critical"))


@query("scl_11", f"""SELECT event_id, concat('temp>', CAST(temp_celsius AS STRING), 'C hum<',
  CAST(humidity_pct AS STRING), '% vento>', CAST(wind_kmh AS STRING), 'kmh') AS trigger
FROM fx_sensor WHERE {CRITICAL}""")
def trigger_text(t):
    args = F.col("temp_celsius"), F.col("humidity_pct"), F.col("wind_kmh")
    return t.sensor.filter(hazard.critical_weather(*args)).select("event_id", hazard.trigger_text(*args).alias("trigger"))


# --- time -----------------------------------------------------------------------------------

@query("scl_04", """SELECT event_id, event_time AS from_z, event_time - INTERVAL 1 HOUR AS from_offset,
  CAST(NULL AS TIMESTAMP) AS from_text FROM fx_weather""")
def parse_instant(t):
    text = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return t.weather.select(
        "event_id",
        calendar.parse_instant(F.concat(text, F.lit("Z"))).alias("from_z"),
        calendar.parse_instant(F.concat(text, F.lit("+01:00"))).alias("from_offset"),
        calendar.parse_instant(F.concat(F.lit("at "), text)).alias("from_text"))


@query("scl_05", """SELECT event_id, strftime(date_trunc('hour', event_time), '%Y-%m-%dT%H:%M:%S') AS hour_bucket
FROM fx_sensor""")
def hour_bucket(t):
    return t.sensor.select("event_id", calendar.hour_bucket(F.col("event_time")).alias("hour_bucket"))


@query("scl_06", f"""SELECT event_id, round((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(event_time)) / 1000.0, 6)
  AS latency_ms FROM fx_sensor""")
def latency(t):
    as_of = F.lit(AS_OF).cast("timestamp")
    return t.sensor.select("event_id", calendar.latency_ms(F.col("event_time"), as_of).alias("latency_ms"))


@query("scl_08", """SELECT mes, CASE WHEN mes BETWEEN 6 AND 9 THEN 'Verão (Jun–Set)' ELSE 'Resto do ano' END AS epoca,
  count(*) AS n FROM fx_arch GROUP BY 1, 2""")
def season(t):
    return t.archive.groupBy("mes", calendar.season(F.col("mes")).alias("epoca")).agg(F.count("*").alias("n"))


@query("scl_09", f"""SELECT daynight, CASE daynight WHEN 'D' THEN 'Diurno' WHEN 'N' THEN 'Noturno' END AS periodo,
  {MONTH_LIST}[mes] AS mes_l, count(*) AS n FROM fx_arch GROUP BY 1, 2, 3""")
def value_maps(t):
    return t.archive.groupBy(
        "daynight", calendar.day_period(F.col("daynight")).alias("periodo"),
        calendar.month_label(F.col("mes")).alias("mes_l")).agg(F.count("*").alias("n"))


@query("prj_02", """SELECT l_orderkey, l_linenumber, ano, mes, dia FROM fx_arch""")
def calendar_parts(t):
    return t.archive.select("l_orderkey", "l_linenumber", "ano", "mes", "dia")


# --- casts, text, JSON ------------------------------------------------------------------------

@query("scl_07", """SELECT event_id, TRY_CAST(CASE WHEN event_type = 'click' THEN concat('x', CAST(event_id AS STRING))
  ELSE CAST(event_id AS STRING) END AS DOUBLE) AS number FROM events""")
def safe_double(t):
    text = F.when(F.col("event_type") == "click", F.concat(F.lit("x"), F.col("event_id").cast("string")))
    return t.table("events").select(
        "event_id", values.safe_double(text.otherwise(F.col("event_id").cast("string"))).alias("number"))


VEGETATION_TEXT = """concat(CASE p_size % 8 WHEN 0 THEN 'Eucalipto ' WHEN 1 THEN 'Pinheiro manso ' WHEN 2 THEN 'Sobreiro '
 WHEN 3 THEN 'Territorio URBANO ' WHEN 4 THEN 'Pastagem com mato ' WHEN 5 THEN 'Curso de agua '
 WHEN 6 THEN 'Floresta de carvalho ' ELSE 'Eucaliptal ' END, p_type)"""
VEGETATION_RISK = """CASE WHEN regexp_matches(lower(d), 'eucalipto|pinheiro|mato|arbustivo') THEN 'HIGH'
 WHEN regexp_matches(lower(d), 'carvalho|sobreiro|floresta') THEN 'MEDIUM'
 WHEN regexp_matches(lower(d), 'urbano|agua|agricola|pastagem') THEN 'LOW' ELSE 'MEDIUM' END"""


@query("scl_10", f"""SELECT p_partkey, d AS descricao, {VEGETATION_RISK} AS risco
FROM (SELECT p_partkey, {VEGETATION_TEXT} AS d FROM part)""")
def vegetation_risk(t):
    described = t.table("part").selectExpr("p_partkey", f"{VEGETATION_TEXT} AS descricao")
    return described.withColumn("risco", values.vegetation_risk(F.col("descricao")))


@query("scl_16", """SELECT event_id, concat('{"grid_id":"', grid_id, '","hotspot_count":', CAST(hotspot_count AS STRING),
  ',"temp_celsius":', coalesce(CAST(temp_celsius AS STRING), 'null'), '}') AS value FROM fx_sensor""")
def as_json(t):
    return t.sensor.select("event_id", values.as_json("grid_id", "hotspot_count", "temp_celsius").alias("value"))


BANDED = """SELECT topic, CASE WHEN latency_ms >= 2000 THEN 'red' WHEN latency_ms >= 500 THEN 'orange' ELSE 'green' END
  AS band, count(*) AS n FROM fx_latency GROUP BY 1, 2"""


@query("scl_15", BANDED)
def metric_bands(t):
    band = values.metric_band("latency_ms", F.col("latency_ms")).alias("band")
    return t.latency.groupBy("topic", band).agg(F.count("*").alias("n"))


@query("scl_17", """SELECT event_id, round(least(frp, (SELECT quantile_cont(frp, 0.99) FROM fx_kept)), 6) AS frp
FROM fx_kept""")
def clip(t):
    return stats.clip_upper(t.kept.select("event_id", "frp"), "frp", 0.99)


# --- filters and projections -----------------------------------------------------------------

@query("prj_03", f"SELECT event_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM fx_hotspot WHERE {BOX}")
def inside(t):
    return t.hotspot.filter(geo.inside_box(F.col("latitude"), F.col("longitude"))).select("event_id", "latitude", "longitude")


@query("prj_04", """SELECT event_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM fx_hotspot
WHERE latitude < 36.9 OR latitude > 42.2 OR longitude < -9.5 OR longitude > -6.2""")
def outside(t):
    return det_ops.out_of_country(t.hotspot).select("event_id", "latitude", "longitude")


@query("prj_05", "SELECT event_id, confidence FROM fx_hotspot WHERE lower(coalesce(confidence, 'nominal')) NOT IN ('low', 'l')")
def confident(t):
    return t.hotspot.filter(values.known_confidence(F.col("confidence"))).select("event_id", "confidence")


@query("prj_06", f"""SELECT l_orderkey, l_linenumber, {MONTH_LIST}[mes] AS mes_l FROM fx_arch WHERE mes BETWEEN 5 AND 10""")
def fire_season(t):
    return t.archive.filter(F.col("mes").isin(*k.FIRE_SEASON_MONTHS)).select(
        "l_orderkey", "l_linenumber", calendar.month_label(F.col("mes")).alias("mes_l"))


@query("prj_07", "SELECT event_id, round(temp_celsius, 6) AS temp_celsius, humidity_pct FROM fx_sensor WHERE temp_celsius IS NOT NULL AND humidity_pct IS NOT NULL")
def complete_readings(t):
    return t.sensor.dropna(subset=["temp_celsius", "humidity_pct"]).select("event_id", "temp_celsius", "humidity_pct")


@query("prj_11", """SELECT grid_id, strftime(date_trunc('hour', event_time), '%Y-%m-%dT%H:%M:%S') AS hour_bucket,
 event_time, 'nasa_firms' AS source, coalesce(bright_ti4, 0) AS temp_celsius, CAST(0 AS DOUBLE) AS humidity_pct,
 CAST(0 AS DOUBLE) AS wind_kmh, 1 AS hotspot_count, round(frp, 6) AS risk_score, round(latitude, 6) AS latitude,
 round(longitude, 6) AS longitude, 'detection' AS kind FROM fx_hotspot""")
def detection_rows(t):
    return access.detection_rows(t.detection_events)


@query("prj_12", "SELECT event_id, frp = 0 AS suspicious FROM (SELECT event_id, CASE WHEN confidence = 'l' THEN 0 ELSE frp END AS frp FROM fx_hotspot)")
def zero_intensity(t):
    frp = F.when(F.col("confidence") == "l", 0.0).otherwise(F.col("frp"))
    return t.hotspot.select("event_id", values.zero_intensity(frp).alias("suspicious"))


@query("prj_13", "SELECT event_id, round(coalesce(temp_celsius, 0.0), 6) AS temp_celsius, coalesce(nullif(source, 'ipma_real'), 'iot_simulator_v1') AS source FROM fx_sensor")
def defaults(t):
    return t.sensor.select(
        "event_id", values.or_default(F.col("temp_celsius"), 0.0).alias("temp_celsius"),
        values.or_default(F.nullif(F.col("source"), F.lit("ipma_real")), k.SIMULATED_SOURCE).alias("source"))


@query("prj_15", """SELECT event_id, g IS NULL OR g IN ('PT-UNKNOWN', '') AS unknown FROM (SELECT event_id,
 CASE confidence WHEN 'l' THEN 'PT-UNKNOWN' WHEN 'n' THEN grid_id END AS g FROM fx_hotspot)""")
def unknown_zone(t):
    zone = F.when(F.col("confidence") == "l", "PT-UNKNOWN").when(F.col("confidence") == "n", F.col("grid_id"))
    return t.hotspot.select("event_id", values.unknown_zone(zone).alias("unknown"))


# --- spatial and physical derivations ----------------------------------------------------------

@query("spa_02", f"SELECT event_id, {REGION} AS regiao FROM fx_hotspot")
def region(t):
    return t.hotspot.select("event_id", geo.region(F.col("latitude")).alias("regiao"))


@query("spa_03", """SELECT event_id, round(CASE WHEN lon > 180 THEN lon - 360 ELSE lon END, 6) AS longitude
FROM (SELECT event_id, longitude + CASE WHEN longitude < 0 THEN 360 ELSE 0 END AS lon FROM fx_hotspot)""")
def wrap(t):
    longitude = F.col("longitude")
    east = F.when(longitude < 0, longitude + 360).otherwise(longitude)
    return t.hotspot.select("event_id", geo.wrap_longitude(east).alias("longitude"))


@query("spa_04", "SELECT l_orderkey, l_linenumber, round(temp_c, 6) AS temp_c, round(dewpoint_c, 6) AS dewpoint_c FROM fx_weather_vars")
def celsius(t):
    return t.grid.select("l_orderkey", "l_linenumber", climate.celsius(F.col("t2m")).alias("temp_c"),
                         climate.celsius(F.col("d2m")).alias("dewpoint_c"))


@query("spa_05", "SELECT l_orderkey, l_linenumber, round(wind_speed_kmh, 6) AS wind_speed_kmh FROM fx_weather_vars")
def wind_speed(t):
    return t.grid.select("l_orderkey", "l_linenumber",
                         climate.wind_speed_kmh(F.col("u10"), F.col("v10")).alias("wind_speed_kmh"))


@query("spa_06", "SELECT l_orderkey, l_linenumber, round(rh, 6) AS rh FROM fx_humid")
def humidity(t):
    rh = climate.relative_humidity(climate.celsius(F.col("t2m")), climate.celsius(F.col("d2m")))
    return t.grid.select("l_orderkey", "l_linenumber", rh.alias("rh"))


@query("spa_07", "SELECT l_orderkey, l_linenumber, round(precip_mm_dia, 6) AS precip_mm_dia, round(evap_mm_dia, 6) AS evap_mm_dia FROM fx_weather_vars")
def water(t):
    return t.grid.select("l_orderkey", "l_linenumber",
                         climate.daily_precipitation(F.col("mtpr")).alias("precip_mm_dia"),
                         climate.daily_evaporation(F.col("mer")).alias("evap_mm_dia"))


# --- sort and set operations ---------------------------------------------------------------------

@query("srt_01", """SELECT CAST(event_time AS DATE) AS acq_date, grid_id, round(frp, 6) AS frp, confidence, daynight
FROM fx_hotspot ORDER BY event_time, event_id LIMIT 3""")
def preview(t):
    columns = ("acq_date", "grid_id", "frp", "confidence", "daynight", "absent")
    return access.preview(t.detections, columns, ("event_time", "event_id"), 3)


@query("srt_03", "SELECT string_agg(CAST(ano AS STRING), ',' ORDER BY ano) AS anos FROM (SELECT DISTINCT ano FROM fx_arch)")
def years(t):
    return access.sorted_years(t.archive).select(F.array_join(F.col("anos").cast("array<string>"), ",").alias("anos"))


@query("set_01", """SELECT event_id, confidence, satelite FROM fx_hotspot""")
def union_of_files(t):
    first, second = (t.hotspot.filter(F.col("satelite") == s) for s in ("VIIRS S-NPP", "VIIRS NOAA-20"))
    return access.union_all([first.select("event_id", "confidence", "satelite"), second]).select(
        "event_id", "confidence", "satelite")


@query("set_02", "SELECT source, count(*) AS leituras FROM fx_sensor GROUP BY source")
def merged_sources(t):
    return access.merge_sources(t.sensor.filter("source = 'iot_simulator_v1'"), t.sensor.filter("source = 'ipma_real'"))


@query("src_07", """SELECT event_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, bright_ti4, bright_ti5, round(frp, 6) AS frp,
 CAST(event_time AS DATE) AS acq_date, confidence, daynight, satelite, ano, mes, dia FROM fx_det""")
def present_columns(t):
    return detections.keep_columns(t.detections, ("event_id", *k.DETECTION_COLUMNS))
