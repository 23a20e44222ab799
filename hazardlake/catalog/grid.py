"""Profile tables of the gridded reanalysis."""

from __future__ import annotations

from hazardlake.catalog.detections import box_sql, corr_sql
from hazardlake.catalog.registry import query
from hazardlake.operators import climate_grid as ops
from hazardlake.sources import climate_grid as src

MEANS = ("temp_c", "dewpoint_c", "rh", "wind_speed_kmh", "precip_mm_dia", "evap_mm_dia")


def series(t):
    return ops.country_series(t.points)


def dense_sql(expression: str, name: str, where: str = "TRUE", empty: str = "0") -> str:
    return (f"SELECT m.mes, coalesce(s.v, {empty}) AS {name} FROM fx_months m LEFT JOIN (SELECT mes, {expression} AS v "
            f"FROM fx_series WHERE {where} GROUP BY mes) s ON m.mes = s.mes")


@query("agg_30", "SELECT time, " + ", ".join(f"round({c}, 6) AS {c}" for c in MEANS)
       + ", risco_alto, ano, mes, dia, hora FROM fx_series")
def country_series(t):
    return series(t)


@query("agg_31", """SELECT mes, round(avg(temp_c), 6) AS media, round(max(temp_c), 6) AS maxima,
 round(min(temp_c), 6) AS minima FROM fx_series GROUP BY mes""")
def monthly_temperature(t):
    return ops.monthly_temperature(series(t))


@query("agg_32", box_sql("fx_series", "mes", "temp_c"))
def temperature_box(t):
    return ops.monthly_box(series(t), "temp_c")


@query("agg_33", dense_sql("round(avg(rh), 6)", "rh"))
def monthly_humidity(t):
    return ops.monthly_mean(series(t), "rh")


@query("agg_34", dense_sql("count(*)", "obs_secas", "rh < 20"))
def dry_instants(t):
    return ops.dry_instants(series(t))


@query("agg_35", dense_sql("round(avg(wind_speed_kmh), 6)", "wind_speed_kmh"))
def monthly_wind(t):
    return ops.monthly_mean(series(t), "wind_speed_kmh")


@query("agg_36", box_sql("fx_series", "mes", "wind_speed_kmh"))
def wind_box(t):
    return ops.monthly_box(series(t), "wind_speed_kmh")


@query("agg_37", dense_sql("round(sum(precip_mm_dia), 6)", "precip_mm_dia"))
def monthly_precipitation(t):
    return ops.monthly_sum(series(t), "precip_mm_dia")


@query("agg_38", "SELECT mes, " + ", ".join(
    f"round(avg(temp_c) FILTER (hora = {h}), 9) AS h{h:02d}" for h in range(24)) + " FROM fx_series GROUP BY mes",
    decimals=9)
def temperature_by_hour(t):
    return ops.temperature_by_hour(series(t))


@query("agg_39", dense_sql("count(*)", "obs_risco", "risco_alto"))
def high_risk_instants(t):
    return ops.high_risk_instants(series(t))


@query("agg_40", corr_sql("fx_series", ("temp_c", "rh", "wind_speed_kmh", "precip_mm_dia", "evap_mm_dia", "mes")))
def correlations(t):
    return ops.correlations(series(t))


@query("agg_41", """SELECT round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, round(avg(temp_c), 6) AS temp_c
FROM fx_points GROUP BY latitude, longitude""")
def temperature_map(t):
    return ops.temperature_map(t.points)


@query("agg_42", """SELECT count(*) AS n_registos, count(DISTINCT (latitude, longitude)) AS n_pts_grid,
 strftime(min(time), '%Y-%m-%d') AS periodo_ini, strftime(max(time), '%Y-%m-%d') AS periodo_fim,
 (SELECT string_agg(CAST(ano AS STRING), ',' ORDER BY ano) FROM (SELECT DISTINCT ano FROM fx_points)) AS anos,
 round(avg(temp_c), 1) AS temp_media, round(max(temp_c), 1) AS temp_max, round(min(temp_c), 1) AS temp_min,
 round(avg(rh), 1) AS rh_media, round(avg(wind_speed_kmh), 1) AS vento_medio, round(max(wind_speed_kmh), 1) AS vento_max,
 count(*) FILTER (risco_alto) AS obs_risco, round(count(*) FILTER (risco_alto) * 100.0 / greatest(count(*), 1), 2) AS pct_risco
FROM fx_points""")
def profile(t):
    return ops.profile(t.points)


@query("src_11", """SELECT time, latitude, longitude, max(t2m) AS t2m, round(max(u10), 6) AS u10
FROM (SELECT time, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, t2m, u10 FROM fx_weather_vars)
GROUP BY time, latitude, longitude""")
def merged_variables(t):
    """Two files with different variables, one of them under the newer name of the time axis."""
    key = ["time", "latitude", "longitude"]
    grid = t.grid.dropna(subset=["latitude", "longitude"])
    first = grid.select(*key, "t2m")
    second = grid.select(*key, "u10").withColumnRenamed("time", "valid_time")
    return src.merge_by_coordinates([first, second])
