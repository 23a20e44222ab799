"""Detections joined with the reanalysis, rolling means, equal-area cells, and risk predictions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from hazardlake import constants as k
from hazardlake.catalog.fixtures import REGION
from hazardlake.catalog.registry import query
from hazardlake.functions.geo import region
from hazardlake.operators import features, risk_model
from hazardlake.session import new_folder

# the archive has few instants per point, so a match may be a month old
TOLERANCE_HOURS = 720
DETECTED = "acq_time_at + make_interval(0, 0, 0, 0, CAST(l_orderkey * 7 % 24 AS INT), 20, 0)"


def snapped(column: str, origin: float) -> str:
    return f"CAST(floor(({column} - {origin}) / 0.25 + 0.5) AS INT)"


POINT = f"{snapped('latitude', 36.9)} AS ponto_lat, {snapped('longitude', -9.5)} AS ponto_lon"


@query("ft_01", f"""WITH d AS (SELECT l_orderkey, l_linenumber, {POINT},
   acq_time_at + to_hours(l_orderkey * 7 % 24) + INTERVAL 20 MINUTES AS event_time FROM fx_arch),
 w AS (SELECT {POINT}, time, avg(temp_c) AS temp_c, avg(rh) AS rh, avg(wind_speed_kmh) AS wind FROM fx_points GROUP BY ALL),
 m AS (SELECT d.*, w.time, w.temp_c, w.rh, w.wind, w.time >= d.event_time - INTERVAL {TOLERANCE_HOURS} HOURS AS near FROM d
   ASOF LEFT JOIN w ON d.ponto_lat = w.ponto_lat AND d.ponto_lon = w.ponto_lon AND d.event_time >= w.time)
SELECT l_orderkey, l_linenumber, event_time, ponto_lat, ponto_lon, CASE WHEN near THEN time END AS matched_time,
 CASE WHEN near THEN round(temp_c, 6) END AS temp_c, CASE WHEN near THEN round(rh, 6) END AS rh,
 CASE WHEN near THEN round(wind, 6) END AS wind_speed_kmh FROM m""")
def detections_with_weather(t):
    detected = t.archive.select("l_orderkey", "l_linenumber", "latitude", "longitude", F.expr(DETECTED).alias("event_time"))
    return features.detections_with_weather(detected, t.points, tolerance_hours=TOLERANCE_HOURS).drop("latitude", "longitude")


def mean_over(days: int) -> str:
    window = f"(PARTITION BY regiao ORDER BY dia RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW)"
    return f"round(sum(soma) OVER {window} / nullif(sum(n) OVER {window}, 0), 6) AS media_{days}d"


@query("ft_02", f"""WITH d AS (SELECT {REGION} AS regiao, acq_date AS dia, sum(frp) AS soma, count(frp) AS n, count(*) AS observacoes
   FROM fx_arch GROUP BY ALL)
SELECT regiao, dia, observacoes, {mean_over(7)}, {mean_over(30)} FROM d""")
def rolling_means(t):
    placed = t.archive.withColumn("regiao", region(F.col("latitude")))
    return features.rolling_means(placed, "regiao", "acq_date", "frp", k.ROLLING_DAYS)


SCALE = 6371.0 * math.cos(math.radians(39.5)) / 5
HEIGHT = 6371.0 / math.cos(math.radians(39.5)) / 5


@query("ft_03", f"""WITH c AS (SELECT CAST(floor(radians(longitude) * {SCALE!r}) AS INT) AS x,
   CAST(floor(sin(radians(latitude)) * {HEIGHT!r}) AS INT) AS y, count(*) AS hotspots, sum(frp) AS soma, count(frp) AS n,
   max(frp) AS maior FROM fx_arch GROUP BY ALL)
SELECT a.x AS celula_x, a.y AS celula_y, round(degrees(asin((a.y + 0.5) / {HEIGHT!r})), 6) AS latitude,
 round(degrees((a.x + 0.5) / {SCALE!r}), 6) AS longitude, any_value(a.hotspots) AS hotspots,
 round(any_value(a.soma / a.n), 6) AS frp_medio, any_value(a.maior) AS frp_max, sum(b.hotspots)::BIGINT AS hotspots_vizinhanca,
 round(sum(b.soma) / sum(b.n), 6) AS frp_vizinhanca, max(b.maior) AS frp_max_vizinhanca
FROM c a JOIN c b ON b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 GROUP BY a.x, a.y""")
def cells(t):
    return features.per_cell(t.archive)


@query("ft_04")
def predictions(t):
    """Fitted on the first days of the sensor events, stored, loaded again and applied to the last ones."""
    days = risk_model.zone_days(t.sensor, t.hotspot)
    train, test = risk_model.split_by_time(days)
    path = new_folder(t.spark, "risk-model")
    risk_model.fit(train).save(path)
    return risk_model.predictions(risk_model.load(t.spark, path), test)
