"""Hazard-shaped views over the given tables, for Spark and as SQL common tables.

Each base view is one select list over one table that both engines accept. What the
package itself computes (scores, derived weather) is added on the Spark side by package
code and on the SQL side by separate SQL, so that the two can be compared.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from hazardlake.functions import calendar, hazard
from hazardlake.operators.detections import in_country
from hazardlake.sources import climate_grid


class View(NamedTuple):
    table: str
    columns: tuple[str, ...]
    where: str = "TRUE"

    def sql(self) -> str:
        return f"SELECT {', '.join(self.columns)} FROM {self.table} WHERE {self.where}"


ZONE = "concat('Z', CAST(user_id % 10 AS STRING)) AS grid_id"

VIEWS = {
    "fx_sensor_base": View("events", (
        "event_id", ZONE, "ts AS event_time",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE value - 10 END AS temp_celsius",
        "CAST((event_id * 7) % 104 AS DOUBLE) AS humidity_pct",
        "CAST((event_id * 11) % 155 AS DOUBLE) AS wind_kmh",
        "CAST(event_id % 6 AS INT) AS hotspot_count",
        "CASE WHEN event_id % 10 < 7 THEN 'iot_simulator_v1' ELSE 'ipma_real' END AS source",
    ), "event_type IN ('view','click','signup')"),
    "fx_hotspot": View("events", (
        "event_id", "ts AS event_time",
        "36.5 + CAST((event_id * 13) % 600 AS DOUBLE) / 100 AS latitude",
        "-9.8 + CAST((event_id * 17) % 380 AS DOUBLE) / 100 AS longitude",
        "CASE WHEN event_id % 53 = 0 THEN NULL ELSE 180 + CAST((event_id * 19) % 340 AS DOUBLE) END"
        " AS bright_ti4",
        "CAST(250 + (event_id * 23) % 60 AS DOUBLE) AS bright_ti5",
        "value * 40 AS frp",
        "CASE event_id % 3 WHEN 0 THEN 'l' WHEN 1 THEN 'n' ELSE 'h' END AS confidence",
        "CASE WHEN event_id % 4 = 0 THEN 'N' ELSE 'D' END AS daynight",
        "CASE WHEN user_id % 2 = 0 THEN 'VIIRS S-NPP' ELSE 'VIIRS NOAA-20' END AS satelite", ZONE,
    ), "event_type = 'error'"),
    "fx_weather": View("events", (
        "event_id", ZONE, "ts AS event_time", "15 + value / 10 AS temp_max",
        "CAST((event_id * 5) % 101 AS DOUBLE) AS humidity_avg",
        "CAST((event_id * 3) % 90 AS DOUBLE) AS wind_max_kmh",
        "CAST(event_id % 9 AS DOUBLE) AS precipitation_mm",
    ), "event_type = 'purchase'"),
    "fx_grid": View("lineitem", (
        "l_orderkey", "l_linenumber", "l_shipdate AS day0", "CAST(l_orderkey % 24 AS INT) AS hora",
        "36.9 + CAST(l_suppkey % 22 AS DOUBLE) / 4 AS latitude",
        "-9.5 + CAST(l_partkey % 14 AS DOUBLE) / 4 AS longitude",
        "260 + l_quantity AS t2m", "260 + l_quantity - CAST(l_partkey % 40 AS DOUBLE) AS d2m",
        "CAST((l_linenumber - 4) * 3 AS DOUBLE) AS u10", "l_discount * 100 AS v10",
        "(l_tax - 0.01) / 10000 AS mtpr", "0 - l_discount / 100000 AS mer",
    )),
    "fx_latency": View("events", (
        "ts AS _time", ZONE,
        "CASE WHEN event_type = 'error' THEN 'satellite-hotspots' ELSE 'sensor-events' END AS topic",
        "CAST((event_id * 37) % 2500 AS DOUBLE) AS latency_ms",
    ), "event_type <> 'purchase'"),
    # detections over several years and many rows
    "fx_archive": View("lineitem", (
        "l_orderkey", "l_linenumber", "l_shipdate AS acq_time_at",
        "36.5 + CAST(l_suppkey % 60 AS DOUBLE) / 10 AS latitude",
        "-9.8 + CAST(l_partkey % 38 AS DOUBLE) / 10 AS longitude",
        "CAST(floor(l_extendedprice / 50) AS DOUBLE) AS frp",
        "CASE l_returnflag WHEN 'A' THEN 'VIIRS S-NPP' WHEN 'N' THEN 'VIIRS NOAA-20' ELSE 'VIIRS' END"
        " AS satelite",
        "CASE WHEN l_linestatus = 'F' THEN 'D' ELSE 'N' END AS daynight",
    )),
}

BOX = "latitude BETWEEN 36.9 AND 42.2 AND longitude BETWEEN -9.5 AND -6.2"
# rounded half up on the printed number, not on a multiple of it
SCORE = (
    "CASE WHEN temp_celsius IS NOT NULL AND humidity_pct IS NOT NULL AND wind_kmh IS NOT NULL "
    "AND hotspot_count IS NOT NULL THEN round(CAST(CAST(least(100.0, "
    "least(40.0, greatest(0.0, (temp_celsius - 15) * 1.5)) "
    "+ least(30.0, greatest(0.0, (100 - humidity_pct) * 0.4)) "
    "+ least(20.0, greatest(0.0, wind_kmh * 0.5)) + least(10.0, hotspot_count * 3.0)) AS VARCHAR) "
    "AS DECIMAL(30, 18)), 1) END"
)
LEVEL = ("CASE WHEN risk_score >= 80 THEN 'CRITICAL' WHEN risk_score >= 60 THEN 'HIGH' "
         "WHEN risk_score >= 30 THEN 'MEDIUM' ELSE 'LOW' END")
REGION = ("CASE WHEN latitude >= 41.0 THEN 'Norte' WHEN latitude >= 39.5 THEN 'Centro' "
          "WHEN latitude >= 38.5 THEN 'Lisboa e VT' WHEN latitude >= 37.5 THEN 'Alentejo' ELSE 'Algarve' END")

# SQL-only common tables built on the views, in dependency order
DERIVED = {
    "fx_sensor": f"SELECT *, CAST({SCORE} AS DOUBLE) AS risk_score FROM fx_sensor_base",
    "fx_det": "SELECT *, CAST(event_time AS DATE) AS acq_date, CAST(year(event_time) AS INT) AS ano, "
              "CAST(month(event_time) AS INT) AS mes, CAST(day(event_time) AS INT) AS dia FROM fx_hotspot",
    "fx_kept": f"SELECT * FROM fx_det WHERE {BOX}",
    "fx_arch": "SELECT *, CAST(acq_time_at AS DATE) AS acq_date, CAST(year(acq_time_at) AS INT) AS ano, "
               "CAST(month(acq_time_at) AS INT) AS mes, CAST(day(acq_time_at) AS INT) AS dia FROM fx_archive",
    "fx_arch_kept": f"SELECT * FROM fx_arch WHERE {BOX}",
    "fx_hotspot_dup": "SELECT latitude, longitude, bright_ti4, frp, confidence, daynight FROM fx_hotspot "
                      "UNION ALL SELECT latitude, longitude, bright_ti4, frp, confidence, daynight "
                      "FROM fx_hotspot WHERE event_id % 25 = 0",
    "fx_weather_vars": "SELECT *, day0 + hora * INTERVAL 1 HOUR AS time, t2m - 273.15 AS temp_c, "
                       "d2m - 273.15 AS dewpoint_c, sqrt(u10 * u10 + v10 * v10) * 3.6 AS wind_speed_kmh, "
                       "greatest(mtpr, 0) * 86400 AS precip_mm_dia, abs(mer) * 86400 AS evap_mm_dia FROM fx_grid",
    "fx_humid": "SELECT *, least(100.0, greatest(0.0, 100 * exp(17.625 * dewpoint_c / (243.04 + dewpoint_c)) "
                "/ exp(17.625 * temp_c / (243.04 + temp_c)))) AS rh, CAST(year(time) AS INT) AS ano, "
                "CAST(month(time) AS INT) AS mes, CAST(day(time) AS INT) AS dia FROM fx_weather_vars",
    "fx_points": "SELECT *, (temp_c > 35 AND rh < 20 AND wind_speed_kmh > 30) AS risco_alto FROM fx_humid",
    "fx_series": "SELECT time, avg(temp_c) AS temp_c, avg(dewpoint_c) AS dewpoint_c, avg(rh) AS rh, "
                 "avg(wind_speed_kmh) AS wind_speed_kmh, avg(precip_mm_dia) AS precip_mm_dia, "
                 "avg(evap_mm_dia) AS evap_mm_dia, bool_or(risco_alto) AS risco_alto, min(ano) AS ano, "
                 "min(mes) AS mes, min(dia) AS dia, min(hora) AS hora FROM fx_points GROUP BY time",
    # quality metric series: one suite run per hundred events
    "fx_batches": "SELECT event_id // 100 AS batch, count(*) AS total_rows, max(event_time) AS _time, "
                  "CAST((count(*) FILTER (temp_celsius NOT BETWEEN -10 AND 60) = 0) AS INT) "
                  "+ CAST((count(*) FILTER (humidity_pct NOT BETWEEN 0 AND 100) = 0) AS INT) "
                  "+ CAST((count(*) FILTER (wind_kmh NOT BETWEEN 0 AND 150) = 0) AS INT) "
                  "+ CAST((count(*) FILTER (grid_id IS NULL) = 0) AS INT) "
                  "+ CAST((count(*) FILTER (risk_score IS NULL) = 0) AS INT) AS passed "
                  "FROM fx_sensor GROUP BY 1",
    "fx_quality": "SELECT batch, _time, 'sensor_readings' AS source, passed * 100.0 / 5 AS success_percent, "
                  "CAST(passed AS BIGINT) AS successful_expectations, "
                  "CAST(5 - passed AS BIGINT) AS failed_expectations, total_rows FROM fx_batches",
    "fx_months": "SELECT CAST(m AS INT) AS mes FROM generate_series(1, 12) g(m)",
}


def with_fixtures(sql: str) -> str:
    """Prefix a statement with the common tables it uses, directly or through others."""
    bodies = {**{name: view.sql() for name, view in VIEWS.items()}, **DERIVED}
    needed: set[str] = set()

    def collect(text: str) -> None:
        for name in re.findall(r"\bfx_\w+", text):
            if name in bodies and name not in needed:
                needed.add(name)
                collect(bodies[name])

    collect(sql)
    if not needed:
        return sql
    tables = ", ".join(f"{name} AS ({bodies[name]})" for name in bodies if name in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {tables}, {body[5:]}"
    return f"WITH {tables} {body}"


class Tables:
    """The given tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        view = VIEWS[name]
        frame = self.table(view.table).where(view.where).selectExpr(*view.columns)
        instants = {
            f.name: F.col(f.name).cast("timestamp")
            for f in frame.schema if f.dataType.typeName() == "timestamp_ntz"
        }
        return frame.withColumns(instants) if instants else frame

    @property
    def sensor(self) -> DataFrame:
        score = hazard.risk_score(F.col("temp_celsius"), F.col("humidity_pct"), F.col("wind_kmh"),
                                  F.col("hotspot_count"))
        return self.view("fx_sensor_base").withColumn("risk_score", score)

    @property
    def hotspot(self) -> DataFrame:
        return self.view("fx_hotspot")

    @property
    def weather(self) -> DataFrame:
        return self.view("fx_weather")

    @property
    def detection_events(self) -> DataFrame:
        """Detections under the field names of the satellite stream."""
        return self.hotspot.withColumns({"brightness": F.col("bright_ti4"), "frp_mw": F.col("frp")})

    @property
    def detections(self) -> DataFrame:
        dated = self.hotspot.withColumn("acq_date", F.to_date("event_time"))
        return calendar.with_calendar(dated, "acq_date")

    @property
    def kept(self) -> DataFrame:
        return in_country(self.detections)

    @property
    def archive(self) -> DataFrame:
        dated = self.view("fx_archive").withColumn("acq_date", F.to_date("acq_time_at"))
        return calendar.with_calendar(dated, "acq_date")

    @property
    def grid(self) -> DataFrame:
        """Raw reanalysis variables per instant and point."""
        instant = F.expr("day0 + make_interval(0, 0, 0, 0, hora)")
        return self.view("fx_grid").withColumn("time", instant).drop("day0", "hora")

    @property
    def points(self) -> DataFrame:
        return climate_grid.refine(self.grid)

    @property
    def latency(self) -> DataFrame:
        return self.view("fx_latency")

    @property
    def hotspot_dup(self) -> DataFrame:
        columns = ["latitude", "longitude", "bright_ti4", "frp", "confidence", "daynight"]
        rows = self.hotspot
        return rows.select(*columns).unionAll(rows.where("event_id % 25 = 0").select(*columns))
