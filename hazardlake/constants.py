"""Values that results depend on, stated plainly.

Everything here is data: lookup rows, limits, labels and word lists. No other module
repeats a literal from this file.
"""

from __future__ import annotations

from typing import NamedTuple


class Zone(NamedTuple):
    grid_id: str
    latitude: float
    longitude: float
    region: str
    station_id: int


class Range(NamedTuple):
    """A closed numeric range a column must lie in."""

    column: str
    low: float
    high: float


# --- fixed values: zones in tie-break order, with their weather station -------------
ZONES = (
    Zone("PT-NORTE-01", 41.55, -8.42, "Braga", 1200535),
    Zone("PT-NORTE-02", 41.69, -7.91, "Braganca", 1200562),
    Zone("PT-CENTRO-01", 40.20, -8.41, "Coimbra", 1210713),
    Zone("PT-CENTRO-02", 39.82, -7.49, "Castelo Branco", 1200524),
    Zone("PT-CENTRO-03", 40.64, -8.65, "Aveiro", 1200514),
    Zone("PT-LVT-01", 39.35, -8.13, "Santarem", 1200609),
    Zone("PT-LVT-02", 38.71, -9.14, "Lisboa", 1200519),
    Zone("PT-ALENTEJO-01", 38.57, -7.91, "Evora", 1200546),
    Zone("PT-ALENTEJO-02", 37.80, -7.49, "Beja", 1200502),
    Zone("PT-ALGARVE-01", 37.10, -8.67, "Faro", 1200588),
)

# --- fixed values: country box and latitude bands (lower edge, region) --------------
LATITUDE_RANGE = Range("latitude", 36.9, 42.2)
LONGITUDE_RANGE = Range("longitude", -9.5, -6.2)
LATITUDE_BANDS = ((41.0, "Norte"), (39.5, "Centro"), (38.5, "Lisboa e VT"), (37.5, "Alentejo"))
SOUTHERNMOST_BAND = "Algarve"

# --- fixed values: row rules and mandatory fields ------------------------------------
SENSOR_RANGES = (
    Range("temp_celsius", -10, 60),
    Range("humidity_pct", 0, 100),
    Range("wind_kmh", 0, 150),
    Range("risk_score", 0, 100),
)
SENSOR_REQUIRED = ("grid_id", "risk_score")
DETECTION_RANGES = (
    Range("frp_mw", 0.0, 5000.0),
    Range("brightness", 200.0, 500.0),
    LATITUDE_RANGE,
    LONGITUDE_RANGE,
)
DETECTION_REQUIRED = ("grid_id", "latitude", "longitude", "frp_mw")
UNKNOWN_ZONES = ("PT-UNKNOWN", "")
DETECTION_SUITE = (DETECTION_RANGES, DETECTION_REQUIRED)

# --- fixed values: expectation suites (live, ad hoc) ---------------------------------
LIVE_SUITE = (SENSOR_RANGES[:3], ("grid_id", "risk_score"))
AD_HOC_SUITE = (
    (
        Range("temp_celsius", -10, 60),
        Range("humidity_pct", 0, 100),
        Range("wind_kmh", 0, 200),
        Range("risk_score", 0, 100),
    ),
    ("grid_id", "temp_celsius", "humidity_pct", "wind_kmh"),
)

# --- fixed values: risk levels (lower edge, level), hazard weights, alert limits -----
RISK_LEVELS = ((80, "CRITICAL"), (60, "HIGH"), (30, "MEDIUM"))
LOWEST_LEVEL = "LOW"
ALERT_LEVELS = ("HIGH", "CRITICAL")
SENSOR_WEIGHT, DETECTION_WEIGHT, WEATHER_WEIGHT = 0.60, 0.25, 0.15
FRP_SCALE, WIND_SCALE = 200.0, 150.0
HOT_ABOVE, DRY_BELOW, WINDY_ABOVE = 35, 20, 30

# --- fixed values: vegetation words, first matching level wins -----------------------
VEGETATION_WORDS = (
    ("HIGH", ("eucalipto", "pinheiro", "mato", "arbustivo")),
    ("MEDIUM", ("carvalho", "sobreiro", "floresta")),
    ("LOW", ("urbano", "agua", "agricola", "pastagem")),
)
VEGETATION_DEFAULT = "MEDIUM"
VEGETATION_UNNAMED = "Desconhecido"

# --- fixed values: labels --------------------------------------------------------------
MONTH_LABELS = ("Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez")
FIRE_SEASON_MONTHS = (5, 6, 7, 8, 9, 10)
SUMMER, REST_OF_YEAR = "Verão (Jun–Set)", "Resto do ano"
DAY_PERIODS = {"D": "Diurno", "N": "Noturno"}
SATELLITE_FILE_MARKS = (
    ("VIIRS S-NPP", ("snpp", "s-npp")),
    ("VIIRS NOAA-20", ("noaa", "jpss1", "jpss2")),
)
SATELLITE_DEFAULT = "VIIRS"

# --- fixed values: event sources and topics ---------------------------------------------
SIMULATED_SOURCE, STATION_SOURCE = "iot_simulator_v1", "ipma_real"
DETECTION_SOURCE, STORED_DETECTION_SOURCE = "nasa_firms_real", "nasa_firms"
VEGETATION_SOURCE, VEGETATION_KEY = "icnf_cos2018", "ICNF"
SENSOR_TOPIC, DETECTION_TOPIC, WEATHER_TOPIC = "sensor-events", "satellite-hotspots", "weather-data"

# --- fixed values: window, slide, watermark, trigger, retention --------------------------
WINDOW, SLIDE, WATERMARK, TRIGGER = "10 minutes", "5 minutes", "2 minutes", "30 seconds"
RETENTION_HOURS = 72

# --- fixed values: dashboard bands (metric, ((lower edge, colour), ...)) -----------------
METRIC_BANDS = {
    "success_percent": (("red", None), ("orange", 80), ("green", 95)),
    "latency_ms": (("green", None), ("orange", 500), ("red", 2000)),
    "failed_expectations": (("green", None), ("orange", 1), ("red", 5)),
}

# --- fixed values: stored column lists -----------------------------------------------------
DETECTION_COLUMNS = (
    "latitude", "longitude", "bright_ti4", "bright_ti5", "frp", "acq_date", "acq_time",
    "confidence", "daynight", "satellite", "satelite", "ano", "mes", "dia",
)
GRID_COLUMNS = (
    "time", "latitude", "longitude", "ano", "mes", "dia", "hora", "temp_c", "dewpoint_c", "rh",
    "wind_speed_kmh", "precip_mm_dia", "evap_mm_dia", "cvh", "tvl", "risco_alto",
)
EXPECTED_COLUMNS = {
    "hotspots": ("latitude", "longitude", "frp", "acq_date", "confidence"),
    "meteorologia": ("temp_c", "rh", "wind_speed_kmh"),
    "agregados_streaming": ("n_hotspots", "frp_medio", "risco_composto"),
}
LAKE_PREFIXES = ("hotspots", "meteorologia", "agregados_streaming")
MIN_DETECTION_YEARS = 3

# --- fixed values: composite columns by origin ----------------------------------------------
COMPOSITE_CATALOGUE = {
    "sensor-events": (
        "n_leituras_sensor", "risk_medio_sensor", "risk_maximo_sensor",
        "temp_media", "humidade_media", "vento_medio",
    ),
    "satellite-hotspots": ("n_hotspots", "frp_medio", "frp_maximo"),
    "weather-data": ("temp_max_media", "humidade_ipma", "vento_max_ipma", "precipitacao_media"),
    "join": ("janela_inicio", "janela_fim", "grid_id", "risco_composto"),
}

# --- catalogue of the lake: dataset, origin, column, description -------------------------------
CATALOGUE = {
    "hotspots": {
        "satellite file": {
            "latitude": "degrees north",
            "longitude": "degrees east",
            "bright_ti4": "brightness temperature of channel I4, kelvin",
            "bright_ti5": "brightness temperature of channel I5, kelvin",
            "frp": "fire radiative power, megawatt",
            "acq_date": "date of detection",
            "acq_time": "time of detection",
            "confidence": "h high, n nominal, l low",
            "daynight": "D day, N night",
            "satellite": "satellite code",
        },
        "load": {
            "satelite": "satellite name, from the file name",
            "ano": "year of detection, partition",
            "mes": "month of detection, partition",
            "dia": "day of the month",
            "grid_id": "nearest zone, partition",
        },
    },
    "agregados_streaming": {
        "sensor-events": {
            "n_leituras_sensor": "sensor readings in the window",
            "risk_medio_sensor": "mean risk score",
            "risk_maximo_sensor": "highest risk score",
            "temp_media": "mean temperature, Celsius",
            "humidade_media": "mean relative humidity, percent",
            "vento_medio": "mean wind speed, km/h",
        },
        "satellite-hotspots": {
            "n_hotspots": "detections in the window",
            "frp_medio": "mean fire radiative power, megawatt",
            "frp_maximo": "highest fire radiative power, megawatt",
        },
        "weather-data": {
            "temp_max_media": "mean of the highest temperatures, Celsius",
            "humidade_ipma": "mean humidity of stations, percent",
            "vento_max_ipma": "mean of the strongest winds, km/h",
            "precipitacao_media": "mean precipitation, mm",
        },
        "join": {
            "janela_inicio": "start of the window",
            "janela_fim": "end of the window",
            "grid_id": "zone",
            "risco_composto": "composite hazard index",
        },
    },
}

# --- features of cells and zones -----------------------------------------------------------------

GRID_STEP = 0.25  # degrees between reanalysis points
WEATHER_TOLERANCE_HOURS = 3
EARTH_RADIUS_KM = 6371.0
STANDARD_PARALLEL = 39.5  # of the equal-area cells, in the middle of the country
CELL_KM = 5.0
ROLLING_DAYS = (7, 30)
HORIZON_HOURS = (24, 48, 72)
