"""Declared schemas of the event streams and of the historical files, as DDL text."""

from __future__ import annotations

SENSOR = (
    "grid_id string, regiao string, latitude double, longitude double, timestamp string, "
    "temp_celsius double, humidity_pct double, wind_kmh double, hotspot_count int, "
    "risk_score double, source string"
)
# Producers disagree on the name of the radiative power field, so both are declared.
DETECTION = (
    "grid_id string, latitude double, longitude double, timestamp string, brightness double, "
    "frp double, frp_mw double, confidence string, daynight string, source string"
)
WEATHER = (
    "grid_id string, latitude double, longitude double, timestamp string, temp_max double, "
    "temp_min double, humidity_avg double, wind_max_kmh double, precipitation_mm double, "
    "source string"
)

# The validating path reads candidates as text: only then do "absent", "wrong type" and
# "out of range" stay three different findings.
SENSOR_TEXT = (
    "grid_id string, timestamp string, source string, temp_celsius string, humidity_pct string, "
    "wind_kmh string, risk_score string, hotspot_count string, latitude string, longitude string"
)
DETECTION_TEXT = (
    "grid_id string, timestamp string, source string, latitude string, longitude string, "
    "frp_mw string, frp string, brightness string, confidence string"
)

DETECTION_CSV = {
    "latitude": "double", "longitude": "double", "bright_ti4": "double", "scan": "double",
    "track": "double", "acq_date": "date", "acq_time": "int", "satellite": "string",
    "instrument": "string", "confidence": "string", "version": "string", "bright_ti5": "double",
    "frp": "double", "daynight": "string", "type": "int",
}

STATION_PAYLOAD = (
    "features array<struct<geometry: struct<coordinates: array<double>>, properties: struct<"
    "idEstacao: bigint, temperatura: double, humidade: double, intensidadeVento: double, "
    "direcaoVento: double, precAcum: double, pressao: double>>>"
)
VEGETATION_PAYLOAD = (
    "features array<struct<attributes: struct<DESCRICAO: string, AREA_HA: double>>>"
)

ENVELOPE = "key string, value string, topic string"
