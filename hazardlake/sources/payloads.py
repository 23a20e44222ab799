"""Normalisers of the station-weather and vegetation JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazardlake import constants as k, schemas
from hazardlake.functions.hazard import risk_score
from hazardlake.functions.values import vegetation_risk


def zone_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(z.grid_id, z.latitude, z.longitude, z.region) for z in k.ZONES],
        "grid_id string, zone_latitude double, zone_longitude double, regiao string")


def station_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(z.station_id, z.grid_id, z.region) for z in k.ZONES],
        "estacao_id bigint, grid_id string, regiao string")


def with_zone_facts(df: DataFrame) -> DataFrame:
    """Coordinates and region name of each row's zone; the dimension is a fixed short list."""
    return df.join(F.broadcast(zone_dimension(df.sparkSession)), "grid_id", "left")


def with_station_zone(df: DataFrame) -> DataFrame:
    """Keep rows of known stations and add their zone and region."""
    return df.join(F.broadcast(station_dimension(df.sparkSession)), "estacao_id")


def station_observations(payloads: DataFrame, received_at: Column | None = None) -> DataFrame:
    """GeoJSON station payloads (column ``value``) as weather events.

    Stations without temperature or humidity are dropped, other missing measures read 0.
    """
    when = F.current_timestamp() if received_at is None else received_at
    features = payloads.select(
        F.explode(F.from_json("value", schemas.STATION_PAYLOAD)["features"]).alias("f"))
    measured = features.select(
        F.col("f.properties.idEstacao").alias("estacao_id"),
        # coordinates come as [longitude, latitude]
        F.coalesce(F.get("f.geometry.coordinates", F.lit(1)), F.lit(0.0)).alias("latitude"),
        F.coalesce(F.get("f.geometry.coordinates", F.lit(0)), F.lit(0.0)).alias("longitude"),
        F.col("f.properties.temperatura").alias("temp_celsius"),
        F.col("f.properties.humidade").alias("humidity_pct"),
        F.col("f.properties.intensidadeVento").alias("wind_kmh"),
        F.col("f.properties.direcaoVento").alias("wind_direction"),
        F.col("f.properties.precAcum").alias("precipitation_mm"),
        F.col("f.properties.pressao").alias("pressure_hpa"),
    )
    return (
        with_station_zone(measured)
        .dropna(subset=["temp_celsius", "humidity_pct"])
        .fillna(0.0, subset=["wind_kmh", "wind_direction", "precipitation_mm", "pressure_hpa"])
        .withColumn("timestamp", when).withColumn("source", F.lit(k.STATION_SOURCE))
    )


def as_weather_events(observations: DataFrame) -> DataFrame:
    """Observations under the field names of the weather stream."""
    return observations.select(
        "grid_id", "latitude", "longitude", "timestamp",
        F.col("temp_celsius").alias("temp_max"), F.col("temp_celsius").alias("temp_min"),
        F.col("humidity_pct").alias("humidity_avg"), F.col("wind_kmh").alias("wind_max_kmh"),
        "precipitation_mm", "source")


def as_sensor_events(observations: DataFrame, scored: bool = False) -> DataFrame:
    """Observations as sensor events. Stations send no score, so validation rejects them
    unless ``scored`` computes one for zero hotspots."""
    score = risk_score(F.col("temp_celsius"), F.col("humidity_pct"), F.col("wind_kmh"), F.lit(0))
    return observations.select(
        "grid_id", "regiao", "latitude", "longitude", "timestamp", "temp_celsius", "humidity_pct",
        "wind_kmh", F.lit(0).alias("hotspot_count"),
        (score if scored else F.lit(None).cast("double")).alias("risk_score"), "source")


def vegetation(payloads: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Vegetation payloads (column ``value``) as classified land-cover rows."""
    when = F.current_timestamp() if received_at is None else received_at
    attributes = payloads.select(
        F.explode(F.from_json("value", schemas.VEGETATION_PAYLOAD)["features"]).alias("f"))
    described = attributes.select(
        F.coalesce("f.attributes.DESCRICAO", F.lit(k.VEGETATION_UNNAMED)).alias("tipo_vegetacao"),
        F.coalesce("f.attributes.AREA_HA", F.lit(0.0)).alias("area_ha"))
    return described.select(
        when.alias("timestamp"), "tipo_vegetacao", "area_ha",
        vegetation_risk(F.col("tipo_vegetacao")).alias("risco_vegetacao"),
        F.lit(k.VEGETATION_SOURCE).alias("source"))
