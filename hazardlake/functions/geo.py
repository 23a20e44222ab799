"""Spatial expressions: country box, latitude bands, nearest zone, longitude wrap."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from hazardlake import constants as k
from hazardlake.functions.hazard import stepped


def inside_box(latitude: Column, longitude: Column) -> Column:
    return (latitude.between(k.LATITUDE_RANGE.low, k.LATITUDE_RANGE.high)
            & longitude.between(k.LONGITUDE_RANGE.low, k.LONGITUDE_RANGE.high))


def outside_box(latitude: Column, longitude: Column) -> Column:
    """Strict complement; a missing coordinate is neither inside nor outside."""
    return ((latitude < k.LATITUDE_RANGE.low) | (latitude > k.LATITUDE_RANGE.high)
            | (longitude < k.LONGITUDE_RANGE.low) | (longitude > k.LONGITUDE_RANGE.high))


def region(latitude: Column) -> Column:
    return stepped(latitude, k.LATITUDE_BANDS, k.SOUTHERNMOST_BAND)


def nearest_zone(latitude: Column, longitude: Column, zones=k.ZONES) -> Column:
    """Zone with the least squared distance in degrees, the first listed one on a tie.

    The zone table is part of the expression: no join, no shuffle, and the smallest
    (distance, position) pair settles ties the same way on every executor.
    """
    candidates = [
        F.struct(
            ((latitude - z.latitude) * (latitude - z.latitude)
             + (longitude - z.longitude) * (longitude - z.longitude)).alias("distance"),
            F.lit(position).alias("position"),
            F.lit(z.grid_id).alias("grid_id"),
        )
        for position, z in enumerate(zones)
    ]
    nearest = F.array_min(F.array(*candidates))["grid_id"]
    return F.when(latitude.isNotNull() & longitude.isNotNull(), nearest)


def wrap_longitude(longitude: Column) -> Column:
    """0..360 degrees to -180..180."""
    return F.pmod(longitude + 180, F.lit(360.0)) - 180


# --- equal-area cells ----------------------------------------------------------------------------

def cell_area(latitude: Column, longitude: Column) -> Column:
    """The cell of a location in a cylindrical equal-area grid: struct of column ``x`` and row ``y``.

    Every cell covers the same area; on the standard parallel, cells are squares of ``CELL_KM``.
    """
    scale = k.EARTH_RADIUS_KM * math.cos(math.radians(k.STANDARD_PARALLEL))
    height = k.EARTH_RADIUS_KM / math.cos(math.radians(k.STANDARD_PARALLEL))
    return F.struct(F.floor(F.radians(longitude) * scale / k.CELL_KM).cast("int").alias("x"),
                    F.floor(F.sin(F.radians(latitude)) * height / k.CELL_KM).cast("int").alias("y"))


def cell_centre(cell: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a cell's centre."""
    scale = k.EARTH_RADIUS_KM * math.cos(math.radians(k.STANDARD_PARALLEL))
    height = k.EARTH_RADIUS_KM / math.cos(math.radians(k.STANDARD_PARALLEL))
    return (F.degrees(F.asin((cell["y"] + 0.5) * k.CELL_KM / height)),
            F.degrees((cell["x"] + 0.5) * k.CELL_KM / scale))


def neighbours(cell: Column) -> Column:
    """A cell and the eight around it."""
    return F.array(*[F.struct((cell["x"] + dx).alias("x"), (cell["y"] + dy).alias("y"))
                     for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
