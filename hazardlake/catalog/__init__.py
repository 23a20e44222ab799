"""Registered queries over the given tables; importing the package registers them all."""

from hazardlake.catalog import (
    detections, features, grid, lake, quality, scalars, streams, tables, timeseries, windows,
)
from hazardlake.catalog.registry import callables, twins
