"""Distances on the sphere and assignment to regular grids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres between points given in degrees."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    inner = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), inner)))


def snap_to_grid(value: Column, origin: float, step: float, digits: int) -> Column:
    """Coordinate of the nearest node of the grid ``origin + i * step``."""
    return F.round(F.round((value - F.lit(origin)) / F.lit(step)) * F.lit(step) + F.lit(origin), digits)
