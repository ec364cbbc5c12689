"""Distances on a sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.01


def haversine_km(
    lat1: Column, lng1: Column, lat2: Column, lng2: Column, radius_km: float = EARTH_RADIUS_KM
) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2.0)
    half_dlng = F.sin(F.radians(lng2 - lng1) / 2.0)
    h = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlng * half_dlng
    # Rounding can push h past 1 for opposite points, where asin has no value.
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))
