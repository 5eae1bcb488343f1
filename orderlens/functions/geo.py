"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def great_circle_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Haversine distance; the root is clamped to 1 so that antipodes do not give NaN."""
    half_lat = F.sin(F.radians(lat1 - lat2) / 2)
    half_lng = F.sin(F.radians(lng1 - lng2) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    root = F.sqrt(a)
    return 2 * EARTH_RADIUS_KM * F.asin(F.when(root > 1.0, F.lit(1.0)).otherwise(root))
