"""Great-circle distance and speed as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points in degrees; 0.0 if any is NULL.

    The haversine term is clamped to 1 because rounding can push it just above
    for antipodal points, which would make the square root of ``1 - h`` NaN.
    """
    half_chord_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_chord_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = F.least(
        half_chord_lat * half_chord_lat
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord_lon * half_chord_lon,
        F.lit(1.0),
    )
    complete = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    angle = 2 * F.atan2(F.sqrt(h), F.sqrt(1 - h))
    return F.when(complete, EARTH_RADIUS_KM * angle).otherwise(F.lit(0.0))


def speed_kmh(distance_km: Column, seconds: Column) -> Column:
    """Average speed for covering the distance in the time; NULL for 0 s."""
    return F.try_divide(distance_km * 3600.0, F.abs(seconds).cast("double"))
