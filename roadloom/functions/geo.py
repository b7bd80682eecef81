"""Distances and speeds of point sequences."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from roadloom.params import EARTH_RADIUS_KM, WGS84_FLATTENING


def geocentric(lat: Column) -> Column:
    """Geocentric latitude (radians) of a geodetic one (degrees)."""
    squared = (1 - WGS84_FLATTENING) ** 2
    return F.atan(F.tan(F.radians(lat)) * squared)


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Angle between two geocentric directions, times the earth's radius; exact for near and far points alike."""
    a, b, d = geocentric(lat1), geocentric(lat2), F.radians(lon2 - lon1)
    across = F.sqrt(F.pow(F.cos(b) * F.sin(d), 2) + F.pow(F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d), 2))
    along = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(d)
    return F.atan2(across, along) * EARTH_RADIUS_KM


def with_steps(points, key: str, t: str, lat: str, lon: str, ties: list[str] | None = None):
    """Adds dt_s and dist_km to the point before on the same key."""
    w = Window.partitionBy(key).orderBy(t, *(ties or []))
    return points.withColumns(
        {
            "rn": F.row_number().over(w),
            "dt_s": (F.col(t) - F.lag(t).over(w)).cast("double"),
            "dist_km": distance_km(F.lag(lat).over(w), F.lag(lon).over(w), F.col(lat), F.col(lon)),
        }
    )


def step_kph(dist_km: Column, dt_s: Column) -> Column:
    """km/h; null where time doesn't advance."""
    return F.when(dt_s > 0, dist_km / (dt_s / 3600.0))
