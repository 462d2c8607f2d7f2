"""Longitudes, latitudes and angles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lon_to_360(lon: Column) -> Column:
    """Longitude in [0, 360)."""
    return F.pmod(lon + F.lit(360.0), F.lit(360.0))


def lon_to_pm180(lon: Column) -> Column:
    """Longitudes above 180 move down one turn; 180 itself stays."""
    return F.when(lon > 180, lon - 360).otherwise(lon)


def to_radians(degrees: Column) -> Column:
    return F.radians(degrees)


def to_degrees(radians: Column) -> Column:
    return F.degrees(radians)


def sin_of_latitude(lat: Column) -> Column:
    """z on the unit sphere."""
    return F.sin(F.radians(lat))


def latitude_of_sin(z: Column) -> Column:
    return F.degrees(F.asin(z))
