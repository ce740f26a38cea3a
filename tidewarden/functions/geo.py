"""Geometry on a sphere, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean radius of the earth in metres (fixed value).
RADIUS = 6371008.8


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return F.lit(2 * RADIUS) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
