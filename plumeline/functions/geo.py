"""Great-circle distance and grid-cell expressions on (latitude, longitude) pairs in degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumeline.model import DEG2RAD, EARTH_RADIUS_M


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres on a sphere of radius ``EARTH_RADIUS_M``."""
    rad = F.lit(DEG2RAD)
    half_dlat = (_c(lat2) - _c(lat1)) * rad / F.lit(2.0)
    half_dlon = (_c(lon2) - _c(lon1)) * rad / F.lit(2.0)
    a = (F.sin(half_dlat) * F.sin(half_dlat)
         + F.cos(_c(lat1) * rad) * F.cos(_c(lat2) * rad) * F.sin(half_dlon) * F.sin(half_dlon))
    return F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def lat_reach_deg(radius_m: float) -> float:
    """Largest latitude difference (degrees) between two points at most ``radius_m`` apart."""
    return math.degrees(radius_m / EARTH_RADIUS_M)


def lon_reach_deg(lat_deg, radius_m: float) -> Column:
    """Largest longitude difference (degrees) of a point within ``radius_m`` of a centre at
    ``lat_deg``: asin(sin(d) / cos(lat)); 180 when the cap reaches a pole."""
    ratio = F.lit(math.sin(radius_m / EARTH_RADIUS_M)) / F.cos(_c(lat_deg) * F.lit(DEG2RAD))
    return F.when(ratio >= F.lit(1.0), F.lit(180.0)).otherwise(F.degrees(F.asin(ratio)))


def lon_reach_deg_scalar(lat_deg: float, radius_m: float) -> float:
    ratio = math.sin(radius_m / EARTH_RADIUS_M) / math.cos(math.radians(lat_deg))
    return 180.0 if ratio >= 1.0 else math.degrees(math.asin(ratio))


def cell_index(c, cell_deg: float) -> Column:
    """Integer grid cell of a coordinate: floor(x * (1 / cell))."""
    return F.floor(_c(c) * F.lit(1.0 / cell_deg)).cast("long")
