"""Geographic expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import number

EARTH_M = 6371008.8


def coordinate_pair(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Both as doubles in range, or both null."""
    x, y = number(lon), number(lat)
    ok = x.between(-180, 180) & y.between(-90, 90)
    return F.when(ok, x), F.when(ok, y)


def haversine_m(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column, radius: float = EARTH_M) -> Column:
    dx, dy = F.radians(lon_b - lon_a) / 2, F.radians(lat_b - lat_a) / 2
    h = F.pow(F.sin(dy), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(F.sin(dx), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def cell(lon: Column, lat: Column, side_m: float) -> list[Column]:
    """The cube of that side that holds the point on the sphere."""
    x, y = F.radians(lon), F.radians(lat)
    return [F.floor(v * EARTH_M / side_m).cast("bigint") for v in (F.cos(y) * F.cos(x), F.cos(y) * F.sin(x), F.sin(y))]


def projected_m(lon: Column, lat: Column, mean_lat: Column) -> tuple[Column, Column]:
    """Equirectangular x and y around a mean latitude."""
    return F.radians(lon) * F.cos(F.radians(mean_lat)) * EARTH_M, F.radians(lat) * EARTH_M
