"""Distances, cell indices and areas as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from dustline import params as P

#: Kilometres per degree of latitude on the sphere the great-circle distance uses.
KM_PER_DEG_SPHERE = P.EARTH_DIAMETER_KM * math.pi / 360.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(P.EARTH_DIAMETER_KM) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def flat_offsets_km(lat_to: Column, lon_to: Column, lat_from: Column, lon_from: Column,
                    km_per_deg: float = P.KM_PER_DEG) -> tuple[Column, Column]:
    """Eastward and northward offset from one point to another, scaled at the receiving latitude."""
    dx = (lon_to - lon_from) * km_per_deg * F.cos(F.radians(lat_to))
    dy = (lat_to - lat_from) * km_per_deg
    return dx, dy


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    la, lo = F.radians(lat), F.radians(lon)
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)


def chord_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = unit_vector(lat1, lon1), unit_vector(lat2, lon2)
    d = [(p - q) * (p - q) for p, q in zip(a, b)]
    return F.lit(P.EARTH_RADIUS_KM) * F.sqrt(d[0] + d[1] + d[2])


def in_box(lat: Column, lon: Column, box: dict) -> Column:
    return lat.between(box["lat_min"], box["lat_max"]) & lon.between(box["lon_min"], box["lon_max"])


def cell_row(lat: Column, lat_max: float = P.GRID_LAT_MAX, res: float = P.GRID_RES) -> Column:
    return F.floor((F.lit(lat_max) - lat) / res)


def cell_col(lon: Column, lon_min: float = P.GRID_LON_MIN, res: float = P.GRID_RES) -> Column:
    return F.floor((lon - lon_min) / res)


def cell_index(lat: Column, lon: Column, rows: int = P.GRID_ROWS, cols: int = P.GRID_COLS) -> Column:
    """Row-major cell number, -1 outside the grid."""
    r, c = cell_row(lat), cell_col(lon)
    inside = (r >= 0) & (c >= 0) & (r < rows) & (c < cols)
    return F.when(inside, r * cols + c).otherwise(F.lit(-1).cast("long"))


def row_lat(row: Column) -> Column:
    return F.round(F.lit(P.GRID_LAT_MAX) - (row + 0.5) * P.GRID_RES, 5)


def col_lon(col: Column) -> Column:
    return F.round(F.lit(P.GRID_LON_MIN) + (col + 0.5) * P.GRID_RES, 5)


def cell_area_km2(lat: Column, res: float = P.GRID_RES) -> Column:
    return F.lit((res * P.KM_PER_DEG) ** 2) * F.cos(F.radians(lat))


def degree_reach(lat: Column, radius_km: float) -> tuple[Column, Column]:
    """Half height and half width, in degrees, of the box around a great-circle disk."""
    r = radius_km / P.EARTH_RADIUS_KM
    d_lat = F.lit(math.degrees(r) * (1 + 1e-9))
    ratio = F.lit(math.sin(r)) / F.cos(F.radians(lat))
    d_lon = F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * (1 + 1e-9)
    return d_lat, d_lon
