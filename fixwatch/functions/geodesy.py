"""Coordinate expressions on the WGS-84 ellipsoid, Column in and Column out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS-84 semi-major axis (m) and flattening.
WGS84_A = 6_378_137.0
WGS84_F = 1.0 / 298.257_223_563
WGS84_B = WGS84_A * (1.0 - WGS84_F)
WGS84_E2 = WGS84_F * (2.0 - WGS84_F)
WGS84_EP2 = WGS84_E2 / (1.0 - WGS84_E2)


class Cartesian(NamedTuple):
    x: Column
    y: Column
    z: Column


class Geodetic(NamedTuple):
    lat: Column
    lon: Column
    height: Column


class Local(NamedTuple):
    east: Column
    north: Column
    up: Column


def dm_to_degrees(dm: Column, hemisphere: Column | None = None) -> Column:
    """`dddmm.mmmm` to decimal degrees; a S or W hemisphere negates."""
    whole = F.when(dm >= 0, F.floor(dm / 100)).otherwise(F.ceil(dm / 100)).cast("double")
    degrees = whole + (dm - whole * 100) / 60.0
    if hemisphere is None:
        return degrees
    return degrees * F.when(hemisphere.isin("S", "W"), -1.0).otherwise(1.0)


def geodetic_to_ecef(lat_deg: Column, lon_deg: Column, height_m: Column) -> Cartesian:
    lat, lon = F.radians(lat_deg), F.radians(lon_deg)
    prime_vertical = F.lit(WGS84_A) / F.sqrt(1.0 - WGS84_E2 * F.sin(lat) * F.sin(lat))
    return Cartesian(
        (prime_vertical + height_m) * F.cos(lat) * F.cos(lon),
        (prime_vertical + height_m) * F.cos(lat) * F.sin(lon),
        (prime_vertical * (1.0 - WGS84_E2) + height_m) * F.sin(lat),
    )


def ecef_to_geodetic(x: Column, y: Column, z: Column, *, degrees: bool = True) -> Geodetic:
    """Closed form with one Bowring step."""
    p = F.sqrt(x * x + y * y)
    theta = F.atan2(z * WGS84_A, p * WGS84_B)
    lat = F.atan2(
        z + WGS84_EP2 * WGS84_B * F.pow(F.sin(theta), 3),
        p - WGS84_E2 * WGS84_A * F.pow(F.cos(theta), 3),
    )
    lon = F.atan2(y, x)
    height = p / F.cos(lat) - WGS84_A / F.sqrt(1.0 - WGS84_E2 * F.sin(lat) * F.sin(lat))
    if degrees:
        return Geodetic(F.degrees(lat), F.degrees(lon), height)
    return Geodetic(lat, lon, height)


def ecef_to_enu(rover: Cartesian, base: Cartesian, base_lat_rad: Column, base_lon_rad: Column) -> Local:
    """Rotate rover - base into the base's local frame. The base angles are inputs so
    that they are computed once per base row, before any join to the rovers."""
    dx, dy, dz = rover.x - base.x, rover.y - base.y, rover.z - base.z
    sin_lat, cos_lat = F.sin(base_lat_rad), F.cos(base_lat_rad)
    sin_lon, cos_lon = F.sin(base_lon_rad), F.cos(base_lon_rad)
    return Local(
        dy * cos_lon - dx * sin_lon,
        dz * cos_lat - (dx * cos_lon + dy * sin_lon) * sin_lat,
        dz * sin_lat + (dx * cos_lon + dy * sin_lon) * cos_lat,
    )


def horizontal_error(east: Column, north: Column) -> Column:
    return F.hypot(east, north)


def vertical_error(up: Column) -> Column:
    return F.abs(up)


def distance_3d(a: Cartesian, b: Cartesian) -> Column:
    dx, dy, dz = a.x - b.x, a.y - b.y, a.z - b.z
    return F.sqrt(dx * dx + dy * dy + dz * dz)
