"""Geometry on the sphere as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt import refdata

MORTON_BITS = 21  # per axis; three axes fill a 63-bit integer


def haversine_km(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius_km: float = refdata.EARTH_RADIUS_KM
) -> Column:
    """Great-circle distance of two points given in degrees."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(F.least(F.lit(1.0), h))) * (2 * radius_km)


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """Point on the unit sphere. Its straight-line distances order as the great-circle ones
    do, and there is no seam at 180 degrees and no crowding at the poles."""
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def squared_chord(a: Column, b: Column) -> Column:
    """Squared straight-line distance of two structs with fields x, y, z."""
    dx, dy, dz = a["x"] - b["x"], a["y"] - b["y"], a["z"] - b["z"]
    return dx * dx + dy * dy + dz * dz


def _spread(v: Column) -> Column:
    """Move the low 21 bits of an integer to every third bit."""
    for shift, mask in (
        (32, 0x1F00000000FFFF),
        (16, 0x1F0000FF0000FF),
        (8, 0x100F00F00F00F00F),
        (4, 0x10C30C30C30C30C3),
        (2, 0x1249249249249249),
    ):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def morton(x: Column, y: Column, z: Column) -> Column:
    """Position on the Z-order curve through the cube [-1, 1]^3."""
    top = (1 << MORTON_BITS) - 1
    axes = [
        _spread(F.least(F.greatest(F.floor((v + 1.0) * (1 << (MORTON_BITS - 1))), F.lit(0)), F.lit(top)).cast("bigint"))
        for v in (x, y, z)
    ]
    return axes[0].bitwiseOR(F.shiftleft(axes[1], 1)).bitwiseOR(F.shiftleft(axes[2], 2))
