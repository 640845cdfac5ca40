"""Map projection and grid columns: transverse Mercator by the Krueger series, grid squares."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ellipsoid, the scale and the false easting and (south) northing.
A, FLAT, SCALE, EASTING, NORTHING = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10_000_000.0
N = FLAT / (2 - FLAT)
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180, 13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440, 61 * N**3 / 240 - 103 * N**4 / 140, 49561 * N**4 / 161280)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360, N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440, 17 * N**3 / 480 - 37 * N**4 / 840, 4397 * N**4 / 161280)
ECC = math.sqrt(FLAT * (2 - FLAT))


def to_utm(lon: Column, lat: Column, zone: Column, south: Column | None = None) -> Column:
    """(x, y) in metres of longitude and latitude in degrees, in a northern zone or where ``south`` in a southern one."""
    origin = F.lit(0.0) if south is None else F.when(south, NORTHING).otherwise(0.0)
    lam = F.radians(lon - (zone * 6 - 183))
    sin = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sin) - ECC * F.atanh(ECC * sin))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.struct((EASTING + SCALE * RADIUS * x).alias("x"), (origin + SCALE * RADIUS * y).alias("y"))


def from_utm(x: Column, y: Column, zone: Column, south: Column | None = None) -> Column:
    """(lon, lat) in degrees of metres."""
    origin = F.lit(0.0) if south is None else F.when(south, NORTHING).otherwise(0.0)
    xi, eta = (y - origin) / (SCALE * RADIUS), (x - EASTING) / (SCALE * RADIUS)
    xi1, eta1 = xi, eta
    for j, b in enumerate(BETA, 1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    lam = F.atan2(F.sinh(eta1), F.cos(xi1))
    chi = F.sin(xi1) / F.cosh(eta1)
    psi = F.atanh(chi)
    sin = chi
    for _ in range(5):  # the isometric latitude's fixed point: the error shrinks by e^2 = 0.007 each time
        sin = F.tanh(psi + ECC * F.atanh(ECC * sin))
    return F.struct((F.degrees(lam) + (zone * 6 - 183)).alias("lon"), F.degrees(F.asin(sin)).alias("lat"))


def snapped(value: Column, step: float) -> Column:
    """The nearest multiple of the step."""
    return F.round(value / step) * step


def snapped_out(low: Column, high: Column, step: float) -> Column:
    """Bounds widened to whole steps."""
    return F.struct(low.alias("low"), (low + F.ceil((high - low) / step) * step).alias("high"))


def needs_reprojection(spacing: Column, epsg: Column, origin: Column, target_spacing: float, target_epsg: int, target_origin: float, tolerance: float = 1e-6) -> Column:
    """Whether a raster is off the target grid by spacing, zone or a part of a cell."""
    cells = (origin - target_origin) / target_spacing
    return (spacing != target_spacing) | (epsg != target_epsg) | (F.abs(cells - F.round(cells)) > tolerance)


def square_code(zone: Column, lat: Column, x: Column, y: Column) -> Column:
    """Grid square of 100 km: zone, latitude band and two letters."""
    # The letters of bands, columns and rows.
    bands, rows = "CDEFGHJKLMNPQRSTUVWX", "ABCDEFGHJKLMNPQRSTUV"
    band = F.substring(F.lit(bands), F.least(F.lit(20), F.floor((lat + 80) / 8) + 1).cast("int"), F.lit(1))
    column = F.substring(F.element_at(F.array(F.lit("ABCDEFGH"), F.lit("JKLMNPQR"), F.lit("STUVWXYZ")), ((zone - 1) % 3 + 1).cast("int")), F.floor(x / 100000).cast("int"), F.lit(1))
    row = F.substring(F.lit(rows), (F.floor(y / 100000) + F.when(zone % 2 == 0, 5).otherwise(0)).cast("int") % 20 + 1, F.lit(1))
    return F.concat(F.lpad(zone.cast("string"), 2, "0"), band, column, row)


def square_box(x: Column, y: Column, side: float = 109_800.0, below: float = 9_800.0) -> Column:
    """The tile of a grid square that begins at (x, y): it reaches ``below`` under the square."""
    return F.struct(x.alias("xmin"), (x + side).alias("xmax"), (y - below).alias("ymin"), (y - below + side).alias("ymax"))
