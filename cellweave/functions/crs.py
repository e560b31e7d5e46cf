"""Map projections as Column expressions (Snyder, USGS Professional Paper 1395).

Every function maps a pair of Columns to a pair of Columns, so projecting stays in the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: WGS84 ellipsoid; Africa Albers (ESRI:102022) parallels and origin; sphere radius of EPSG:3857
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
ALBERS_LAT1, ALBERS_LAT2, ALBERS_LAT0, ALBERS_LON0 = 20.0, -23.0, 0.0, 25.0
UTM_K0, UTM_EASTING, UTM_SOUTH_NORTHING = 0.9996, 500000.0, 10000000.0

E2 = WGS84_F * (2 - WGS84_F)
E1 = math.sqrt(E2)
Pair = tuple[Column, Column]


def _q(sin_lat: float) -> float:
    return (1 - E2) * (
        sin_lat / (1 - E2 * sin_lat**2) - math.log((1 - E1 * sin_lat) / (1 + E1 * sin_lat)) / (2 * E1)
    )


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - E2 * math.sin(lat) ** 2)


def _albers_constants() -> tuple[float, float, float]:
    p1, p2, p0 = (math.radians(v) for v in (ALBERS_LAT1, ALBERS_LAT2, ALBERS_LAT0))
    q1, q2, q0 = (_q(math.sin(v)) for v in (p1, p2, p0))
    n = (_m(p1) ** 2 - _m(p2) ** 2) / (q2 - q1)
    c = _m(p1) ** 2 + n * q1
    return n, c, WGS84_A * math.sqrt(c - n * q0) / n


ALBERS_N, ALBERS_C, ALBERS_RHO0 = _albers_constants()


def to_albers(lon: Column, lat: Column) -> Pair:
    s = F.sin(F.radians(lat))
    q = F.lit(1 - E2) * (
        s / (1 - F.lit(E2) * s * s) - F.log((1 - F.lit(E1) * s) / (1 + F.lit(E1) * s)) / F.lit(2 * E1)
    )
    rho = F.lit(WGS84_A) * F.sqrt(F.lit(ALBERS_C) - F.lit(ALBERS_N) * q) / F.lit(ALBERS_N)
    theta = F.lit(ALBERS_N) * F.radians(lon - F.lit(ALBERS_LON0))
    return rho * F.sin(theta), F.lit(ALBERS_RHO0) - rho * F.cos(theta)


def from_albers(x: Column, y: Column) -> Pair:
    sign = math.copysign(1.0, ALBERS_N)
    dy = F.lit(ALBERS_RHO0) - y
    rho = F.sqrt(x * x + dy * dy)
    theta = F.atan2(F.lit(sign) * x, F.lit(sign) * dy)
    ratio = rho * F.lit(ALBERS_N / WGS84_A)
    q = (F.lit(ALBERS_C) - ratio * ratio) / F.lit(ALBERS_N)
    beta = F.asin(F.least(F.greatest(q / F.lit(_q(1.0)), F.lit(-1.0)), F.lit(1.0)))
    e4, e6 = E2**2, E2**3
    lat = (
        beta
        + F.lit(E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta)
        + F.lit(23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta)
        + F.lit(761 * e6 / 45360) * F.sin(6 * beta)
    )
    return F.degrees(theta / F.lit(ALBERS_N)) + F.lit(ALBERS_LON0), F.degrees(lat)


def to_mercator(lon: Column, lat: Column) -> Pair:
    return (
        F.radians(lon) * F.lit(WGS84_A),
        F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * F.lit(WGS84_A),
    )


def from_mercator(x: Column, y: Column) -> Pair:
    return (
        F.degrees(x / F.lit(WGS84_A)),
        F.degrees(2 * F.atan(F.exp(y / F.lit(WGS84_A))) - F.lit(math.pi / 2)),
    )


# transverse Mercator series in the third flattening, to third order
_N = WGS84_F / (2 - WGS84_F)
TM_RADIUS = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
TM_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
TM_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
TM_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def utm_zone(lon: float) -> int:
    """UTM zone number of a longitude."""
    return min(max(int(math.floor((lon + 180) / 6)) + 1, 1), 60)


def to_utm(lon: Column, lat: Column, zone: int, south: bool = False) -> Pair:
    lam = F.radians(lon - F.lit(zone * 6.0 - 183.0))
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - F.lit(E1) * F.atanh(F.lit(E1) * s))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(TM_ALPHA, start=1):
        x = x + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    scale = F.lit(UTM_K0 * TM_RADIUS)
    return F.lit(UTM_EASTING) + scale * x, F.lit(UTM_SOUTH_NORTHING if south else 0.0) + scale * y


def from_utm(x: Column, y: Column, zone: int, south: bool = False) -> Pair:
    scale = F.lit(UTM_K0 * TM_RADIUS)
    xi = (y - F.lit(UTM_SOUTH_NORTHING if south else 0.0)) / scale
    eta = (x - F.lit(UTM_EASTING)) / scale
    xi2, eta2 = xi, eta
    for j, b in enumerate(TM_BETA, start=1):
        xi2 = xi2 - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta2 = eta2 - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi2) / F.cosh(eta2))
    lat = chi
    for j, d in enumerate(TM_DELTA, start=1):
        lat = lat + F.lit(d) * F.sin(2 * j * chi)
    lon = F.atan2(F.sinh(eta2), F.cos(xi2))
    return F.degrees(lon) + F.lit(zone * 6.0 - 183.0), F.degrees(lat)


def _utm_code(crs: str) -> tuple[int, bool] | None:
    if crs.startswith(("EPSG:326", "EPSG:327")) and len(crs) == 10 and 1 <= int(crs[-2:]) <= 60:
        return int(crs[-2:]), crs.startswith("EPSG:327")
    return None


def projection(src: str | None, dst: str | None) -> Callable[[Column, Column], Pair]:
    """``(x, y) -> (x, y)`` between two CRS names; a missing name means EPSG:4326."""
    src, dst = src or "EPSG:4326", dst or "EPSG:4326"
    if src == dst:
        return lambda x, y: (x, y)
    if src != "EPSG:4326" and dst != "EPSG:4326":
        inverse, forward = projection(src, "EPSG:4326"), projection("EPSG:4326", dst)
        return lambda x, y: forward(*inverse(x, y))
    other = dst if src == "EPSG:4326" else src
    inverse = src != "EPSG:4326"
    if other == "ESRI:102022":
        return from_albers if inverse else to_albers
    if other == "EPSG:3857":
        return from_mercator if inverse else to_mercator
    utm = _utm_code(other)
    if utm:
        one_way = from_utm if inverse else to_utm
        return lambda x, y: one_way(x, y, *utm)
    raise ValueError(f"no projection from {src} to {dst}")


def is_geographic(crs: str | None) -> bool:
    return (crs or "EPSG:4326") == "EPSG:4326"


def reproject_bounds(left: Column, bottom: Column, right: Column, top: Column, src: str, dst: str) -> list[Column]:
    """Box of the four projected corners: ``left, bottom, right, top``."""
    move = projection(src, dst)
    corners = [move(x, y) for x in (left, right) for y in (bottom, top)]
    xs, ys = [c[0] for c in corners], [c[1] for c in corners]
    return [F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)]
