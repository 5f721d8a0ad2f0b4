"""Coordinate transformation between geographic and UTM systems.

The mathematics (Krueger's transverse-Mercator series to the fourth order and a
geocentric 3-parameter shift) is written once as a list of steps. A step maps
named inputs to named outputs using the functions of a namespace, so the same
text runs on Spark Columns (``ON_COLUMNS``) and on Arrow batches (``ON_ARRAYS``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ON_COLUMNS = SimpleNamespace(
    sin=F.sin, cos=F.cos, sinh=F.sinh, cosh=F.cosh, asin=F.asin, atan2=F.atan2,
    asinh=F.asinh, atanh=F.atanh, sqrt=F.sqrt, num=F.lit)
ON_ARRAYS = SimpleNamespace(
    sin=np.sin, cos=np.cos, sinh=np.sinh, cosh=np.cosh, asin=np.arcsin, atan2=np.arctan2,
    asinh=np.arcsinh, atanh=np.arctanh, sqrt=np.sqrt, num=float)

DEGREE = math.pi / 180

# Datum -> semi-major axis, inverse flattening, shift to the
# geocentric frame shared by WGS 84 and SIRGAS 2000 (metres).
DATUMS = {
    "wgs84": (6378137.0, 298.257223563, (0.0, 0.0, 0.0)),
    "sirgas2000": (6378137.0, 298.257222101, (0.0, 0.0, 0.0)),
    "sad69": (6378160.0, 298.25, (-67.35, 3.88, -38.22)),
}
# Geographic systems.
GEOGRAPHIC = {4326: "wgs84", 4674: "sirgas2000", 4618: "sad69"}
# First code, last code, datum, zone of the first code, southern.
UTM_RANGES = (
    (32601, 32660, "wgs84", 1, False), (32701, 32760, "wgs84", 1, True),
    (31965, 31976, "sirgas2000", 11, False), (31977, 31985, "sirgas2000", 17, True),
    (29168, 29172, "sad69", 18, False), (29187, 29195, "sad69", 17, True),
)
# UTM scale and offsets.
SCALE, FALSE_EASTING, FALSE_NORTHING_SOUTH = 0.9996, 500000.0, 10000000.0


@dataclass(frozen=True)
class Crs:
    srid: int
    datum: str
    zone: int | None = None
    south: bool = False


def crs(srid: int) -> Crs:
    if srid in GEOGRAPHIC:
        return Crs(srid, GEOGRAPHIC[srid])
    for first, last, datum, zone, south in UTM_RANGES:
        if first <= srid <= last:
            return Crs(srid, datum, zone + srid - first, south)
    raise ValueError(f"unknown SRID {srid}")


def krueger(a: float, rf: float) -> SimpleNamespace:
    """Constants of the series for one ellipsoid, from the third flattening."""
    f = 1 / rf
    n = f / (2 - f)
    n2, n3, n4 = n * n, n**3, n**4
    return SimpleNamespace(
        e=math.sqrt(f * (2 - f)),
        radius=a / (1 + n) * (1 + n2 / 4 + n4 / 64),
        alpha=(n / 2 - 2 * n2 / 3 + 5 * n3 / 16 + 41 * n4 / 180,
               13 * n2 / 48 - 3 * n3 / 5 + 557 * n4 / 1440,
               61 * n3 / 240 - 103 * n4 / 140,
               49561 * n4 / 161280),
        beta=(n / 2 - 2 * n2 / 3 + 37 * n3 / 96 - n4 / 360,
              n2 / 48 + n3 / 15 - 437 * n4 / 1440,
              17 * n3 / 480 - 37 * n4 / 840,
              4397 * n4 / 161280),
        delta=(2 * n - 2 * n2 / 3 - 2 * n3 + 116 * n4 / 45,
               7 * n2 / 3 - 8 * n3 / 5 - 227 * n4 / 45,
               56 * n3 / 15 - 136 * n4 / 35,
               4279 * n4 / 630),
    )


def _from_utm(c: Crs) -> list:
    a, rf, _ = DATUMS[c.datum]
    k = krueger(a, rf)
    north0 = FALSE_NORTHING_SOUTH if c.south else 0.0
    size = SCALE * k.radius
    meridian = c.zone * 6 - 183

    def scaled(v, m):
        return {"xi": (v["y"] - north0) / size, "eta": (v["x"] - FALSE_EASTING) / size}

    def unwarped(v, m):
        xi, eta = v["xi"], v["eta"]
        return {
            "xi": xi - sum(b * m.sin(xi * 2 * j) * m.cosh(eta * 2 * j) for j, b in enumerate(k.beta, 1)),
            "eta": eta - sum(b * m.cos(xi * 2 * j) * m.sinh(eta * 2 * j) for j, b in enumerate(k.beta, 1)),
        }

    def on_sphere(v, m):
        return {"chi": m.asin(m.sin(v["xi"]) / m.cosh(v["eta"])),
                "lam": m.atan2(m.sinh(v["eta"]), m.cos(v["xi"]))}

    def geographic(v, m):
        chi = v["chi"]
        lat = chi + sum(d * m.sin(chi * 2 * j) for j, d in enumerate(k.delta, 1))
        return {"x": v["lam"] / DEGREE + meridian, "y": lat / DEGREE}

    return [scaled, unwarped, on_sphere, geographic]


def _to_utm(c: Crs) -> list:
    a, rf, _ = DATUMS[c.datum]
    k = krueger(a, rf)
    north0 = FALSE_NORTHING_SOUTH if c.south else 0.0
    size = SCALE * k.radius
    meridian = c.zone * 6 - 183

    def radians(v, m):
        return {"s": m.sin(v["y"] * DEGREE), "lam": (v["x"] - meridian) * DEGREE}

    def conformal(v, m):
        return {"t": m.sinh(m.atanh(v["s"]) - m.atanh(v["s"] * k.e) * k.e)}

    def on_cylinder(v, m):
        t, c_lam = v["t"], m.cos(v["lam"])
        return {"xi": m.atan2(t, c_lam),
                "eta": m.asinh(m.sin(v["lam"]) / m.sqrt(t * t + c_lam * c_lam))}

    def grid(v, m):
        xi, eta = v["xi"], v["eta"]
        east = eta + sum(q * m.cos(xi * 2 * j) * m.sinh(eta * 2 * j) for j, q in enumerate(k.alpha, 1))
        north = xi + sum(q * m.sin(xi * 2 * j) * m.cosh(eta * 2 * j) for j, q in enumerate(k.alpha, 1))
        return {"x": east * size + FALSE_EASTING, "y": north * size + north0}

    return [radians, conformal, on_cylinder, grid]


def _shift(src: Crs, dst: Crs) -> list:
    """Geocentric shift between two datums, at height zero."""
    a1, rf1, to_common = DATUMS[src.datum]
    a2, rf2, back = DATUMS[dst.datum]
    dx, dy, dz = (p - q for p, q in zip(to_common, back))
    e1, e2 = (2 - 1 / rf1) / rf1, (2 - 1 / rf2) / rf2
    b2 = a2 * (1 - 1 / rf2)

    def radius(v, m):
        s = m.sin(v["y"] * DEGREE)
        return {"s": s, "n": m.num(a1) / m.sqrt(m.num(1.0) - s * s * e1)}

    def geocentric(v, m):
        flat = v["n"] * m.cos(v["y"] * DEGREE)
        return {"gx": flat * m.cos(v["x"] * DEGREE) + dx, "gy": flat * m.sin(v["x"] * DEGREE) + dy,
                "gz": v["n"] * v["s"] * (1 - e1) + dz}

    def reduced(v, m):
        p = m.sqrt(v["gx"] * v["gx"] + v["gy"] * v["gy"])
        return {"p": p, "th": m.atan2(v["gz"] * a2, p * b2)}

    def geodetic(v, m):
        s, c = m.sin(v["th"]), m.cos(v["th"])
        lat = m.atan2(v["gz"] + s * s * s * (e2 / (1 - e2) * b2), v["p"] - c * c * c * (e2 * a2))
        return {"x": m.atan2(v["gy"], v["gx"]) / DEGREE, "y": lat / DEGREE}

    return [radius, geocentric, reduced, geodetic]


def steps(src_srid: int, dst_srid: int) -> list:
    """Steps from one system to another; empty when the coordinates do not change."""
    src, dst = crs(src_srid), crs(dst_srid)
    if src == dst:
        return []
    chain = []
    if src.zone is not None:
        chain += _from_utm(src)
    if DATUMS[src.datum][2] != DATUMS[dst.datum][2]:
        chain += _shift(src, dst)
    if dst.zone is not None:
        chain += _to_utm(dst)
    return chain


def transform_arrays(x: np.ndarray, y: np.ndarray, chain: list) -> tuple[np.ndarray, np.ndarray]:
    v = {"x": x, "y": y}
    for step in chain:
        v.update(step(v, ON_ARRAYS))
    return v["x"], v["y"]


def transform_columns(df: DataFrame, x: str, y: str, chain: list) -> DataFrame:
    """One projection per step, so no step's result is written out twice in the plan."""
    names = {"x": x, "y": y}
    scratch = []
    for step in chain:
        out = step({k: F.col(c) for k, c in names.items()}, ON_COLUMNS)
        for k in out:
            if k not in names:
                names[k] = f"_crs_{k}"
                scratch.append(names[k])
        df = df.withColumns({names[k]: c for k, c in out.items()})
    return df.drop(*scratch)
