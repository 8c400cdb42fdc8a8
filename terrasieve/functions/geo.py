"""Geometry as columns (NUM-*, GEO-12, JN-17): distances, offsets, WKB, tiles, points in rings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

EARTH_KM = 6371.0088
KM_PER_DEGREE_LON, KM_PER_DEGREE_LAT = 111.320, 110.574  # at the centroid's spread
METRES_PER_DEGREE = 111132.0


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_KM) -> Column:
    """NUM-1."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def offsets(lat: Column, lon: Column, true_lat: Column, true_lon: Column) -> tuple[Column, Column]:
    """NUM-2: metres to the north and to the east of the true place."""
    return (lat - true_lat) * METRES_PER_DEGREE, (lon - true_lon) * METRES_PER_DEGREE * F.cos(F.radians(true_lat))


def centroid_spread(lon: str, lat: str) -> list[Column]:
    """AGG-5 in one pass: mean place, count, and root mean square spread in km from population variances."""
    east = F.var_pop(lon) * F.pow(F.lit(KM_PER_DEGREE_LON) * F.cos(F.radians(F.avg(lat))), 2)
    north = F.var_pop(lat) * KM_PER_DEGREE_LAT**2
    return [F.avg(lon).alias("lon"), F.avg(lat).alias("lat"), F.count("*").alias("n"), F.when(F.count("*") == 1, 0.0).otherwise(F.sqrt(east + north)).alias("spread_km")]


@F.pandas_udf(T.BinaryType())
def point_wkb(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """SNK-4: little-endian WKB of points, a batch at a time; null without both coordinates."""
    records = np.zeros(len(lon), dtype=[("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])
    records["order"], records["kind"], records["x"], records["y"] = 1, 1, lon, lat
    return pd.Series([None if np.isnan(r["x"]) or np.isnan(r["y"]) else r.tobytes() for r in records], dtype=object)


def bbox(lon: Column, lat: Column) -> Column:
    return F.struct(lon.alias("xmin"), lat.alias("ymin"), lon.alias("xmax"), lat.alias("ymax"))


def tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """GEO-12: Web-Mercator tile column and row."""
    n = float(1 << zoom)
    inside = lambda v: F.greatest(F.lit(0), F.least(F.lit((1 << zoom) - 1), F.floor(v))).cast("int")
    r = F.radians(F.greatest(F.lit(-85.0511), F.least(F.lit(85.0511), lat)))
    return inside((lon + 180.0) / 360.0 * n), inside((1.0 - F.ln(F.tan(r) + 1.0 / F.cos(r)) / F.lit(3.141592653589793)) / 2.0 * n)


def hilbert(x: Column, y: Column, order: int = 16) -> Column:
    """The place of the cell (x, y) along the Hilbert curve; tiles of any zoom are stretches of it."""
    full = (1 << order) - 1
    state = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("at"))

    def step(s: Column, side: Column) -> Column:
        right, up = F.when(s["x"].bitwiseAND(side) != 0, 1).otherwise(0), F.when(s["y"].bitwiseAND(side) != 0, 1).otherwise(0)
        flip, turn = (right == 1) & (up == 0), up == 0
        a, b = F.when(flip, full - s["x"]).otherwise(s["x"]), F.when(flip, full - s["y"]).otherwise(s["y"])
        return F.struct(F.when(turn, b).otherwise(a).alias("x"), F.when(turn, a).otherwise(b).alias("y"), (s["at"] + (right * 3).bitwiseXOR(up) * side * side).alias("at"))

    sides = F.array(*[F.lit(1 << bit).cast("long") for bit in reversed(range(order))])
    return F.aggregate(sides, state, step)["at"]


def in_ring(x: Column, y: Column, ring: list[tuple[float, float]]) -> Column:
    """JN-17: whether a point lies in a ring, by counting crossings."""
    crossings = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if y1 == y2:
            continue
        spans = (F.lit(y1) > y) != (F.lit(y2) > y)
        crossings = crossings + F.when(spans & (x < (y - y1) * ((x2 - x1) / (y2 - y1)) + x1), 1).otherwise(0)
    return crossings % 2 == 1


def affine(x: Column, y: Column, m: list[list[float]]) -> tuple[Column, Column]:
    """NUM-4: x and y through a 3 by 2 matrix of (x, y, 1)."""
    return tuple(x * m[0][k] + y * m[1][k] + m[2][k] for k in (0, 1))


def quadratic(x: Column, y: Column, m: list[list[float]]) -> tuple[Column, Column]:
    """NUM-4: x and y through a 6 by 2 matrix of (1, x, y, x*x, x*y, y*y)."""
    terms = (F.lit(1.0), x, y, x * x, x * y, y * y)
    return tuple(sum(t * m[i][k] for i, t in enumerate(terms)) for k in (0, 1))


def local_km(lon: Column, lat: Column, lon0: float, lat0: float) -> tuple[Column, Column]:
    """NUM-5: kilometres east and north of a place, on a plane."""
    return (lon - lon0) * KM_PER_DEGREE_LON * F.cos(F.radians(F.lit(lat0))), (lat - lat0) * KM_PER_DEGREE_LAT
