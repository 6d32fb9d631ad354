"""Geometry on columns: points, distances, rings, areas, grid cells."""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_METRES = 6371000.0
EARTH_MILES = EARTH_METRES * 0.000621371
MERCATOR_RADIUS = 6378137.0
METRES_PER_DEGREE = 111319.5
PLANAR_MILES_PER_DEGREE = 69.0


def great_circle_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Spherical law of cosines; the cosine is clamped so that rounding cannot leave its domain."""
    a1, a2 = F.radians(lat1), F.radians(lat2)
    cosine = F.cos(a1) * F.cos(a2) * F.cos(F.radians(lon2) - F.radians(lon1)) + F.sin(a1) * F.sin(a2)
    arc = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))
    return F.when((lat1 == lat2) & (lon1 == lon2), F.lit(0.0)).otherwise(arc * EARTH_METRES)


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dlat), 2.0) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2.0)
    return F.asin(F.sqrt(F.least(F.lit(1.0), h))) * (2 * EARTH_MILES)


def planar_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.sqrt(F.pow(lat1 - lat2, 2.0) + F.pow(lon1 - lon2, 2.0)) * PLANAR_MILES_PER_DEGREE


def slope_degrees(lat1: Column, lon1: Column, elev1: Column, lat2: Column, lon2: Column, elev2: Column) -> Column:
    north = (lat2 - lat1) * METRES_PER_DEGREE
    east = (lon2 - lon1) * F.cos(F.radians(lat1)) * METRES_PER_DEGREE
    run = F.sqrt(F.pow(north, 2.0) + F.pow(east, 2.0))
    angle = F.degrees(F.atan2(F.abs(elev2 - elev1), run))
    return F.when((lat1 == lat2) & (lon1 == lon2), F.lit(0.0)).otherwise(angle)


def cell(c: Column, size: float) -> Column:
    """Integer grid index of a coordinate."""
    return F.floor(c / F.lit(size)).cast("bigint")


def ring_from_wkt(wkt: Column) -> Column:
    """Outer ring of ``POLYGON ((x y, …))`` as array<struct<x,y>>; NULL when it does not parse."""
    body = F.regexp_extract(wkt, r"(?i)^\s*POLYGON\s*\(\s*\(([^()]*)\)", 1)
    pairs = F.transform(F.split(body, ","), lambda p: F.split(F.trim(p), r"\s+"))
    ring = F.transform(
        pairs,
        lambda p: F.struct(
            F.get(p, F.lit(0)).try_cast("double").alias("x"), F.get(p, F.lit(1)).try_cast("double").alias("y")
        ),
    )
    broken = F.exists(ring, lambda p: p["x"].isNull() | p["y"].isNull())
    return F.when((F.length(body) > 0) & ~broken & (F.size(ring) >= 3), ring)


def ring_from_geojson(text: Column) -> Column:
    """Outer ring of a GeoJSON Polygon; any other geometry is NULL."""
    schema = "type string, coordinates array<array<array<double>>>"
    parsed = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    outer = F.get(parsed["coordinates"], F.lit(0))
    ring = F.transform(outer, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return F.when((parsed["type"] == "Polygon") & (F.size(outer) >= 3), ring)


def geometry_to_wkt(text: Column) -> Column:
    """WKT of a GeoJSON Polygon or MultiPolygon with all its rings; any other geometry is NULL.

    Ordinates after the second are left out. A ring with fewer than three points makes the whole geometry NULL.
    """
    points = lambda ring: F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", F.get(p, F.lit(0)).cast("string"), F.get(p, F.lit(1)).cast("string"))), ", ")
    shape = lambda rings: F.concat(F.lit("("), F.array_join(F.transform(rings, lambda r: F.concat(F.lit("("), points(r), F.lit(")"))), ", "), F.lit(")"))
    whole = lambda rings: (F.size(rings) > 0) & F.forall(rings, lambda r: (F.size(r) >= 3) & F.forall(r, lambda p: F.get(p, F.lit(1)).isNotNull()))
    kind = F.get_json_object(text, "$.type")
    one = F.from_json(text, "coordinates array<array<array<double>>>", {"mode": "PERMISSIVE"})["coordinates"]
    many = F.from_json(text, "coordinates array<array<array<array<double>>>>", {"mode": "PERMISSIVE"})["coordinates"]
    return F.when((kind == "Polygon") & whole(one), F.concat(F.lit("POLYGON"), shape(one))).when(
        (kind == "MultiPolygon") & (F.size(many) > 0) & F.forall(many, whole),
        F.concat(F.lit("MULTIPOLYGON("), F.array_join(F.transform(many, shape), ", "), F.lit(")")),
    )


def ring_to_wkt(ring: Column) -> Column:
    points = F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.when(F.size(ring) >= 3, F.concat(F.lit("POLYGON(("), F.array_join(points, ", "), F.lit("))")))


def square_wkt(lon: Column, lat: Column, half: Column) -> Column:
    """Closed axis-aligned square around a centre."""
    corners = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
    ring = F.array(*[F.struct((lon + half * sx).alias("x"), (lat + half * sy).alias("y")) for sx, sy in corners])
    return ring_to_wkt(ring)


def mercator(ring: Column) -> Column:
    """Degrees to web-mercator metres."""
    return F.transform(
        ring,
        lambda p: F.struct(
            (F.radians(p["x"]) * MERCATOR_RADIUS).alias("x"),
            (F.log(F.tan(F.lit(math.pi / 4) + F.radians(p["y"]) / 2)) * MERCATOR_RADIUS).alias("y"),
        ),
    )


def _edges(ring: Column) -> Column:
    """Pairs of consecutive points; the last point joins the first, so closing it is optional.

    Coordinates are taken relative to the first point, which keeps the cross products small.
    """
    x0, y0 = ring[0]["x"], ring[0]["y"]
    turned = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        turned,
        lambda a, b: F.struct(
            (a["x"] - x0).alias("ax"), (a["y"] - y0).alias("ay"), (b["x"] - x0).alias("bx"), (b["y"] - y0).alias("by")
        ),
    )


def _edge_sum(ring: Column, term) -> Column:
    return F.aggregate(_edges(ring), F.lit(0.0), lambda acc, e: acc + term(e))


def _edge_cross(e: Column) -> Column:
    return e["ax"] * e["by"] - e["bx"] * e["ay"]


def ring_area(ring: Column) -> Column:
    return F.abs(_edge_sum(ring, _edge_cross)) / 2


def ring_centroid(ring: Column) -> Column:
    """Area centroid; a ring without area falls back to its first point."""
    twice = _edge_sum(ring, _edge_cross)
    cx = _edge_sum(ring, lambda e: (e["ax"] + e["bx"]) * _edge_cross(e)) / (twice * 3)
    cy = _edge_sum(ring, lambda e: (e["ay"] + e["by"]) * _edge_cross(e)) / (twice * 3)
    return F.when(
        twice != 0, F.struct((ring[0]["x"] + cx).alias("x"), (ring[0]["y"] + cy).alias("y"))
    ).otherwise(ring[0])


def ring_box(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1")
    )


# Polygon work in Arrow batches: geometries are parsed once, and pairs of them are measured as arrays. Marked
# non-deterministic so that the optimizer never evaluates them twice to push a filter down.


Point = tuple[float, float]
#: A ring and its part in the geometry: 1 for an outer ring, -1 for a hole.
Signed = tuple[int, tuple[Point, ...]]

_HEAD = re.compile(r"\s*(MULTI)?POLYGON\s*(?:Z|M|ZM)?\s*(?=\()", re.IGNORECASE)
_RING = re.compile(r"\(([^()]*)\)")
_POLYGON = re.compile(r"\(\s*((?:\([^()]*\)\s*,?\s*)+)\)")


def _ring(text: str) -> tuple[Point, ...] | None:
    """Points of a ring without the closing one and without repeats of the point before; further ordinates are left out."""
    points = [tuple(map(float, p.split())) for p in text.split(",")]
    if any(not 2 <= len(p) <= 4 for p in points):
        return None
    ring = [p[:2] for i, p in enumerate(points) if i == 0 or p[:2] != points[i - 1][:2]]
    if len(ring) > 1 and ring[0] == ring[-1]:
        ring.pop()
    return tuple(ring) if len(ring) >= 3 else None


@functools.lru_cache(maxsize=20000)
def _parse(wkt: str | None) -> tuple[Signed, ...] | None:
    """Rings of a WKT polygon or multipolygon; None when any part of it does not parse."""
    head = _HEAD.match(wkt or "")
    if head is None:
        return None
    body = wkt[head.end() :].strip()
    polygons = _POLYGON.findall(body[1:-1] if head[1] else body)
    out: list[Signed] = []
    try:
        for polygon in polygons:
            rings = [_ring(r) for r in _RING.findall(polygon)]
            if not rings or None in rings:
                return None
            out += [(1 if n == 0 else -1, r) for n, r in enumerate(rings)]
    except ValueError:
        return None
    return tuple(out) or None


def _cross(o: Point, a: Point, b: Point) -> float:
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def _twice_area(ring: Sequence[Point]) -> float:
    """Signed, as a fan from the first point, which keeps the products small."""
    return sum(_cross(ring[0], ring[i], ring[i + 1]) for i in range(1, len(ring) - 1))


def _to_mercator(ring: Sequence[Point]) -> list[Point]:
    return [
        (math.radians(x) * MERCATOR_RADIUS, math.log(math.tan(math.pi / 4 + math.radians(y) / 2)) * MERCATOR_RADIUS) for x, y in ring
    ]


def _centre(ring: Sequence[Point]) -> Point:
    total = cx = cy = 0.0
    o = ring[0]
    for a, b in zip(ring[1:], ring[2:]):
        w = _cross(o, a, b)
        total += w
        cx += w * (a[0] + b[0] - 2 * o[0])
        cy += w * (a[1] + b[1] - 2 * o[1])
    return (o[0] + cx / (3 * total), o[1] + cy / (3 * total)) if total else o


def _double_fields(names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names.split()]


RING_FACTS = T.StructType([*_double_fields("x0 y0 x1 y1 area mercator_area mercator_x mercator_y"), T.StructField("edges", T.ArrayType(T.DoubleType()))])
OVERLAP = T.StructType(_double_fields("area mercator_area"))


@F.pandas_udf(RING_FACTS)
def _ring_facts_udf(wkt: pd.Series) -> pd.DataFrame:
    rows = []
    for text in wkt:
        rings = _parse(text)
        if rings is None:
            rows.append((None,) * 9)
            continue
        flat = [(sign, _to_mercator(ring)) for sign, ring in rings]
        shares = [sign * abs(_twice_area(ring)) / 2 for sign, ring in flat]
        centres, total = [_centre(ring) for _, ring in flat], sum(shares)
        x, y = (sum(w * c[i] for w, c in zip(shares, centres)) / total if total and len(flat) > 1 else centres[0][i] for i in (0, 1))
        points = [p for sign, ring in rings if sign > 0 for p in ring]
        rows.append(
            (
                min(x for x, _ in points), min(y for _, y in points), max(x for x, _ in points), max(y for _, y in points),
                sum(sign * abs(_twice_area(ring)) / 2 for sign, ring in rings), total, x, y,
                _directed_edges(rings),
            )
        )
    return pd.DataFrame(rows, columns=RING_FACTS.names)


def _directed_edges(rings: Sequence[Signed]) -> list[float]:
    """x, y, x, y of every side, outer rings counter-clockwise and holes clockwise; upright sides bound no area from below."""
    out: list[float] = []
    for sign, ring in rings:
        around = ring if (_twice_area(ring) >= 0) == (sign > 0) else ring[::-1]
        for a, b in zip(around, (*around[1:], around[0])):
            if a[0] != b[0]:
                out += (*a, *b)
    return out


def _under_both(e: np.ndarray, f: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Signed area between ``base`` and the lower of two sides over the x that they share, for arrays of sides."""
    left = np.maximum(np.minimum(e[:, 0], e[:, 2]), np.minimum(f[:, 0], f[:, 2]))
    wide = np.maximum(np.minimum(np.maximum(e[:, 0], e[:, 2]), np.maximum(f[:, 0], f[:, 2])) - left, 0.0)

    def height(s: np.ndarray, x: np.ndarray) -> np.ndarray:
        return s[:, 1] + (x - s[:, 0]) * ((s[:, 3] - s[:, 1]) / (s[:, 2] - s[:, 0])) - base

    e0, e1, f0, f1 = height(e, left), height(e, left + wide), height(f, left), height(f, left + wide)
    low0, low1, gap0, gap1 = np.minimum(e0, f0), np.minimum(e1, f1), e0 - f0, e1 - f1
    crossing = gap0 * gap1 < 0
    t = np.where(crossing, gap0 / np.where(crossing, gap0 - gap1, 1.0), 0.0)
    peak = np.where(crossing, e0 + t * (e1 - e0), low0)
    signs = np.where((e[:, 0] > e[:, 2]) == (f[:, 0] > f[:, 2]), 1.0, -1.0)
    return signs * wide * (t * (low0 + peak) + (1 - t) * (peak + low1)) / 2


#: Pairs of sides that are held at once: about 300 MB of numbers.
SIDES_AT_ONCE = 1_000_000


def common_areas(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, at_once: int = SIDES_AT_ONCE) -> np.ndarray:
    """Common area of many pairs of shapes; ``a`` holds the directed sides of all first shapes in turn, ``n_a`` of them each.

    The area under a directed outline is the signed sum of the strips under its sides, so what two shapes share is the sum over
    pairs of sides of the strips under both. Pairs of sides are laid out flat, a bounded number at a time.
    """
    pair = np.repeat(np.arange(len(n_a)), n_a)
    base = np.full(len(n_a), np.inf)
    for shape, of in ((a, pair), (b, np.repeat(np.arange(len(n_b)), n_b))):
        np.minimum.at(base, of, np.minimum(shape[:, 1], shape[:, 3]))
    out, first, repeats = np.zeros(len(n_a)), np.cumsum(n_b) - n_b, n_b[pair]
    upto, low = np.cumsum(repeats), 0
    while low < len(pair):
        done = upto[low - 1] if low else 0
        high = max(int(np.searchsorted(upto, done + at_once, "right")), low + 1)
        r = repeats[low:high]
        i = np.repeat(np.arange(low, high), r)
        j = first[pair[i]] + np.arange(len(i)) - np.repeat(np.cumsum(r) - r, r)
        out += np.bincount(pair[i], _under_both(a[i], b[j], base[pair[i]]), len(out))
        low = high
    return np.maximum(out, 0.0)


def _sides(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sides of a column of flat edge lists, and how many each row has (none where null)."""
    counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) // 4
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4), counts


def _mercator_sides(sides: np.ndarray) -> np.ndarray:
    out = np.radians(sides)
    out[:, 1::2] = np.log(np.tan(np.pi / 4 + out[:, 1::2] / 2))
    return out * MERCATOR_RADIUS


@F.arrow_udf(OVERLAP)
def _overlap_udf(subject: pa.Array, other: pa.Array) -> pa.Array:
    (a, n_a), (b, n_b) = _sides(subject), _sides(other)
    degrees, metres = common_areas(a, n_a, b, n_b), common_areas(_mercator_sides(a), n_a, _mercator_sides(b), n_b)
    return pa.StructArray.from_arrays([pa.array(degrees), pa.array(metres)], names=OVERLAP.names)


def ring_facts(wkt: Column) -> Column:
    """struct of bounding box, areas (square degrees, square mercator metres), mercator centroid and directed sides; holes count as
    missing. Null where the text is no polygon."""
    return _ring_facts_udf.asNondeterministic()(wkt)


def overlap(subject_edges: Column, other_edges: Column) -> Column:
    """struct of the common area of two shapes, given by the sides that ``ring_facts`` finds; a whole batch is one array operation.

    In mercator metres the sides are straight between the corners of the shapes, so a shape within another one keeps its own area.
    """
    return _overlap_udf.asNondeterministic()(subject_edges, other_edges)
