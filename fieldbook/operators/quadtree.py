"""Nearest neighbours on adaptive quadtrees: leaves hold few points wherever they lie, and pairs of cells are narrowed by distance.

Cells of level l are 8 / 8^l degrees wide. A cell is split while a sample says that it is crowded, so a city is cut down to
streets and an ocean stays one cell. Two trees (the asking points', the found points') are descended together: a pair of cells
survives while its least possible distance does not exceed the smallest sure distance of the asking cell. Points meet only
in the pairs of leaves that are left; every leaf is small, so no task holds a crowd.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions.geo import EARTH_MILES, haversine_miles
from fieldbook.session import cut_lineage, if_small, shuffled

MILES_PER_DEGREE = EARTH_MILES * math.pi / 180
#: Degrees of the coarsest cells, cells into which a side of one is split, and levels (the finest cells are 7 mm wide).
COARSEST, SPLIT, LEVELS = 8.0, 8, 10
#: Points of a leaf, about: asking ones, found ones. A sample decides on a split by this number of its points.
ASKING, FOUND, SAMPLED = 512, 64, 16

BOX = ("south", "north", "west", "east")


def _index(level: Column | int) -> tuple[Column, Column]:
    """Row and column of a coordinate's cell. Widths are powers of two, so cells of all levels nest exactly."""
    scale = F.pow(F.lit(float(SPLIT)), level if isinstance(level, Column) else F.lit(level)) / COARSEST
    return F.floor((F.col("latitude") + 90.0) * scale).alias("y"), F.floor((F.col("longitude") + 180.0) * scale).alias("x")


def leaves(points: DataFrame, size: int) -> DataFrame:
    """``points`` with the cell (``level``, ``y``, ``x``) of the leaf that holds them, each leaf with about ``size`` points at most.

    A hash of the coordinates draws the sample, so the tree is the same on every run and copies of a coordinate stay together.
    """
    share = max(size // SAMPLED, 1)
    live = points.where(F.pmod(F.xxhash64("latitude", "longitude"), F.lit(share)) == 0).select("latitude", "longitude")
    out = points.withColumn("level", F.lit(0))
    for level in range(LEVELS - 1):
        cells = live.withColumns(dict(zip("yx", _index(level)))).groupBy("y", "x").agg(F.count(F.lit(1)).alias("_n"))
        crowded = cut_lineage(cells.where(F.col("_n") * share > size).select("y", "x"))
        if crowded.isEmpty():
            break
        crowded = if_small(crowded).withColumn("_split", F.lit(level + 1))
        at = dict(zip(("y", "x"), _index(level)))
        live = live.withColumns(at).join(crowded, ["y", "x"], "left_semi").drop("y", "x")
        out = out.withColumns(at).join(crowded, ["y", "x"], "left").withColumn("level", F.coalesce("_split", "level")).drop("y", "x", "_split")
    return out.withColumns(dict(zip("yx", _index(F.col("level")))))


def _nodes(tree: DataFrame, level: int, prefix: str) -> DataFrame:
    """The tree cut off below ``level``: cells with the box of their points and the cell they come from, one level up."""
    at = lambda depth: [
        F.least("level", F.lit(depth)).alias("level"), *[F.floor(F.col(c) / F.pow(F.lit(float(SPLIT)), F.greatest(F.col("level") - depth, F.lit(0)))).alias(c) for c in "yx"]
    ]
    cut = tree.select(*BOX, F.struct(*at(level)).alias("_cell"), F.struct(*at(max(level - 1, 0))).alias("_up"))
    boxes = [F.min("south").alias("south"), F.max("north").alias("north"), F.min("west").alias("west"), F.max("east").alias("east")]
    cut = cut.groupBy("_cell", "_up").agg(*boxes)
    return cut.select(F.col("_cell").alias(prefix), F.col("_up").alias(f"{prefix}_up"), *[F.col(c).alias(f"{prefix}_{c}") for c in BOX])


def _distances() -> tuple[Column, Column]:
    """Least and greatest possible distance in miles between a point of box q and one of box s."""
    q, s = [{c: F.col(f"{p}_{c}") for c in BOX} for p in "qs"]
    zero = F.lit(0.0)
    gap_lat = F.greatest(zero, s["south"] - q["north"], q["south"] - s["north"])
    spread_lon = F.greatest(s["east"], q["east"]) - F.least(s["west"], q["west"])
    gap_lon = F.greatest(zero, F.least(F.greatest(s["west"] - q["east"], q["west"] - s["east"]), 360.0 - spread_lon))
    polar = F.greatest(*[F.abs(b[c]) for b in (q, s) for c in ("south", "north")])
    shrink = F.cos(F.radians(F.least(polar, F.lit(90.0))))
    # Two points at least gap_lon apart in longitude: sin(d/2) >= cos(lat) * sin(gap/2).
    by_lon = F.asin(F.least(F.lit(1.0), shrink * F.sin(F.radians(F.least(gap_lon, F.lit(180.0))) / 2))) * (2 * EARTH_MILES)
    wide_lat = F.greatest(s["north"], q["north"]) - F.least(s["south"], q["south"])
    wide_lon = F.least(spread_lon, F.lit(180.0))
    return F.greatest(gap_lat * MILES_PER_DEGREE, by_lon), F.sqrt(wide_lat * wide_lat + wide_lon * wide_lon) * MILES_PER_DEGREE


def leaf_pairs(asking: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of leaves (``q``, ``s``) that may hold a nearest neighbour; both tables come from ``leaves``."""
    cells = lambda df: cut_lineage(
        df.groupBy("level", "y", "x").agg(
            F.min("latitude").alias("south"), F.max("latitude").alias("north"), F.min("longitude").alias("west"), F.max("longitude").alias("east")
        )
    )
    q_tree, s_tree = cells(asking), cells(found)
    depth = q_tree.select("level").union(s_tree.select("level")).agg(F.max("level")).first()[0] or 0
    pairs = None
    for level in range(depth + 1):
        q, s = _nodes(q_tree, level, "q"), _nodes(s_tree, level, "s")
        if pairs is None:  # cells of 8 degrees: at most 45 x 23 on the globe, whatever the data
            every = s.drop("s_up").agg(F.collect_list(F.struct("s", *[f"s_{c}" for c in BOX])).alias("all"))
            grown = q.withColumn("_s", F.explode(every.select("all").scalar())).select("*", "_s.*").drop("_s")
        else:
            up = pairs.select(F.col("q").alias("q_up"), F.col("s").alias("s_up"))
            grown = up.join(shuffled(q), "q_up").join(shuffled(s), "s_up")
        lower, upper = _distances()
        bounded = grown.select("q", "s", lower.alias("_lower"), upper.alias("_upper"))
        best = bounded.groupBy("q").agg(F.min("_upper").alias("_best"))
        pairs = bounded.join(shuffled(best), "q").where(F.col("_lower") <= F.col("_best") * 1.000000001 + 1e-9).select("q", "s")
        pairs = cut_lineage(pairs)
    return pairs


def nearest(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """The nearest right row of every left row by great-circle distance; ties go to the lower key.

    Equal coordinates are looked up once. Rows without coordinates on either side have no neighbour and are not returned; so
    is every left row when the right side is empty.
    """
    located = lambda df: df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    spots = located(right).groupBy("latitude", "longitude").agg(F.min(right_key).alias(right_key))
    places = located(left).select("latitude", "longitude").distinct()
    asking = leaves(places, ASKING).withColumn("q", F.struct("level", "y", "x"))
    found = leaves(spots, FOUND).withColumn("s", F.struct("level", "y", "x"))
    pairs = leaf_pairs(asking, found)
    candidates = found.select("s", F.col(right_key).alias("_rk"), F.col("latitude").alias("_rlat"), F.col("longitude").alias("_rlon")).join(shuffled(pairs), "s").drop("s")
    d = haversine_miles(F.col("latitude"), F.col("longitude"), F.col("_rlat"), F.col("_rlon"))
    # A number is kept in a hash table as the pairs pass; a distance with its key would have to sort every pair. So the least
    # distance comes first, and the few pairs that have it then give the key.
    met = asking.select("q", "latitude", "longitude").join(shuffled(candidates), "q")
    least = cut_lineage(met.groupBy("q", "latitude", "longitude").agg(F.min(d).alias("distance_miles")))
    best = least.join(shuffled(candidates), "q").where(d == F.col("distance_miles"))
    best = best.groupBy("latitude", "longitude", "distance_miles").agg(F.min(F.struct("_rk"))["_rk"].alias(right_key))
    asked = located(left).select(left_key, "latitude", "longitude").join(shuffled(best), ["latitude", "longitude"])
    return asked.select(left_key, right_key, "distance_miles")
