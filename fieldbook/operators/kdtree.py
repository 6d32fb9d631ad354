"""Vectors of any number of components in small leaves of a kd tree, and work between leaves that lie near each other.

A node with too many rows is cut at quantiles of its widest component, level by level. Rows are sent down the same cuts, each
with its own reach, to the leaves within that distance: a row reaches few leaves, however many a whole leaf would reach. They
meet the rows of a leaf some at a time, so a task holds about two leaves, however many rows there are and however many
components they have.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.session import cut_lineage, if_small

#: Rows of a leaf at most, and parts that a node is cut into.
LEAF, PARTS = 2000, 8


def partition(rows: DataFrame, dims: int, leaf: int = LEAF) -> tuple[DataFrame, list[DataFrame]]:
    """``rows`` (with distinct vectors ``p``) and their leaf ``node``, and the cuts of each level (``node``, ``dim``, ``cuts``)."""
    placed, levels = rows.withColumn("node", F.lit("")), []
    value = F.element_at("p", F.col("dim") + 1)
    while True:
        low, high = [F.array(*[f(F.col("p")[i]) for i in range(dims)]) for f in (F.min, F.max)]
        sizes = placed.groupBy("node").agg(F.count(F.lit(1)).alias("n"), low.alias("low"), high.alias("high")).where(F.col("n") > leaf)
        width = F.zip_with("high", "low", lambda h, l: h - l)  # noqa: E741
        wide = sizes.withColumn("dim", (F.array_position(width, F.array_max(width)) - 1).cast("int"))
        wide = cut_lineage(wide.select("node", "dim", F.element_at("low", F.col("dim") + 1).alias("a"), F.element_at("high", F.col("dim") + 1).alias("b")))
        if wide.isEmpty():
            return placed, levels
        at = F.percentile_approx(value, [i / PARTS for i in range(1, PARTS)], 2000).alias("cuts")
        cut = placed.join(if_small(wide), "node").groupBy("node", "dim", "a", "b").agg(at)
        # A cut below the greatest value always parts rows; where quantiles give none, the middle of the range does.
        inner = F.array_distinct(F.filter("cuts", lambda c: c < F.col("b")))
        cut = cut.withColumn("cuts", F.when(F.size(inner) > 0, inner).otherwise(F.array((F.col("a") + F.col("b")) / 2)))
        levels.append(cut_lineage(cut.select("node", "dim", "cuts")))
        moved = placed.join(if_small(levels[-1]), "node", "left")
        child = _child(value)
        placed = cut_lineage(moved.withColumn("node", F.when(F.col("cuts").isNotNull(), F.concat_ws(".", "node", child.cast("string"))).otherwise(F.col("node"))).drop("dim", "cuts"))


def _child(x: Column) -> Column:
    return F.size(F.filter("cuts", lambda c: c < x))


def boxes(placed: DataFrame, dims: int) -> DataFrame:
    low, high = [F.array(*[f(F.col("p")[i]) for i in range(dims)]) for f in (F.min, F.max)]
    return placed.groupBy("node").agg(low.alias("low"), high.alias("high"))


def reached(asking: DataFrame, found: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Rows of ``asking``, once for each leaf ``b`` of ``found`` (boxes) that is at most ``reach`` (a column) away from the row."""
    keep = [c for c in asking.columns if c != "reach"]
    rows = asking.withColumn("b", F.lit(""))
    for cut in levels:
        split = rows.join(if_small(cut.withColumnRenamed("node", "b")), "b", "left")
        x = F.element_at("p", F.col("dim") + 1)
        child = F.when(F.col("cuts").isNotNull(), F.sequence(_child(x - F.col("reach")), _child(x + F.col("reach")))).otherwise(F.array(F.lit(-1)))
        rows = split.withColumn("_c", F.explode(child))
        rows = rows.withColumn("b", F.when(F.col("_c") < 0, F.col("b")).otherwise(F.concat_ws(".", "b", F.col("_c").cast("string")))).drop("dim", "cuts", "_c")
    met = rows.join(if_small(found.select(F.col("node").alias("b"), "low", "high")), "b")
    zero = F.lit(0.0)
    gaps = F.zip_with(F.zip_with("low", "p", lambda l, x: l - x), F.zip_with("p", "high", lambda x, h: x - h), lambda x, y: F.greatest(x, y, zero))  # noqa: E741
    apart = F.sqrt(F.aggregate(gaps, zero, lambda s, g: s + g * g))
    return met.where(apart <= F.col("reach") * 1.000000001 + 1e-12).select(*keep, "b")


class Side:
    """Rows of one leaf in a meeting: vectors as a matrix, other columns as lists."""

    def __init__(self, table: pa.Table):
        self.table = table
        flat = table.column("p").combine_chunks()
        self.p = np.asarray(flat.flatten(), dtype=float).reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, 1))

    def column(self, name: str) -> np.ndarray:
        return self.table.column(name).to_numpy()


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances between two sets of vectors, component by component, so that memory does not grow with their number."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1] if out.size else 0):
        out += np.subtract.outer(a[:, i], b[:, i]) ** 2
    return np.sqrt(out)


def meet(asking: DataFrame, found: DataFrame, fn: Callable[[Side, Side], list], schema: str) -> DataFrame:
    """``fn`` over the asking rows of a leaf ``b``, LEAF of them or so at a time, and all found rows of that leaf. It returns columns.

    ``asking`` is read twice, so it should be stored.
    """
    names = [c for c in dict.fromkeys([*asking.columns, *found.columns]) if c not in ("node", "b")]
    parts = asking.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / LEAF).cast("int").alias("_parts"))
    parts = if_small(cut_lineage(parts))
    left = asking.drop("node").join(parts, "b").withColumn("_part", F.pmod(F.xxhash64("p"), F.col("_parts")).cast("int")).drop("_parts")
    right = found.withColumnRenamed("node", "b").join(parts, "b").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    both = left.withColumn("_side", F.lit(0)).unionByName(right.withColumn("_side", F.lit(1)), allowMissingColumns=True).select("b", "_part", "_side", *names)
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(table: pa.Table) -> pa.Table:
        side = table.column("_side").to_numpy()
        columns = fn(*[Side(table.take(pa.array(np.flatnonzero(side == s)))) for s in (0, 1)])
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return both.groupBy("b", "_part").applyInArrow(run, schema)
