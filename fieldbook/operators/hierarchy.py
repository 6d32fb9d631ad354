"""Agglomerative clusters: rows are summed up in a bounded number of micro-clusters, which Ward's linkage then joins.

A micro-cluster is a clustering feature (rows, sum, sum of squares). Every task condenses its rows to at most MICRO of them,
groups of tasks condense theirs again, and the last ones, MICRO at most, are linked on the driver. Up to MICRO distinct vectors
the result is that of linking the rows themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.session import cut_lineage

#: Micro-clusters that are kept at once, and tasks whose micro-clusters meet in a round.
MICRO, MEET = 1000, 16

SCHEMA = "part bigint, n double, total array<double>, squares double"


def condense(n: np.ndarray, total: np.ndarray, squares: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``most`` features for the given ones. Equal centres join first; then centres join within a radius that doubles."""
    centre = total / n[:, None]
    _, same = np.unique(centre, axis=0, return_inverse=True)
    n, total, squares = _joined(same.ravel(), n, total, squares)
    radius = 0.0
    while len(n) > most:
        centre = total / n[:, None]
        if not radius:  # about the distance between neighbours, were the rows spread evenly
            radius = float(np.linalg.norm(np.ptp(centre, axis=0))) / len(n)
        label, heads = np.full(len(n), -1), []
        for i in range(len(n)):
            if label[i] < 0:
                near = (label < 0) & (((centre - centre[i]) ** 2).sum(1) <= radius * radius)
                label[near] = len(heads)
                heads.append(i)
                if len(heads) > most:
                    break
        if len(heads) <= most:
            n, total, squares = _joined(label, n, total, squares)
        radius *= 2
    return n, total, squares


def _joined(label: np.ndarray, n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = int(label.max()) + 1 if len(label) else 0
    summed = np.zeros((size, total.shape[1]))
    np.add.at(summed, label, total)
    return np.bincount(label, n, size), summed, np.bincount(label, squares, size)


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=float).reshape(rows, -1)


def _packed(part: int, n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> list[pa.Array]:
    return [pa.array([part] * len(n), pa.int64()), pa.array(n), pa.array(list(total), pa.list_(pa.float64())), pa.array(squares)]


def micro_clusters(points: DataFrame, most: int = MICRO) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and centres of at most ``most`` micro-clusters of the array column ``p``."""
    from pyspark import TaskContext

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            p = _matrix(batch.column(0), batch.num_rows)
            new = (np.ones(len(p)), p, (p**2).sum(1))
            held = condense(*(new if held is None else [np.concatenate(x) for x in zip(held, new)]), most)
        if held is not None:
            yield pa.RecordBatch.from_arrays(_packed(TaskContext.get().partitionId(), *held), names=["part", "n", "total", "squares"])

    def meet(table: pa.Table) -> pa.Table:
        rows = table.num_rows
        held = condense(table.column("n").to_numpy(), _matrix(table.column("total"), rows), table.column("squares").to_numpy(), most)
        return pa.Table.from_arrays(_packed(table.column("part")[0].as_py() // MEET, *held), names=["part", "n", "total", "squares"])

    # Dealt by value and sorted, so that the same rows give the same features whatever the files.
    dealt = points.select("p").repartition(F.xxhash64("p")).sortWithinPartitions("p")
    features = cut_lineage(dealt.mapInArrow(per_task, SCHEMA))
    while (features.agg(F.max("part")).first()[0] or 0) > 0 or features.count() > most:
        features = cut_lineage(features.groupBy(F.floor(F.col("part") / MEET)).applyInArrow(meet, SCHEMA))
    rows = features.collect()  # at most `most` rows
    n, total = np.array([r["n"] for r in rows]), np.array([r["total"] for r in rows])
    centres = total / n[:, None] if len(n) else np.zeros((0, 1))
    order = np.lexsort(centres.T[::-1]) if len(n) else []
    return n[order], centres[order]


def ward(n: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """Labels 0..k-1 of weighted centres: Ward's linkage by chains of nearest neighbours, cut at ``k`` clusters."""
    n, centres, size = n.astype(float).copy(), centres.astype(float).copy(), len(n)
    live, merges, chain = np.ones(size, bool), [], []
    while live.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(live)[0]))
        i = chain[-1]
        cost = n * n[i] / (n + n[i]) * ((centres - centres[i]) ** 2).sum(1)
        cost[~live] = np.inf
        cost[i] = np.inf
        j = int(cost.argmin())
        if len(chain) > 1 and cost[chain[-2]] <= cost[j]:
            j = chain[-2]
            merges.append((float(cost[j]), len(merges), i, j))
            chain = chain[:-2]
            centres[j] = (n[i] * centres[i] + n[j] * centres[j]) / (n[i] + n[j])
            n[j] += n[i]
            live[i] = False
        else:
            chain.append(j)
    above = list(range(size))

    def find(i: int) -> int:
        while above[i] != i:
            i = above[i]
        return i

    for _, _, i, j in sorted(merges)[: max(size - k, 0)]:
        a, b = find(i), find(j)
        above[max(a, b)] = min(a, b)
    heads = {h: c for c, h in enumerate(sorted({find(i) for i in range(size)}))}
    return np.array([heads[find(i)] for i in range(size)], dtype=int)


def agglomerative(points: DataFrame, k: int, most: int = MICRO) -> DataFrame:
    """``points`` (vector column ``point``) with ``cluster``: each row takes the cluster of its nearest micro-cluster."""
    vectors = points.withColumn("p", vector_to_array("point"))
    n, centres = micro_clusters(vectors, most)
    if not len(n):
        return points.withColumn("cluster", F.lit(None).cast("int"))
    labels = ward(n, centres, k)
    shipped = points.sparkSession.sparkContext.broadcast((centres, labels))

    @F.arrow_udf("int")
    def nearest(p: pa.Array) -> pa.Array:
        centres, labels = shipped.value
        x = _matrix(p, len(p))
        apart = np.zeros((len(x), len(centres)))
        for d in range(x.shape[1]):
            apart += np.subtract.outer(x[:, d], centres[:, d]) ** 2
        return pa.array(labels[apart.argmin(1)], pa.int32())

    return vectors.withColumn("cluster", nearest("p")).drop("p")
