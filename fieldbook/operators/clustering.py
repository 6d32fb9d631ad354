"""Customer segments: k-means with chosen k, density clusters, cluster quality."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators import kdtree
from fieldbook.operators.ranking import global_rank, quantile_values, top_n_per_key
from fieldbook.session import cut_lineage

SEED = 42
CANDIDATE_FEATURES = [
    "engagement_score", "company_maturity_score", "deal_activity_score", "recency_score", "lifecycle_score",
    "completeness_score", "days_since_created", "total_deals", "total_deal_value", "avg_deal_value", "company_size",
    "company_revenue",
]


def varied_features(df: DataFrame, candidates: Sequence[str] = CANDIDATE_FEATURES, minimum: float = 0.01) -> list[str]:
    """Available features whose deviation exceeds the minimum; two basic ones if fewer than two remain."""
    have = [c for c in candidates if c in df.columns]
    row = df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in have]).first()
    chosen = [c for c in have if (row[c] or 0) > minimum]
    return chosen if len(chosen) >= 2 else [c for c in ("days_since_created", "completeness_score") if c in df.columns]


def reduce_features(df: DataFrame, features: Sequence[str], variance: float = 0.95) -> tuple[PipelineModel, DataFrame]:
    """Scale, then keep the principal components that explain the wanted variance. Output column ``point``."""
    ready = df.withColumns({f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    base = Pipeline(
        stages=[
            VectorAssembler(inputCols=[f"_{c}" for c in features], outputCol="assembled"),
            StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True),
        ]
    ).fit(ready)
    scaled = base.transform(ready)
    n = len(features)
    if n > 3:
        full = PCA(k=n, inputCol="scaled", outputCol="point").fit(scaled)
        total, k = 0.0, 0
        for share in full.explainedVariance.toArray():
            total, k = total + share, k + 1
            if total >= variance:
                break
        k = max(2, min(k, n - 1))
        last = PCA(k=k, inputCol="scaled", outputCol="point").fit(scaled)
    else:
        last = VectorAssembler(inputCols=["scaled"], outputCol="point")
    model = PipelineModel(stages=[*base.stages, last])
    return model, model.transform(ready).drop("assembled", "scaled", *[f"_{c}" for c in features])


def choose_k(points: DataFrame, most: int = 10) -> tuple[int, list[tuple[int, float, float]]]:
    """k with the best silhouette if above 0.3, else the elbow of the within-cluster cost.

    Returns k and (k, cost, silhouette) for every k tried.
    """
    evaluator = ClusteringEvaluator(featuresCol="point", predictionCol="cluster")
    tried = []
    for k in range(2, most + 1):
        model = KMeans(k=k, seed=SEED, featuresCol="point", predictionCol="cluster").fit(points)
        labelled = model.transform(points)
        found = labelled.select("cluster").distinct().limit(2).count()
        tried.append((k, float(model.summary.trainingCost), float(evaluator.evaluate(labelled)) if found > 1 else 0.0))
    costs = [c for _, c, _ in tried]
    bends = [costs[i + 2] - 2 * costs[i + 1] + costs[i] for i in range(len(costs) - 2)]
    elbow = tried[min(bends.index(max(bends)) + 2, len(tried) - 1)][0] if bends else tried[0][0]
    best = max(tried, key=lambda t: t[2])
    return (best[0] if best[2] > 0.3 else elbow), tried


def kmeans(points: DataFrame, k: int) -> tuple[object, DataFrame]:
    model = KMeans(k=k, seed=SEED, featuresCol="point", predictionCol="cluster").fit(points)
    return model, model.transform(points)


def named(labelled: DataFrame) -> DataFrame:
    return labelled.withColumn("cluster_name", F.concat(F.lit("Segment_"), F.col("cluster").cast("string")))


def quality(labelled: DataFrame) -> DataFrame:
    """Silhouette, and the Calinski–Harabasz ratio from per-cluster sums: one pass over (cluster, dimension)."""
    sil = ClusteringEvaluator(featuresCol="point", predictionCol="cluster").evaluate(labelled)
    long = labelled.select("cluster", F.posexplode(vector_to_array("point")).alias("dim", "x"))
    per = long.groupBy("cluster", "dim").agg(F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    centre = per.groupBy("dim").agg((F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias("c"))
    sums = per.join(F.broadcast(centre), "dim").agg(  # one row per dimension
        F.sum(F.col("n") * F.col("v")).alias("within"), F.sum(F.col("n") * F.pow(F.col("m") - F.col("c"), 2.0)).alias("between"),
        F.countDistinct("cluster").alias("k"), F.sum(F.when(F.col("dim") == 0, F.col("n"))).alias("rows"),
    )
    ratio = (F.col("between") / (F.col("k") - 1)) / (F.col("within") / (F.col("rows") - F.col("k")))
    return sums.select(
        F.lit(float(sil)).alias("silhouette"), F.when((F.col("k") > 1) & (F.col("within") > 0), ratio).alias("calinski_harabasz"),
        F.col("k").alias("clusters"),
    )


# Density clusters -------------------------------------------------------------------------------


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Smallest reachable node of every node. Labels spread along edges and jump to their label's label until none changes;
    each round is written to the shared folder."""
    both = cut_lineage(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut_lineage(nodes.select(F.col("node"), F.col("node").alias("label")))
    while True:
        spread = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(spread, labels["node"] == spread["a"], "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("m", "label")).alias("label")
        )
        jump = lower.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        moved = cut_lineage(
            lower.join(jump, lower["label"] == jump["_n"], "left").select("node", "old", F.least("label", F.coalesce("_l", "label")).alias("label"))
        )
        labels = moved.select("node", "label")
        if moved.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def _least(d: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least of each row (all where there are fewer), the least first."""
    some = np.argpartition(d, k - 1, axis=1)[:, :k] if k < d.shape[1] else np.broadcast_to(np.arange(d.shape[1]), d.shape)
    return np.take_along_axis(some, np.take_along_axis(d, some, 1).argsort(axis=1, kind="stable"), 1)


def _kth(d: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Distance of each row to its k-th nearest column, counting columns by weight; infinite when there are fewer."""
    order = _least(d, k)
    upto = weight[order].cumsum(axis=1)
    enough = upto >= k
    at = np.where(enough.any(axis=1), enough.argmax(axis=1), -1)
    return np.where(at >= 0, np.take_along_axis(d, np.take_along_axis(order, np.maximum(at, 0)[:, None], 1), 1)[:, 0], np.inf)


def knn_distance(placed: DataFrame, levels: list[DataFrame], dims: int, k: int) -> DataFrame:
    """``k_distance`` of each ``spot``: to its k-th nearest row, itself included and copies counted.

    A spot's own leaf bounds the distance; then it looks into the leaves within its bound.
    """
    bound = lambda a, b: [a.column("spot"), _kth(kdtree.distances(a.p, b.p), b.column("w"), k)]
    bounds = cut_lineage(kdtree.meet(placed.withColumn("b", F.col("node")), placed, bound, "spot string, bound double"))
    bounded = placed.drop("w").join(bounds, "spot").withColumn("reach", F.col("bound"))
    asking = cut_lineage(kdtree.reached(bounded, cut_lineage(kdtree.boxes(placed, dims)), levels))

    def closest(a: kdtree.Side, b: kdtree.Side) -> list:
        d, w, limit = kdtree.distances(a.p, b.p), b.column("w"), a.column("bound")
        order = _least(d, k)
        near = np.take_along_axis(d, order, 1)
        keep = near <= limit[:, None]
        return [np.repeat(a.column("spot"), keep.sum(axis=1)), near[keep], w[order][keep]]

    met = kdtree.meet(asking, placed, closest, "spot string, d double, w bigint")
    lists = top_n_per_key(met, ["spot"], [F.col("d")], k).groupBy("spot").agg(F.array_sort(F.collect_list(F.struct("d", "w"))).alias("l"))
    state = F.aggregate(
        "l", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("d")),
        lambda s, x: F.struct((s["n"] + x["w"]).alias("n"), F.coalesce(s["d"], F.when(s["n"] + x["w"] >= k, x["d"])).alias("d")),
    )
    return lists.select("spot", state["d"].alias("k_distance"))


def _linked(side: kdtree.Side, eps: float) -> np.ndarray:
    """Number of the component of each row, rows within ``eps`` of each other being linked."""
    near, label = kdtree.distances(side.p, side.p) <= eps, np.full(len(side.p), -1)
    for n in range(len(label)):
        todo = [n] if label[n] < 0 else []
        while todo:
            i = todo.pop()
            if label[i] < 0:
                label[i] = n
                todo.extend(np.flatnonzero(near[i] & (label < 0)))
    return label


def density_clusters(points: DataFrame, key: str, eps: float | None = None, min_rows: int | None = None, leaf: int = kdtree.LEAF) -> DataFrame:
    """Density clusters of ``point`` vectors of any length: ``key`` and ``cluster``, numbered from 0.

    A row with ``min_rows`` rows within ``eps`` (itself included) is a core; cores within ``eps`` share a cluster; other rows
    within ``eps`` of a core join the nearest one's, and what is left joins the cluster of the nearest row that has one. Without
    ``eps`` the 90th percentile of the 4th-neighbour distance is used, without ``min_rows`` one fiftieth of the rows. Where
    there is no core at all, clusters are null.

    Equal vectors collapse to weighted spots, which lie in leaves of a kd tree; each meets the leaves
    within its reach, and clusters that cross leaves are joined as components of their links.
    """
    rows = cut_lineage(points.select(key, vector_to_array("point").alias("p")))
    first = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("p")).alias("dims")).first()
    n, dims = first["n"], first["dims"]
    if not n:
        return rows.select(key, F.lit(None).cast("int").alias("cluster"))
    min_rows = min_rows or max(2, n // 50)
    spots = cut_lineage(rows.groupBy("p").agg(F.min(F.col(key).cast("string")).alias("spot"), F.count(F.lit(1)).alias("w")))
    placed, levels = kdtree.partition(spots, dims, leaf)
    placed = cut_lineage(placed)
    if eps is None:
        weighted = knn_distance(placed, levels, dims, min(4, max(n - 1, 1))).join(spots.select("spot", "w"), "spot")
        eps = (quantile_values(weighted, "k_distance", [0.9], weight="w") or [0.0])[0]
        eps = eps if eps > 0 else 0.5

    def asked(rows: DataFrame, target: DataFrame, reach: float) -> DataFrame:
        """Rows once for each leaf of ``target`` within ``reach``."""
        return cut_lineage(kdtree.reached(rows.withColumn("reach", F.lit(float(reach))), cut_lineage(kdtree.boxes(target, dims)), levels))

    around = lambda a, b: [a.column("spot"), (kdtree.distances(a.p, b.p) <= eps) @ b.column("w")]
    counts = kdtree.meet(asked(placed.drop("w"), placed, eps), placed, around, "spot string, near bigint").groupBy("spot").agg(F.sum("near").alias("near"))
    core = cut_lineage(placed.join(counts.where(F.col("near") >= min_rows).select("spot"), "spot", "left_semi"))
    if core.isEmpty():
        return rows.select(key, F.lit(None).cast("int").alias("cluster"))

    def within(a: kdtree.Side, b: kdtree.Side) -> list:
        names = b.column("spot")
        return [names, names[_linked(b, eps)]]

    # a row for each leaf asks
    leaves = core.groupBy("node").agg(F.first("p").alias("p")).withColumn("b", F.col("node"))
    parts = kdtree.meet(cut_lineage(leaves), core, within, "spot string, part string")
    core = cut_lineage(core.join(parts, "spot"))

    def links(a: kdtree.Side, b: kdtree.Side) -> list:
        if not len(a.p) or not len(b.p):
            return [[], []]
        (x, i), (y, j) = (np.unique(side.column(name), return_inverse=True) for side, name in ((a, "asker"), (b, "part")))
        near = kdtree.distances(a.p, b.p) <= eps
        linked = np.zeros((len(x), len(y)), bool)
        for n in range(len(y)):
            linked[i[near[:, j == n].any(axis=1)], n] = True
        p, q = np.nonzero(linked)
        return [x[p], y[q]]

    askers = asked(core.select("p", "node", F.col("part").alias("asker")), core, eps).where("node < b")
    crossing = kdtree.meet(askers, core, links, "a string, b string")
    labels = components(crossing, core.select(F.col("part").alias("node")).distinct())
    core = cut_lineage(core.join(labels.withColumnRenamed("node", "part"), "part").select("spot", "p", "node", "label"))

    def closest(a: kdtree.Side, b: kdtree.Side) -> list:
        if not len(a.p) or not len(b.p):
            return [[], [], []]
        d, label = kdtree.distances(a.p, b.p), b.column("label")
        order = np.argsort(label, kind="stable")  # the least label among equally near ones
        at = order[d[:, order].argmin(axis=1)]
        return [a.column("spot"), d[np.arange(len(at)), at], label[at]]

    def joined(rest: DataFrame, target: DataFrame, reach: float) -> DataFrame:
        met = kdtree.meet(asked(rest, target, reach), target, closest, "spot string, d double, label string")
        best = met.where(F.col("d") <= reach).groupBy("spot").agg(F.min(F.struct("d", "label")).alias("b"))
        return rest.join(best, "spot").select("spot", "p", "node", F.col("b.label").alias("label"))

    rest = placed.join(core.select("spot"), "spot", "left_anti").select("spot", "p", "node")
    clustered = cut_lineage(core.unionByName(joined(rest, core, eps)))
    open_ = cut_lineage(rest.join(clustered.select("spot"), "spot", "left_anti"))
    settled, reach = clustered, float(eps)
    while not open_.isEmpty():  # ends, since the reach doubles until it spans all rows
        reach *= 2
        hit = cut_lineage(joined(open_, clustered, reach))
        settled, open_ = settled.unionByName(hit), cut_lineage(open_.join(hit.select("spot"), "spot", "left_anti"))
    out = rows.join(settled.select("p", "label"), "p", "left")
    numbers = global_rank(settled.select("label").distinct(), [F.col("label")], "_number")
    return out.join(numbers, "label", "left").select(key, (F.col("_number") - 1).cast("int").alias("cluster"))
