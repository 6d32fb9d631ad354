import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from fieldbook.operators import clustering, hierarchy, kdtree, models


def blobs(spark, copies=60):
    rng = np.random.default_rng(4)
    points = np.vstack([rng.normal((0, 0), 0.3, (80, 2)), rng.normal((6, 6), 0.3, (80, 2)), np.tile([[3.0, -5.0]], (copies, 1)), [[20.0, 20.0]]])
    rows = [(i, Vectors.dense(p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, ["id", "point"]), points


def brute_dbscan(points, eps, least):
    """Cores by definition; border rows go to the nearest core, the rest to the nearest row that has a cluster."""
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    core = (d <= eps).sum(1) >= least
    label = np.full(len(points), -1)
    n = 0
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if label[j] < 0:
                label[j] = n
                todo += [k for k in np.flatnonzero((d[j] <= eps) & core) if label[k] < 0]
        n += 1
    cores = np.flatnonzero(core)
    for i in np.flatnonzero(~core):
        near = d[i][cores]
        if near.min() <= eps:
            label[i] = label[cores[near.argmin()]]
    clustered = np.flatnonzero(label >= 0)
    for i in np.flatnonzero(label < 0):
        label[i] = label[clustered[d[i][clustered].argmin()]]
    return label


def same_groups(got, want):
    pairs = set(zip(got, want))
    return len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


@pytest.mark.parametrize("eps,least,leaf", [(0.25, 4, 2000), (0.5, 10, 20), (0.25, 4, 7)])
def test_density_clusters_match_brute_force(spark, eps, least, leaf):
    df, points = blobs(spark)
    got = {r["id"]: r["cluster"] for r in clustering.density_clusters(df, "id", eps, least, leaf).collect()}
    assert None not in got.values()
    assert same_groups([got[i] for i in range(len(points))], brute_dbscan(points, eps, least))


@pytest.mark.parametrize("dims,leaf", [(2, 40), (5, 60), (12, 50)])
def test_density_clusters_of_many_components(spark, dims, leaf):
    """Clusters that cross many leaves, with eps taken from the data."""
    rng = np.random.default_rng(dims)
    points = np.vstack([rng.normal(c, 0.4, (90, dims)) for c in (0, 5, 9)] + [rng.uniform(-4, 14, (12, dims)), np.full((30, dims), 2.5)])
    df = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in enumerate(points)], ["id", "point"])
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    eps = np.quantile(np.sort(d, axis=1)[:, 3], 0.9)
    spots = df.select(vector_to_array("point").alias("p"), F.col("id").cast("string").alias("spot"), F.lit(1).cast("bigint").alias("w")).dropDuplicates(["p"])
    placed, levels = kdtree.partition(spots, dims, leaf)
    assert placed.groupBy("node").count().agg(F.max("count")).first()[0] <= leaf and levels
    got = {r["id"]: r["cluster"] for r in clustering.density_clusters(df, "id", leaf=leaf).collect()}
    assert same_groups([got[i] for i in range(len(points))], brute_dbscan(points, eps, max(2, len(points) // 50)))


def test_a_far_row_does_not_take_its_leaf_along(spark):
    """Each row asks the leaves within its own reach: one with a wide reach must not send the rest of its leaf to all others."""
    rng = np.random.default_rng(1)
    points = rng.uniform(0, 1, (600, 3))
    rows = [(str(i), [float(x) for x in p], 1) for i, p in enumerate(points)]
    placed, levels = kdtree.partition(spark.createDataFrame(rows, "spot string, p array<double>, w bigint"), 3, 40)
    boxes = {r["node"]: (np.array(r["low"]), np.array(r["high"])) for r in kdtree.boxes(placed, 3).collect()}
    reach = {str(i): 0.9 if i % 60 == 0 else 0.02 for i in range(600)}
    asking = placed.withColumn("reach", F.when(F.col("spot").cast("int") % 60 == 0, 0.9).otherwise(0.02))
    got = sorted((r["spot"], r["b"]) for r in kdtree.reached(asking, kdtree.boxes(placed, 3), levels).collect())
    apart = lambda p, low, high: np.sqrt((np.maximum(np.maximum(low - p, p - high), 0) ** 2).sum())
    assert len(boxes) > 15 and got == sorted((str(i), b) for i, p in enumerate(points) for b, box in boxes.items() if apart(p, *box) <= reach[str(i)])


@pytest.mark.parametrize("k", [1, 3, 7, 9])
def test_kth_distance_counts_copies(k):
    rng = np.random.default_rng(k)
    d, weight = rng.integers(0, 5, (50, 7)).astype(float), rng.integers(1, 3, 7)
    want = [(sorted(np.repeat(row, weight)) + [np.inf] * k)[k - 1] for row in d]
    assert clustering._kth(d, weight, k).tolist() == want


def test_density_clusters_of_little(spark):
    df, _ = blobs(spark)
    assert clustering.density_clusters(df.limit(0), "id").collect() == []
    assert {r["cluster"] for r in clustering.density_clusters(df.limit(5), "id", 1e-6, 4).collect()} == {None}


def test_components(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "a string, b string")
    nodes = spark.createDataFrame([(n,) for n in "abcdef"], "node string")
    got = {r["node"]: r["label"] for r in clustering.components(edges, nodes).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "f": "f"}


def test_kmeans_quality(spark):
    df, _ = blobs(spark)
    _, labelled = clustering.kmeans(df, 3)
    q = clustering.quality(labelled).first()
    assert q["silhouette"] > 0.8 and q["calinski_harabasz"] > 100 and q["clusters"] == 3


def brute_ward(points, k):
    """Joins the two clusters that cost least until k are left."""
    groups = [[i] for i in range(len(points))]
    while len(groups) > k:
        centre, size = [points[g].mean(0) for g in groups], [len(g) for g in groups]
        costs = [
            (size[i] * size[j] / (size[i] + size[j]) * ((centre[i] - centre[j]) ** 2).sum(), i, j)
            for i in range(len(groups)) for j in range(i)
        ]
        _, i, j = min(costs)
        groups[j] += groups.pop(i)
    label = np.zeros(len(points), int)
    for n, g in enumerate(groups):
        label[g] = n
    return label


@pytest.mark.parametrize("k", [2, 3, 5, 9])
def test_agglomerative_equals_the_dendrogram(spark, k):
    rng = np.random.default_rng(k)
    points = np.vstack([rng.normal(0, 3, (60, 3)), np.tile(rng.normal(0, 3, (1, 3)), (8, 1))])
    df = spark.createDataFrame([(i, Vectors.dense(p)) for i, p in enumerate(points)], ["id", "point"])
    got = {r["id"]: r["cluster"] for r in hierarchy.agglomerative(df, k).collect()}
    assert same_groups([got[i] for i in range(len(points))], brute_ward(points, k))


def test_agglomerative_over_few_micro_clusters(spark):
    """Far more rows than micro-clusters: blobs come out whole, and the features stay within their number."""
    df, points = blobs(spark)
    many = df.crossJoin(spark.range(30).withColumnRenamed("id", "copy")).select((F.col("id") * 100 + F.col("copy")).alias("id"), "point")
    n, centres = hierarchy.micro_clusters(many.select(vector_to_array("point").alias("p")), 25)
    assert len(n) <= 25 and n.sum() == many.count()
    got = {r["id"]: r["cluster"] for r in hierarchy.agglomerative(many, 4, 25).collect()}
    want = np.repeat([0, 1, 2, 3], [80, 80, len(points) - 161, 1])
    assert same_groups([got[i * 100] for i in range(len(points))], want)
    assert hierarchy.agglomerative(df.limit(0), 3).collect() == []


def test_classifier_learns_and_reloads(spark):
    from fieldbook.session import new_folder

    df = spark.range(400).select("id", (F.col("id") % 2).alias("y"), (F.col("id") % 2 + F.rand(1) * 0.8).alias("x"), F.when(F.col("id") % 7 != 0, "a").alias("c"))
    train, test = models.split_by_hash(df, "id", "y")
    assert 0.1 < test.count() / 400 < 0.3 and train.join(test, "id").count() == 0
    fitted = models.train_classifier(train, "y", "logistic_regression", ["id"])
    assert models.evaluate(fitted.transform(test), "y").first()["auc"] > 0.95
    root = new_folder(spark, "model")
    models.save(fitted, root, "s", "m")
    again = models.load(spark, root, "s", "m")
    assert again.transform(test.drop("c")).count() == test.count()
    assert models.importance(fitted, df).count() >= 2


def test_models_work_in_a_session_that_observes(spark):
    """Observed metrics stay in the session; models fitted afterwards still reach the tasks, in a search too."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(5).observe(seen, F.count("id").alias("n")).collect()
    assert seen.get["n"] == 5
    df = spark.range(200).select("id", (F.col("id") % 2).alias("y"), (F.col("id") % 2 + F.rand(1)).alias("x"), F.concat(F.lit("v"), (F.col("id") % 40).cast("string")).alias("t"))
    for kind in ("logistic_regression", "random_forest"):
        fitted = models.train_classifier(df, "y", kind, ["id"], trees=3)
        assert fitted.transform(df).select("prediction").distinct().count() == 2
    best, table = models.grid_search(df, "y", "logistic_regression", {"regParam": [0.0, 0.1]}, ["id"], folds=2)
    assert table.count() == 2 and best.transform(df).count() == 200


def test_label_codes(spark):
    """Codes follow the order of the text; null is a value; values that training did not see come after the last."""
    df = spark.createDataFrame([("b", "x"), ("a", None), (None, "y"), ("c", "x")], "s string, t string")
    codes = models.label_codes(df, ["s", "t"])
    assert {(r["column"], r["value"]): r["code"] for r in codes.table.collect()} == {
        ("s", "Unknown"): 0, ("s", "a"): 1, ("s", "b"): 2, ("s", "c"): 3, ("t", "Unknown"): 0, ("t", "x"): 1, ("t", "y"): 2,
    }
    new = models.prepared(spark.createDataFrame([("z", "x"), (None, None)], "s string, t string"), [], [], ["s", "t"], codes)
    assert sorted(tuple(r) for r in new.select("s_code", "t_code").collect()) == [(0.0, 0.0), (4.0, 1.0)]
    assert models.label_codes(df, []).sizes == {}


def test_grades():
    assert [models.grade(m) for m in (0.95, 0.85, 0.75, 0.65, 0.5)] == [95, 85, 75, 65, 50]
    assert [models.grade_clusters(k) for k in (5, 3, 9, 1)] == [90, 80, 70, 50]
