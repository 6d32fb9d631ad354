import numpy as np
from pyspark.sql import functions as F

from fieldbook.operators import ranking


def skewed(spark, n=3000):
    """A third of the rows share one key, and values repeat."""
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        (F.col("id") * 7919 % 101).cast("double").alias("v"),
    )


def test_global_rank_is_a_permutation(spark):
    rows = ranking.global_rank(skewed(spark), [F.desc("v"), F.col("id")], "r").collect()
    by_rank = sorted(rows, key=lambda r: r["r"])
    assert [r["r"] for r in by_rank] == list(range(1, 3001))
    assert [(-r["v"], r["id"]) for r in by_rank] == sorted((-r["v"], r["id"]) for r in rows)


def test_rank_within_hot_key(spark):
    rows = ranking.global_rank(skewed(spark), [F.col("v"), F.col("id")], "r", ["k"]).collect()
    for key in ("hot", "1", "49"):
        mine = sorted((r for r in rows if r["k"] == key), key=lambda r: r["r"])
        assert [r["r"] for r in mine] == list(range(1, len(mine) + 1))
        assert [(r["v"], r["id"]) for r in mine] == sorted((r["v"], r["id"]) for r in mine)


def test_exact_quantiles_per_key(spark):
    df = skewed(spark)
    got = {r["k"]: r for r in ranking.exact_quantiles(df, "v", {"a": 0.1, "m": 0.5, "z": 0.93}, ["k"]).collect()}
    data = df.toPandas()
    for key, group in data.groupby("k"):
        assert np.allclose([got[key]["a"], got[key]["m"], got[key]["z"]], np.quantile(group["v"], [0.1, 0.5, 0.93]))


def test_null_keys_and_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("a", 5.0)], "k string, v double")
    got = {r["k"]: r["m"] for r in ranking.exact_quantiles(df, "v", {"m": 0.5}, ["k"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_equal_scores_share_one_bucket(spark):
    df = spark.range(20).withColumn("s", F.lit(0.5))
    assert {r["b"] for r in ranking.quantile_bucket(df, "s", 10, "b").collect()} == {1}
    assert {r["r"] for r in ranking.dense_rank_desc(df, "s", "r").collect()} == {1}


def test_few_distinct_values_use_the_median_rule(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 0, 1, 2]], "v double")
    assert sorted(r["s"] for r in ranking.quantile_or_width_bucket(df, "v", "s", [1, 2, 3, 4, 5]).collect()) == [3, 3, 3, 5, 5]


def test_latest_by_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 0, "z")], "k string, t int, v string")
    assert {(r["k"], r["v"]) for r in ranking.latest_by(df, ["k"], ["t", "v"]).collect()} == {("a", "y"), ("b", "z")}
