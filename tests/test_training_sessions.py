"""Which models a training session fits, how it weighs classes, and that fits do not wait for one another."""

import threading

import pytest
from pyspark.sql import functions as F

from fieldbook import registry
from fieldbook.operators import models
from fieldbook.plans import training
from fieldbook.session import in_new_session, side_by_side

registry.load_all()
SF = "/root/testdata/sf0.001"


def test_best_models_come_from_all_kinds(spark, monkeypatch):
    fits = []

    def fit(frame, key, label, kind, exclude, trees=100, balanced_trees=False):
        fits.append((label, kind, trees, balanced_trees))
        return None, spark.range(1).select(F.lit(0.5).alias("auc"))

    monkeypatch.setattr(training, "fit_and_evaluate", fit)
    monkeypatch.setattr(models, "save", lambda *a: None)
    monkeypatch.setattr(training, "segment_session", lambda frame: spark.createDataFrame([("customer_segmentation", "kmeans", 0.4)], "family string, model string, metric double"))
    out = registry.QUERIES["ml23_best_models"](spark, SF)
    kinds = ("random_forest", "gradient_boosting", "logistic_regression")
    assert sorted(fits) == sorted((label, kind, 100, label == "churned") for label in ("converted", "churned", "is_won") for kind in kinds)
    assert {r["family"] for r in out.collect()} == {"lead_scoring", "churn_prediction", "predictive_analytics", "customer_segmentation"}


def test_balanced_forest_weighs_the_rare_class(spark):
    """Of equal rows one in ten is positive; balanced, either class has half of the weight."""
    rows = spark.range(0, 400, 1, 2).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    shares = []
    for weighed in (False, True):
        fitted = models.train_classifier(rows, "y", "random_forest", ["id"], trees=5, balanced_trees=weighed)
        shares.append(models.positive_probability(fitted.transform(rows), "p").agg(F.avg("p")).first()[0])
    assert shares[0] < 0.2 and 0.35 < shares[1] < 0.65


def test_fits_run_at_once_and_keep_their_order(spark):
    both = threading.Barrier(2, timeout=60)  # one after the other they would never meet here
    assert side_by_side(spark, [lambda: both.wait() >= 0 and "a", lambda: both.wait() >= 0 and "b", lambda: spark.range(3).count()]) == ["a", "b", 3]
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1, lambda: 1 / 0])


def test_training_rows_of_one_file_are_dealt_out(spark, tmp_path):
    """A table of deals is few splits, and all trees of a forest were grown there."""
    rows = spark.range(0, 60_000, 1, 1).select("id", F.when(F.col("id") % 9 > 0, F.col("id") % 9).alias("x"))
    got = in_new_session(rows, "dealt")
    cores = spark.sparkContext.defaultParallelism
    assert got.rdd.getNumPartitions() == cores and got.sparkSession is not spark
    assert got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2 * 60_000 / cores
    assert sorted(r["id"] for r in got.collect()) == list(range(60_000)) and got.collect() == got.collect()
    assert in_new_session(rows.limit(100), "few").rdd.getNumPartitions() == 1
