"""Training sessions: lead, churn, deal and segment models, their metrics, grades and storage."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators import clustering, crm, hierarchy, models, reports, rules
from fieldbook.session import cut_lineage, side_by_side, spread

IDENTITY = ["contact_id", "firstname", "lastname", "email", "phone", "company", "company_name", "owner_id", "created_epoch", "modified_epoch"]
# Columns that state the target.
LEAD_LEAKS = ["lifecyclestage", "lifecycle_stage_order"]
CHURN_LEAKS = [
    "days_since_last_activity", "days_since_modified", "inactivity_risk", "activity_frequency", "no_recent_deals",
    "low_engagement", "days_created_to_modified",
]
DEAL_FEATURES = ["amount", "stage_probability", "stage_order", "created_month", "created_quarter", "created_weekday", "days_since_created", "deal_size_category"]


def lead_frame(leads: DataFrame, as_of: dt.datetime, seed=None) -> DataFrame:
    """Lead features with qualification and the conversion target, stored once for all models."""
    features = rules.qualify(crm.lead_features(spread(leads), as_of), as_of, seed)
    return cut_lineage(features.withColumn("converted", crm.conversion_target(F.col("lifecyclestage"))))


def churn_frame(leads: DataFrame, as_of: dt.datetime, threshold_days: int = 90) -> DataFrame:
    features = crm.churn_features(crm.lead_features(spread(leads), as_of), threshold_days)
    return cut_lineage(crm.churn_target(features, threshold_days))


def fit_and_evaluate(frame: DataFrame, key: str, label: str, kind: str, exclude: Sequence[str], trees: int = 100, balanced_trees: bool = False) -> tuple[models.Trained, DataFrame]:
    train, test = models.split_by_hash(frame, key, label)
    fitted = models.train_classifier(train, label, kind, exclude, trees, balanced_trees)
    return fitted, models.evaluate(fitted.transform(test), label)


def score_leads(fitted: models.Trained, leads: DataFrame) -> DataFrame:
    scored = models.positive_probability(fitted.transform(leads), "lead_score")
    return reports.rank_leads(cut_lineage(scored.drop("features", "assembled", "rawPrediction", "probability")))


def score_churn(fitted: models.Trained, customers: DataFrame) -> DataFrame:
    scored = models.positive_probability(fitted.transform(customers), "churn_risk_score")
    return reports.rank_churn(cut_lineage(scored.drop("features", "assembled", "rawPrediction", "probability")))


def deal_models(deals: DataFrame, kind: str = "random_forest", trees: int = 100) -> dict[str, models.Trained]:
    """Closure classifier on closed deals, revenue regressor on won ones, time-to-close on closed ones."""
    keep = lambda df, *labels: df.select(*DEAL_FEATURES, *labels)
    closed = deals.where("is_closed")
    won = closed.where("is_won = 1")
    fits = {
        "closure": lambda: models.train_classifier(keep(closed, "is_won"), "is_won", kind, trees=trees),
        "revenue": lambda: models.train_regressor(keep(won.withColumn("revenue", F.col("amount")), "revenue"), "revenue", kind, ["amount"], trees),
        "time_to_close": lambda: models.train_regressor(keep(closed, "days_to_close"), "days_to_close", kind, trees=trees),
    }
    return dict(zip(fits, side_by_side(deals.sparkSession, list(fits.values())), strict=True))


def score_deals(fitted: dict[str, models.Trained], deals: DataFrame) -> DataFrame:
    """Closure probability and class, revenue, days to close and close date of each deal.

    Each model's result is stored before the next one runs, so that a stage holds one model.
    """
    extra = ["features", "assembled", "rawPrediction", "probability", "prediction"]
    drop = lambda df: df.drop(*extra, *[c for c in df.columns if c.endswith(("_filled", "_index", "_hot", "_code"))])
    out = cut_lineage(drop(models.positive_probability(fitted["closure"].transform(deals), "closure_probability")))
    out = cut_lineage(drop(fitted["revenue"].transform(out).withColumn("predicted_revenue", F.col("prediction"))))
    out = cut_lineage(drop(fitted["time_to_close"].transform(out).withColumn("predicted_days", F.col("prediction"))))
    return models.close_dates(out.withColumn("closure_likelihood", reports.score_category(F.col("closure_probability"))))


def segment(frame: DataFrame, k: int | None = None, most: int = 10) -> tuple[object, object, DataFrame]:
    """(reduction, model, labelled rows): k-means on the varied features with k chosen when not given."""
    features = clustering.varied_features(frame)
    reduction, points = clustering.reduce_features(frame, features)
    points = cut_lineage(points)
    vectors = cut_lineage(points.select("point"))  # every fit reads its rows anew, and a stored row is read whole
    if k is None:
        k, _ = clustering.choose_k(vectors, most)
    model, _ = clustering.kmeans(vectors, k)
    return reduction, model, clustering.named(model.transform(points))


def predict_segment(reduction, model, rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Segments of new rows through the stored scaling, reduction and centres."""
    ready = rows.withColumns({f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    out = model.transform(reduction.transform(ready))
    return clustering.named(out).drop("assembled", "scaled", "point", *[f"_{c}" for c in features])


def train_session(frame: DataFrame, key: str, label: str, kinds: Sequence[str], exclude: Sequence[str], root: str, session: str, family: str, trees: int = 100, balanced_trees: bool = False) -> DataFrame:
    """Fit, evaluate and store every kind; returns (family, model, metric) rows."""

    def one(kind: str) -> DataFrame:
        fitted, metrics = fit_and_evaluate(frame, key, label, kind, exclude, trees, balanced_trees)
        models.save(fitted, root, session, f"{family}-{kind}")
        return metrics.select(F.lit(family).alias("family"), F.lit(kind).alias("model"), F.col("auc").alias("metric"))

    return reduce(DataFrame.unionByName, side_by_side(frame.sparkSession, [partial(one, kind) for kind in kinds]))


def segment_session(frame: DataFrame) -> DataFrame:
    """(family, model, metric) of the segmentation: k-means with the chosen k against Ward's clusters of the same number, by silhouette."""
    _, model, labelled = segment(frame)
    labelled = cut_lineage(labelled.select("contact_id", "point", "cluster"))
    ward = cut_lineage(hierarchy.agglomerative(labelled.drop("cluster"), len(model.clusterCenters())))
    rows = [
        clustering.quality(rows).select(F.lit("customer_segmentation").alias("family"), F.lit(name).alias("model"), F.col("silhouette").alias("metric"))
        for name, rows in (("kmeans", labelled), ("hierarchical", ward))
    ]
    return rows[0].unionByName(rows[1])


def deal_session(deals: DataFrame, kinds: Sequence[str], root: str, session: str, trees: int = 100) -> DataFrame:
    """Closure models of every kind on closed deals: (family, model, metric) rows, models stored."""
    closed = cut_lineage(deals.where("is_closed").select("deal_id", "is_won", *DEAL_FEATURES))
    return train_session(closed, "deal_id", "is_won", kinds, ["deal_id", "stage_order"], root, session, "predictive_analytics", trees)
