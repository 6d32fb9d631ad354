"""Model queries. Scores depend on the algorithm, so these are checked by properties, not by SQL."""

from __future__ import annotations

import datetime as dt
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.operators import clustering, crm, hierarchy, models, reports
from fieldbook.plans import training
from fieldbook.registry import query
from fieldbook.registry.crm import LEADS, T, _deals, _leads
from fieldbook.session import cut_lineage, new_folder, side_by_side, spread

AS_OF = dt.datetime(2002, 1, 1)
SKIP = [*training.IDENTITY, *training.LEAD_LEAKS, "qualification_score"]


def _lead_frame(spark, sf):
    seed = (F.col("contact_id") * 37 % 1000) / 1000
    return training.lead_frame(_leads(spark, sf), AS_OF, seed)


def _churn_frame(spark, sf):
    # The data's modification dates lie within three years; the threshold splits them.
    return training.churn_frame(_leads(spark, sf), AS_OF, threshold_days=500)


def _segment_frame(spark, sf):
    frame = crm.segmentation_features(crm.lead_features(spread(_leads(spark, sf)), AS_OF))
    return cut_lineage(frame.withColumn("converted", crm.conversion_target(F.col("lifecyclestage"))))


@query("ml04_prepared_features")
def ml04(spark, sf):
    frame = _lead_frame(spark, sf)
    numeric, few, many = models.split_columns(frame, ["converted", *SKIP])
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    columns = (models.usable_numeric(frame, numeric), few, many)
    rows = models.prepared(frame, *columns, models.label_codes(frame, many))
    out = Pipeline(stages=models.feature_stages(*columns)).fit(rows).transform(rows)
    return out.select("contact_id", F.size(vector_to_array("features")).alias("features"))


@query("ml05_stratified_split", f"""WITH {LEADS}, l AS (SELECT contact_id, CASE WHEN lower(lifecyclestage) IN ('customer', 'opportunity') THEN 1 ELSE 0 END AS converted FROM features)
SELECT CASE WHEN CAST('0x' || substr(md5('42|' || converted || '|' || contact_id), 1, 12) AS BIGINT) % 10000 < 2000 THEN 'test' ELSE 'train' END AS side, converted, count(*) AS rows FROM l GROUP BY 1, 2""", T)
def ml05(spark, sf):
    train, test = models.split_by_hash(_lead_frame(spark, sf), "contact_id", "converted")
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return both.groupBy("side", "converted").agg(F.count(F.lit(1)).alias("rows"))


@query("ml06_lead_models")
def ml06(spark, sf):
    """Three classifiers, evaluated on the held-out part (also ML-08)."""
    frame = _lead_frame(spark, sf)

    def one(kind):
        _, metrics = training.fit_and_evaluate(frame, "contact_id", "converted", kind, SKIP)
        return metrics.select(F.lit(kind).alias("model"), "*")

    kinds = ("random_forest", "gradient_boosting", "logistic_regression")
    return reduce(DataFrame.unionByName, side_by_side(spark, [partial(one, kind) for kind in kinds]))


@query("ml07_grid_search")
def ml07(spark, sf):
    frame = _churn_frame(spark, sf)
    exclude = [*training.IDENTITY, *training.CHURN_LEAKS]
    _, table = models.grid_search(frame, "churned", "logistic_regression", models.full_grid("logistic_regression", frame.count()), exclude, folds=5)
    return table


@query("ml09_importance")
def ml09(spark, sf):
    frame = _lead_frame(spark, sf)
    fitted = models.train_classifier(frame, "converted", "random_forest", SKIP)
    return models.importance(fitted, frame)


@query("ml10_scored_leads")
def ml10(spark, sf):
    frame = _lead_frame(spark, sf)
    fitted = models.train_classifier(frame, "converted", "logistic_regression", SKIP)
    return training.score_leads(fitted, frame).select("contact_id", "lead_score", "score_decile", "lead_rank", "score_category")


@query("ml12_churn_scores")
def ml12(spark, sf):
    frame = _churn_frame(spark, sf)
    fitted = models.train_classifier(frame, "churned", "random_forest", [*training.IDENTITY, *training.CHURN_LEAKS], balanced_trees=True)
    out = training.score_churn(fitted, frame)
    return out.select("contact_id", "churn_risk_score", "churn_risk_category", "churn_risk_percentile", "high_churn_risk", "immediate_attention")


@query("ml14_kmeans")
def ml14(spark, sf):
    """Chosen k, then k-means on the principal components (also ML-17)."""
    _, _, labelled = training.segment(_segment_frame(spark, sf))
    return clustering.quality(cut_lineage(labelled))


@query("ml15_dbscan")
def ml15(spark, sf):
    frame = _segment_frame(spark, sf)
    _, points = clustering.reduce_features(frame, clustering.varied_features(frame))
    return clustering.density_clusters(points, "contact_id").groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"))


@query("ml16_hierarchical")
def ml16(spark, sf):
    frame = _segment_frame(spark, sf)
    _, points = clustering.reduce_features(frame, clustering.varied_features(frame))
    points = cut_lineage(points.select("contact_id", "point"))
    k, _ = clustering.choose_k(points)
    labelled = hierarchy.agglomerative(points, k)
    return clustering.named(labelled).groupBy("cluster", "cluster_name").agg(F.count(F.lit(1)).alias("rows"))


@query("ml18_predicted_segments")
def ml18(spark, sf):
    frame = _segment_frame(spark, sf)
    features = clustering.varied_features(frame)
    reduction, model, _ = training.segment(frame, k=4)
    out = training.predict_segment(reduction, model, frame, features)
    return reports.segment_business(out).join(reports.segment_sizes(out), "cluster")


@query("ml20_closure_model")
def ml20(spark, sf):
    deals = cut_lineage(_deals(spark, sf).where("is_closed").select("deal_id", "is_won", *training.DEAL_FEATURES))
    _, metrics = training.fit_and_evaluate(deals, "deal_id", "is_won", "random_forest", ["deal_id", "stage_order"])
    return metrics


@query("ml21_regressors")
def ml21(spark, sf):
    deals = cut_lineage(_deals(spark, sf).where("is_closed").select("deal_id", "days_to_close", "amount", *[c for c in training.DEAL_FEATURES if c != "amount"]))
    train, test = models.split_by_hash(deals.withColumn("side", F.lit(0)), "deal_id", "side")

    def one(kind, label):
        fitted = models.train_regressor(train, label, kind, ["deal_id", "side"])
        row = models.evaluate_regression(fitted.transform(test.where(F.col(label).isNotNull())), label)
        return row.select(F.lit(kind).alias("model"), F.lit(label).alias("target"), "*")

    kinds, labels = ("gradient_boosting", "random_forest", "linear_regression"), ("amount", "days_to_close")
    return reduce(DataFrame.unionByName, side_by_side(spark, [partial(one, kind, label) for kind in kinds for label in labels]))


@query("ml22_deal_outcomes")
def ml22(spark, sf):
    deals = cut_lineage(_deals(spark, sf))
    fitted = training.deal_models(deals)
    out = training.score_deals(fitted, deals.where("NOT is_closed"))
    return out.select("deal_id", "closure_probability", "closure_likelihood", "predicted_revenue", "predicted_days", "estimated_close")


@query("ml23_best_models")
def ml23(spark, sf):
    """Train the four families, store their models, and grade the best of each (also ML-24). Forests of churn weigh the classes alike."""
    root = new_folder(spark, "ml23")
    kinds = ("random_forest", "gradient_boosting", "logistic_regression")
    exclude = [*training.IDENTITY, *training.CHURN_LEAKS]
    families = [
        lambda: training.train_session(_lead_frame(spark, sf), "contact_id", "converted", kinds, SKIP, root, "s1", "lead_scoring"),
        lambda: training.train_session(_churn_frame(spark, sf), "contact_id", "churned", kinds, exclude, root, "s1", "churn_prediction", balanced_trees=True),
        lambda: training.deal_session(_deals(spark, sf), kinds, root, "s1"),
        lambda: training.segment_session(_segment_frame(spark, sf)),
    ]
    return models.best_models(cut_lineage(reduce(DataFrame.unionByName, side_by_side(spark, families))))


@query("r16_training_report")
def r16_training(spark, sf):
    """Report of a session that trains one family and segments."""
    root = new_folder(spark, "r16")
    lead = training.train_session(_lead_frame(spark, sf), "contact_id", "converted", ("logistic_regression",), SKIP, root, "s1", "lead_scoring")
    sessions = cut_lineage(lead.unionByName(training.segment_session(_segment_frame(spark, sf))))
    return reports.training_report(models.best_models(sessions), sessions)


@query("ml04_label_codes", f"""WITH {LEADS} SELECT contact_id, CAST(dense_rank() OVER (ORDER BY coalesce(company_state, 'Unknown')) - 1 AS DOUBLE) AS state_code,
  CAST(dense_rank() OVER (ORDER BY coalesce(domain, 'Unknown')) - 1 AS DOUBLE) AS domain_code FROM features""", T)
def ml04_codes(spark, sf):
    """Label codes of two text columns over all leads."""
    frame = _lead_frame(spark, sf)
    columns = ["company_state", "email_domain"]
    coded = models.prepared(frame, [], [], columns, models.label_codes(frame, columns))
    return coded.select("contact_id", F.col("company_state_code").alias("state_code"), F.col("email_domain_code").alias("domain_code"))


@query("ml24_stored_model")
def ml24(spark, sf):
    """A stored and reloaded model gives the scores of the original."""
    root = new_folder(spark, "ml24")
    frame = _lead_frame(spark, sf)
    fitted = models.train_classifier(frame, "converted", "logistic_regression", SKIP)
    models.save(fitted, root, "s1", "lead")
    again = models.load(spark, root, "s1", "lead")
    a = models.positive_probability(fitted.transform(frame), "a").select("contact_id", "a")
    b = models.positive_probability(again.transform(frame), "b").select("contact_id", "b")
    return a.join(b, "contact_id").agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("largest_difference"))
