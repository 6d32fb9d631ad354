"""Queries without SQL: each runs in one session with the others, and its result has the properties it must have."""

import pytest
from pyspark.sql import functions as F

from fieldbook import registry

registry.load_all()
SF = "/root/testdata/sf0.001"
#: By query: the key that must be unique, and columns that must lie between 0 and 1.
SHAPES = {
    "src04_county_files": (None, []),
    "ml04_prepared_features": (["contact_id"], []),
    "ml06_lead_models": (["model"], ["accuracy", "auc"]),
    "ml07_grid_search": (None, []),
    "ml09_importance": (None, ["importance"]),
    "ml10_scored_leads": (["contact_id"], ["lead_score"]),
    "ml12_churn_scores": (["contact_id"], ["churn_risk_score"]),
    "ml14_kmeans": (None, []),
    "ml15_dbscan": (["cluster"], []),
    "ml16_hierarchical": (["cluster"], []),
    "ml18_predicted_segments": (["cluster"], []),
    "ml20_closure_model": (None, ["accuracy", "auc"]),
    "ml21_regressors": (["model", "target", "metric"], []),
    "ml22_deal_outcomes": (["deal_id"], ["closure_probability"]),
    "ml23_best_models": (None, []),
    "ml24_stored_model": (None, []),
    "r16_training_report": (["section", "key"], []),
}


def test_every_query_without_sql_is_listed():
    assert set(SHAPES) == set(registry.QUERIES) - set(registry.ORACLES)


@pytest.mark.parametrize("name", SHAPES)
def test_properties(spark, name):
    keys, shares = SHAPES[name]
    out = registry.QUERIES[name](spark, SF).cache()
    assert out.count() > 0
    if keys:
        assert out.select(*keys).distinct().count() == out.count()
    for column in shares:
        if column in out.columns:
            assert out.where(~F.col(column).between(0, 1)).count() == 0
    if name == "ml24_stored_model":
        assert out.first()["largest_difference"] < 1e-9
    if name == "ml04_prepared_features":
        assert out.select("features").distinct().count() == 1
    if name == "ml22_deal_outcomes":
        assert out.where("predicted_days IS NULL OR predicted_revenue IS NULL").count() == 0
