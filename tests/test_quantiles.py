import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook import registry
from fieldbook.operators import quantiles

registry.load_all()


def rows_of(seed):
    """Groups of many shapes: wide, with ties, one value, spread over many powers of two, negative, with nulls and a null key."""
    rng = np.random.default_rng(seed)
    groups = {
        "wide": rng.normal(0, 1e6, 900), "ties": rng.integers(0, 5, 700) * 1.5, "one": np.full(300, 7.25), "powers": 2.0 ** rng.uniform(-60, 60, 500),
        "near": 1000 + rng.uniform(0, 1e-9, 400), "few": rng.normal(5, 1, 9), None: -rng.uniform(0, 3, 600),
    }
    rows = [(k, float(v)) for k, values in groups.items() for v in values]
    return groups, rows + [("few", None), ("empty", None)]


@pytest.mark.parametrize("large,buckets", [(10**6, 4096), (100, 4096), (100, 3), (0, 16)])
def test_quantiles_of_groups(spark, monkeypatch, large, buckets):
    monkeypatch.setattr(quantiles, "BUCKETS", buckets)
    groups, rows = rows_of(3)
    df = spark.createDataFrame(rows, "k string, v double")
    probs = {"q0": 0.0, "q1": 0.25, "median": 0.5, "q9": 0.9, "top": 1.0}
    got = {r["k"]: r for r in quantiles.with_quantiles(df, ["k"], "v", probs, [F.count("v").alias("n")], large).collect()}
    assert set(got) == {*groups, "empty"} and got["empty"]["median"] is None
    for k, values in groups.items():
        assert got[k]["n"] == len(values)
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_plan_of_the_summary(spark):
    """One pass with a combined aggregate: no rows are ranged, sorted or stored."""
    plan = registry.QUERIES["a09_topography_summary"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 4 and "rangepartitioning" not in plan and "ExistingRDD" not in plan
