"""Keys of ordinary size are numbered in windows over one shuffle; larger ones are cut into ranges, with the same rows."""

import json

import pytest
from pyspark.sql import functions as F

from fieldbook.functions.sql_functions import register_document_function
from fieldbook.operators import ranking, spatial, topography


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def line_points(spark):
    rows = [("a", n, 30.0 + n * n / 100, -100.0) for n in range(7)] + [("b", 1, 40.0, -90.0), ("b", 3, None, -90.0), ("b", 2, 40.0, -90.5), ("b", 4, 41.0, -90.0)]
    rows += [(None, 1, 30.0, -100.0), (None, 2, 31.0, -100.0), ("c", 1, 10.0, 10.0)]
    return spark.createDataFrame(rows, "line string, n int, latitude double, longitude double")


def test_profile_takes_one_shuffle(spark):
    out = spatial.elevation_profile(line_points(spark), "line", [F.col("n")])
    assert plan(out).count("Exchange") == 1 and "Join" not in plan(out)


@pytest.mark.parametrize("most", [0, 3, 4, 1_000_000])
def test_profile_of_long_and_short_lines(spark, monkeypatch, most):
    monkeypatch.setattr(ranking, "WINDOW_ROWS", most)
    out = spatial.elevation_profile(line_points(spark), "line", [F.col("n")])
    got = {(r["line"], r["n"]): (r["sequence"], r["distance_m"]) for r in out.collect()}
    assert {k: v[0] for k, v in got.items()} == {**{("a", n): n + 1 for n in range(7)}, **{("b", n): n for n in (1, 2, 3, 4)}, (None, 1): 1, (None, 2): 2, ("c", 1): 1}
    degree = 6371000.0 * 3.141592653589793 / 180
    for n in range(7):
        assert got["a", n][1] - got["a", 0][1] == pytest.approx(degree * n * n / 100, abs=0.5)
    whole = {(r["line"], r["n"]): r["distance_m"] for r in spatial._long_profile(line_points(spark), "line", [F.col("n")]).collect()}
    assert {k: v[1] for k, v in got.items()} == pytest.approx(whole)


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_ranks_with_keys_are_the_same_either_way(spark, monkeypatch, most):
    monkeypatch.setattr(ranking, "WINDOW_ROWS", most)
    rows = spark.range(0, 500, 1, 3).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("k"))
    got = ranking.global_rank(rows, [F.desc("id")], "r", ["k"]).collect()
    for k in (None, 1, 2, 3):
        mine = sorted((r for r in got if r["k"] == k), key=lambda r: r["r"])
        assert [r["r"] for r in mine] == list(range(1, 126)) and [r["id"] for r in mine] == sorted((r["id"] for r in mine), reverse=True)


def test_a_key_never_counts_as_smaller_than_it_is(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"))
    usual, crowded = ranking.by_key_size(rows, ["k"], most=33)
    assert {r["k"] for r in crowded.collect()} == {0} and usual.count() == 66
    assert ranking.by_key_size(rows, ["k"], most=34)[1] is None


def test_whole_documents_are_never_shuffled(spark, monkeypatch):
    """Points go to their parcel once; the summary joins them there, and so does a call of the table function."""
    points = spark.createDataFrame(
        [("p", n, float(n * 3 % 7), float(n), "US_Feet", "m", 2.0) for n in range(45)] + [("q", 1, 5.0, 6.0, "US_Feet", "m", 1.0), (None, 1, 5.0, 6.0, "US_Feet", "m", 1.0)],
        "parcel_id string, topo_id int, mean_elevation_ft double, max_elevation_ft double, elevation_units string, processing_method string, slope_degrees double")
    terrain = points.groupBy("parcel_id").agg(F.lit("level").alias("relief"))
    seen = {}
    for most in (1_000_000, 0):
        monkeypatch.setattr(ranking, "WINDOW_ROWS", most)
        docs = topography.whole_documents(points, terrain, [F.col("topo_id")], per_document=20)
        seen[most] = sorted(r["document"] for r in docs.collect())
        if most:
            kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
            try:
                docs = topography.whole_documents(points, terrain, [F.col("topo_id")], per_document=20)
                register_document_function(spark, "some_document", docs)
                called = spark.sql("SELECT p.parcel_id, d.document FROM {p} AS p, LATERAL some_document(p.parcel_id) AS d", p=points.select("parcel_id").distinct())
                assert not [x for x in plan(called).splitlines() if "Exchange" in x and "elevation_points" in x]
                assert [x for x in plan(called).splitlines() if "SortMergeJoin" in x] and called.count() == 4
            finally:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert seen[0] == seen[1_000_000] and len(seen[0]) == 5
    docs = [json.loads(d) for d in seen[0]]
    assert sorted(d["part"] for d in docs if d.get("parcel_id") == "p") == [0, 1, 2]
    assert [d["summary"]["elevation_points_count"] for d in docs if d.get("parcel_id") == "p" and d["part"] == 0] == [45]
    assert not [d for d in docs if d["part"] > 0 and ("summary" in d or "terrain_analysis" in d)]
    assert [p["topo_id"] for d in sorted((d for d in docs if d.get("parcel_id") == "p"), key=lambda d: d["part"]) for p in d["elevation_points"]] == list(range(45))
