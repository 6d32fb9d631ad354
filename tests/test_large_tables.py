"""Cases that only larger tables hold: odd clocks, wide joins, landed text."""

import math

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from fieldbook import registry
from fieldbook.functions import geo
from fieldbook.operators import crm, spatial, water
from fieldbook.session import new_folder, training_tasks
from fieldbook.sources import landing
from fieldbook.streaming import jobs

registry.load_all()
from fieldbook.registry import ingest  # noqa: E402
from fieldbook.registry.raw_documents import raw_documents  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_churn_features_of_a_change_after_the_clock(spark):
    cols = "contact_id int, days_since_modified bigint, days_since_created bigint, total_deals bigint, lifecycle_stage_order int, has_email boolean, has_phone boolean, completeness_score double, is_business_email boolean"
    rows = [(1, -1, 3, 2, 1, True, True, 0.5, True), (2, -1, 0, 0, 1, True, False, 0.5, True), (3, 1, 4, 1, 1, True, False, 0.5, True), (4, None, 4, 1, 1, True, False, 0.5, True)]
    out = crm.churn_target(crm.churn_features(spark.createDataFrame(rows, cols)))
    got = {r["contact_id"]: r for r in out.collect()}
    assert got[1]["activity_frequency"] == math.inf and math.isnan(got[2]["activity_frequency"])
    assert got[3]["activity_frequency"] == 2.0 and got[4]["activity_frequency"] is None
    assert got[1]["churned"] == 0 and got[1]["deal_momentum"] == 182.5


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def joins(df, kind, columns):
    return [line for line in plan(df).splitlines() if line.lstrip(" :+-").startswith(kind) and all(c in line for c in columns)]


def parcels(spark, rows):
    return spark.createDataFrame(rows, "parcel_id string, latitude double, longitude double, acres double")


PARCELS = [("a", 30.0, -100.0, 5.0), ("b", 30.1, -100.1, 7.0), ("b", 30.1, -100.1, 7.0), ("c", 47.0, -80.0, 1.0), (None, 30.0, -100.0, 2.0), ("d", None, None, 1.0)]


def test_wide_tables_are_never_collected_in_the_driver(spark):
    """The planner takes these tables for small, since sizes of files tell nothing of polygon sides and copies in cells."""
    box = geo.square_wkt(F.col("longitude"), F.col("latitude"), F.lit(0.1))
    shapes = parcels(spark, PARCELS).where("latitude IS NOT NULL").select("parcel_id", box.alias("wkt"))
    overlap = spatial.overlap_pairs(shapes, shapes.withColumnRenamed("parcel_id", "unit"), "parcel_id", "unit", 0.5)
    assert joins(overlap, "SortMergeJoin", ["_cy", "_cx"]) and not joins(overlap, "BroadcastHashJoin", ["_cy", "_cx", "Inner"])
    ranges = spatial.nearby_range(parcels(spark, PARCELS), "acres", 30)
    assert not joins(ranges, "BroadcastHashJoin", ["Inner"])
    assert {(r["parcel_id"], r["nearby_min"], r["nearby_max"], r["nearby_count"]) for r in ranges.collect()} == {
        ("a", 2.0, 7.0, 4), ("b", 2.0, 7.0, 4), ("c", 1.0, 1.0, 1), (None, 2.0, 7.0, 4)}
    near = spatial.radius_pairs(parcels(spark, PARCELS), parcels(spark, PARCELS), "parcel_id", 30)
    assert not joins(near, "BroadcastHashJoin", ["_cy", "Inner"]) and near.count() == 2 * 4 + 2 * 4 + 1 - 0


def test_nearest_sorts_no_pairs(spark):
    """A least distance with its key is sorted for; a least distance alone is kept in a hash table."""
    places = spark.createDataFrame([("s2", 30.0, -100.2), ("s1", 30.0, -99.8), (None, 47.5, -80.0), ("s9", 46.5, -80.0), ("s3", 30.0, -100.2)], "station_id string, latitude double, longitude double")
    near = spatial.nearest(parcels(spark, PARCELS), places, "parcel_id", "station_id")
    assert not joins(near, "BroadcastHashJoin", ["Inner"]) and "min(struct(distance_miles" not in plan(near)
    got = {(r["parcel_id"], r["station_id"]) for r in near.collect()}
    assert got == {("a", "s1"), (None, "s1"), ("b", "s2"), ("c", None)} or got == {("a", "s2"), (None, "s2"), ("b", "s2"), ("c", None)}
    assert near.count() == 5


def test_water_summary_by_places_equals_the_sorted_one(spark):
    cols = "right_id string, appropriation_date string, structure_name string, water_source string"
    rights = spark.createDataFrame([("r1", "1950-01-01", "B", "SURFACE"), ("r2", "1950-01-01", "A", "SURFACE"), ("r3", None, "C", None), ("r4", "1950-01-01", None, "GROUND"), ("r4", "1950-01-01", None, "GROUND"), ("r5", "1990-01-01", "A", "RESERVOIR")], cols)
    pairs = spark.createDataFrame([("a", "r1"), ("a", "r2"), ("a", "r2"), ("a", "r3"), ("b", "r3"), (None, "r4"), ("c", "r5"), ("c", "r4"), ("c", "r1")], "parcel_id string, right_id string")
    given, places = water.ranked(rights)
    want = water.summarise(pairs.join(rights, "right_id"))
    out = water.summarise(pairs.join(given, "right_id"), places=places)
    assert "SortAggregate" not in plan(pairs.join(given, "right_id").groupBy("parcel_id", "water_source").agg(F.min("seniority")))
    assert out.columns == want.columns and sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


def test_landed_documents_are_compressed_in_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(ingest, "DOCUMENTS_PER_FILE", 500)
    root = ingest._landed(spark, SF, "landed")
    files = landing.county_files(spark, [root], ingest.LANDED)
    rows = spark.read.option("recursiveFileLookup", True).text(root)
    plain = raw_documents(spark, SF).select(F.sum(F.length("raw_data") + 1)).first()[0]
    assert files.agg(F.sum("length")).first()[0] * 4 < plain
    assert rows.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 500
    assert sorted(r["value"] for r in rows.collect()) == sorted(r["raw_data"] for r in raw_documents(spark, SF).select("raw_data").collect())


def test_error_routing_keeps_no_batch(spark, monkeypatch):
    """A kept batch spills all its texts to disk."""
    root, kept = new_folder(spark, "routes"), []
    spark.createDataFrame([('{"id":"P1"}',), ("{",), ("{",), ("[]",)], "value string").write.text(f"{root}/in")
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(self) or self)
    jobs.route_errors(jobs.document_stream(spark, f"{root}/in", "*.txt"), f"{root}/good", f"{root}/bad", f"{root}/checkpoint").awaitTermination()
    assert not kept and [spark.read.parquet(f"{root}/{r}").count() for r in ("good", "bad")] == [2, 2]


@pytest.mark.parametrize("rows,tasks", [(0, 1), (50_000, 1), (90_000, 12), (900_000, 12), (5_400_000, 12), (60_000_000, 120)])
def test_training_tasks_follow_the_cores(rows, tasks):
    """Each task of a forest sends the figures of all nodes of a pass, so tasks must not grow with the rows alone."""
    assert training_tasks(rows, 12) == tasks
