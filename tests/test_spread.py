"""Rows of few files and keys of few values must not leave the work to a few tasks."""

from pyspark.sql import functions as F

from fieldbook import registry
from fieldbook.operators import clustering
from fieldbook.operators.ranking import with_group_size
from fieldbook.plans import training
from fieldbook.session import spread

registry.load_all()
from fieldbook.registry import learning  # noqa: E402


def one_file(spark, folder, rows):
    """Tables of one file and one split each, with a customer twice and one without a key."""
    k = F.col("id")
    segment = F.element_at(F.array(*map(F.lit, ("HOUSEHOLD", "MACHINERY", "BUILDING", "AUTOMOBILE", "FURNITURE"))), (k % 5 + 1).cast("int"))
    customer = spark.range(0, rows, 1, 1).select(k.alias("c_custkey"), segment.alias("c_mktsegment"), (k % 9000).cast("double").alias("c_acctbal"), (k % 25).cast("int").alias("c_nationkey"))
    odd = customer.where("c_custkey = 1").unionByName(customer.where("c_custkey = 2").withColumn("c_custkey", F.lit(None).cast("bigint")))
    customer.unionByName(odd).coalesce(1).write.parquet(f"{folder}/customer.parquet")
    spark.range(0, 60, 1, 1).select(k.alias("s_suppkey"), (k * 100.0).alias("s_acctbal"), (k % 25).cast("int").alias("s_nationkey")).write.parquet(f"{folder}/supplier.parquet")
    orders = spark.range(0, 600, 1, 1).select(
        k.alias("o_orderkey"), (k % 97).alias("o_custkey"), (k * 7.0).alias("o_totalprice"), F.lit("1997-01-01").cast("timestamp").alias("o_orderdate"), F.lit("O").alias("o_orderstatus"))
    orders.write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_leads_of_one_file_are_prepared_by_all_cores(spark, tmp_path):
    sf, cores = one_file(spark, tmp_path, 60_000), spark.sparkContext.defaultParallelism
    want = sorted(map(str, learning._leads(spark, sf).select("contact_id").collect()))
    for frame in (learning._lead_frame, learning._churn_frame, learning._segment_frame):
        got = frame(spark, sf)
        assert got.rdd.getNumPartitions() >= cores and sorted(map(str, got.select("contact_id").collect())) == want
        sizes = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert sizes < 2 * len(want) / cores


def test_few_rows_stay_where_they_are(spark):
    rows = spark.range(0, 50_000, 1, 2).withColumn("x", F.when(F.col("id") % 3 > 0, F.col("id")))
    assert spread(rows).rdd.getNumPartitions() == 2 and spread(rows).collect() == rows.collect()
    more = spark.range(0, 50_001, 1, 2).unionByName(spark.range(1))
    assert spread(more).collect() == spread(more).collect() and spread(more).count() == 50_002


def test_group_sizes_of_few_keys_are_broadcast(spark):
    """A shuffle by a key of three values leaves all rows in three tasks."""
    rows = spark.range(0, 1000, 1, 8).select("id", F.when(F.col("id") % 4 < 3, F.col("id") % 4).alias("k"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as where the planner takes the sizes for a large table
    try:
        out = with_group_size(rows, "k", "n")
        assert out.rdd.getNumPartitions() == 8
        assert sorted(map(tuple, out.select("k", "n").distinct().collect()), key=str) == [(0, 250), (1, 250), (2, 250), (None, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_fits_read_points_only(spark, monkeypatch):
    read, fit = [], clustering.kmeans
    monkeypatch.setattr(clustering, "kmeans", lambda points, k: read.append(points.columns) or fit(points, k))
    frame = spark.range(0, 200, 1, 2).select("id", F.lit("a name").alias("firstname"), *[(F.col("id") * n % 17).cast("double").alias(c) for n, c in enumerate(clustering.CANDIDATE_FEATURES[:5], 2)])
    _, _, labelled = training.segment(frame, 3)
    assert read == [["point"]] and {"id", "firstname", "point", "cluster", "cluster_name"} <= set(labelled.columns) and labelled.count() == 200
