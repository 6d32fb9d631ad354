"""What building, parsing and curating documents leaves to the JVM and to the shuffle."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from fieldbook.operators import curation, staging
from fieldbook.plans import merges
from fieldbook.registry.parcels import curated, p10
from fieldbook.registry.raw_documents import raw_documents

SF = "/root/testdata/sf0.001"
AS_OF = dt.datetime(2002, 1, 1)
ODD = [
    '{"id":"A","acres":"12.5","geometry":{"type":"Point"},"land_use_description":7,"fields":{"parval":"9"}}',
    '{"id":"B","acres":[1],"fields":"none"}',
    '[{"id":"C","land_use_description":{"a":1}},{"acres":3},null]',
    '{"results":[{"id":"D","land_use_description":"farm"}]}',
    '{"parcels":[{"id":"E"',
    "{}",
    None,
]


def documents(spark, texts):
    schema = "file_name string, file_row_number long, raw_data string, ingestion_timestamp timestamp, ingestion_type string, county string, chunk_index long, parcel_count long"
    rows = [(f"f{i}", i, text, dt.datetime(2001, 12, 1 + i), "bulk", "c", 0, 1) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def test_generated_methods_are_small_enough_to_be_compiled(spark):
    debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        prepared = raw_documents(spark, SF)._jdf.queryExecution().executedPlan()
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(prepared))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sizes and max(sizes) < 8000


def test_unused_fields_are_not_read(spark):
    plan = p10(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan and "land_use_description" in plan
    assert "StructField(acres,StringType" not in plan.split("from_json", 1)[1]


@pytest.mark.parametrize("fields", [["parcel_id"], ["land_use_description"], ["acres", "assessed_value", "geometry_json"], []])
def test_fewer_fields_give_the_same_rows(spark, fields):
    docs = documents(spark, ODD)
    every = staging.extract_fields(staging.flatten_parcels(docs))
    some = staging.extract_fields(staging.flatten_parcels(docs, fields), fields)
    order = ["file_name", "parcel_index_in_chunk"]
    assert some.orderBy(*order).collect() == every.select(*some.columns).orderBy(*order).collect()
    assert some.count() > 4


def test_unused_columns_are_not_shuffled(spark):
    plan = curated(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    kept = next(line for line in plan.splitlines() if "Aggregate" in line)
    assert "max_by" in kept and "geometry_json" not in kept and "tax_amount" not in kept


def test_named_columns_of_the_profile_are_the_same(spark):
    shape = '{{"id":"P{}","acres":{},"assessed_value":{},"land_use_description":"ranch","property_type":" Retail ","geometry":"g"}}'
    docs = documents(spark, [shape.format(i % 3, i + 1, 1000 * i) for i in range(9)])
    staged = staging.stage_parcels(docs, AS_OF, None)
    every = curation.curate_parcels(staged, AS_OF)
    for names in (["parcel_id", "investment_potential"], ["parcel_hash", "parcel_wkt", "parcel_id"], every.columns):
        some = curation.curate_parcels(staged, AS_OF, names)
        assert some.columns == names
        assert some.orderBy("parcel_id").collect() == every.select(*names).orderBy("parcel_id").collect()
    newest = {r["parcel_id"]: r["acres"] for r in every.select("parcel_id", F.col("acres")).collect()}
    assert newest == {"P0": 7.0, "P1": 8.0, "P2": 9.0}


def test_versions_of_a_merge_are_shuffled_once(spark):
    text = '{"parcels":[{"id":"A","acres":1},{"id":"B","acres":2}]}'
    docs = documents(spark, [text, text, '{"id":"A","acres":5}', '{"id":"A","acres":5}'])
    docs = docs.withColumn("ingestion_timestamp", F.lit(AS_OF))
    source = merges.merge_source(docs, AS_OF, None)
    assert source.count() == 3
    target = source.limit(0).withColumn("updated_at", F.lit(None).cast("timestamp"))
    merged = merges.curated_merge(target, docs, AS_OF, None)
    assert {r["parcel_id"]: r["acres"] for r in merged.collect()} == {"A": 5.0, "B": 2.0}
    assert merged.select("parcel_id", "acres")._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
