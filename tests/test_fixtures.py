"""Small hand-written cases for parsing, staging, statistics, water rights, merges and streams."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fieldbook.functions import values
from fieldbook.operators import crops, crm, curation, landcover, merge, quality, rules, staging, water
from fieldbook.session import new_folder
from fieldbook.sources import landing, requests, responses, tables
from fieldbook.streaming import jobs

AS_OF = dt.datetime(2024, 6, 1)


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("text,want", [("12,345", 12345.0), ("142.5", 142.5), ("  88 ", 88.0), ("(D)", None), ("", None), (None, None), ("abc", None)])
def test_statistic_values(spark, text, want):
    assert one(spark, values.statistic_value(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("code,want", [("48463", ("48", "463")), ("6001", ("06", "001")), (None, (None, None)), ("abc", (None, None))])
def test_fips(spark, code, want):
    assert tuple(one(spark, values.fips_parts(F.lit(code).cast("string")))) == want
    assert tuple(one(spark, values.fips_parts(F.lit(None).cast("string"), F.lit(6), F.lit(1)))) == ("06", "001")


def test_state_and_day(spark):
    assert [one(spark, values.two_letter_state(F.lit(s).cast("string"))) for s in (" co ", "Texas", None)] == ["CO", None, None]
    assert one(spark, values.iso_day(F.lit("1920-05-31T00:00:00-06:00"))) == dt.date(1920, 5, 31)
    assert one(spark, values.iso_day(F.lit("not-a-date"))) is None


def records(spark, rows):
    cols = "county_name string, commodity_desc string, year int, value_text string, unit_desc string, short_desc string, source_desc string"
    return spark.createDataFrame([("A", *r) for r in rows], cols)


def test_headline_series_cases(spark):
    rows = [("CORN", y, v, "BU / ACRE", "CORN", "SURVEY") for y, v in [(2020, "120"), (2021, "(D)"), (2022, "130"), (2023, "140"), (2024, "1,250")]]
    rows += [("CATTLE", 2022, "40", "OPERATIONS", "CATTLE - OPERATIONS", "CENSUS"), ("CATTLE", 2022, "205", "HEAD", "CATTLE, COWS, BEEF - INVENTORY", "CENSUS"),
             ("CATTLE", 2022, "796", "HEAD", "CATTLE, INCL CALVES - INVENTORY", "CENSUS"), ("CATTLE", 2017, "812", "HEAD", "CATTLE, INCL CALVES - INVENTORY", "CENSUS")]
    rows += [("HAY", 2024, "22", "TONS / ACRE", "HAY SILAGE", "SURVEY")] + [("HAY", y, "220", "TONS / ACRE", "HAY GRAIN", "SURVEY") for y in (2022, 2023, 2024)]
    rows += [("WHEAT", 2023, "(D)", "BU / ACRE", "W", "SURVEY"), ("WHEAT", 2022, "(NA)", "BU / ACRE", "W", "SURVEY")]
    headline = crops.headline_series(records(spark, rows), ["county_name"])
    got = {}
    for r in headline.orderBy("period_rank").collect():
        got.setdefault(r["commodity_desc"], []).append((r["short_desc"], r["year"], r["value_numeric"]))
    assert [y for _, y, _ in got["CORN"]] == [2024, 2023, 2022] and got["CORN"][0][2] == 1250.0
    assert got["CATTLE"] == [("CATTLE, INCL CALVES - INVENTORY", 2022, 796.0), ("CATTLE, INCL CALVES - INVENTORY", 2017, 812.0)]
    assert {s for s, _, _ in got["HAY"]} == {"HAY GRAIN"} and "WHEAT" not in got
    doc = crops.yields_document(headline, ["county_name"]).first()["yields"]
    assert doc["CORN"]["latest"]["year"] == 2024 and doc["CORN"]["label"] == "corn"


def raw(spark, docs, ts=dt.datetime(2024, 5, 30)):
    rows = [(f"f{i}", 1, d if isinstance(d, str) else json.dumps(d), t, "bulk", "travis", 0, 1) for i, (d, t) in enumerate((d, ts) if not isinstance(d, tuple) else d for d in docs)]
    return spark.createDataFrame(rows, "file_name string, file_row_number long, raw_data string, ingestion_timestamp timestamp, ingestion_type string, county string, chunk_index long, parcel_count long")


GEO = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}


def test_document_shapes_and_salvage(spark):
    p = {"id": "a", "acres": 1}
    docs = [{"parcels": [p, p]}, [p], {"features": [p]}, {"results": [p]}, p, {"parcels": []}, '{"parcels": [', "5", {"parcels": None, "id": "b"}]
    flat = staging.flatten_parcels(raw(spark, docs)).groupBy("file_name").count().collect()
    assert {r["file_name"]: r["count"] for r in flat} == {"f0": 2, "f1": 1, "f2": 1, "f3": 1, "f4": 1, "f8": 1}
    lifted = landing.lift_fields(raw(spark, docs)).where("is_malformed").collect()
    assert [r["file_name"] for r in lifted] == ["f6"]


def test_aliases_flags_and_categories(spark):
    base = {"acres": 10, "geometry": GEO}
    docs = [
        {"id": "n", "fields": {"parval": 7}, **base}, {"id": "p", "parval": "8.5", **base}, {"id": "x", "assessed_value": None, "parval": 9, **base},
        {"acres": 1, "geometry": GEO}, {"id": "z", "acres": 0, "geometry": GEO}, {"id": "g", "acres": 1}, {"id": "b", "acres": "ten", "geometry": GEO},
    ]
    rows = {r["parcel_id"]: r for r in staging.stage_parcels(raw(spark, docs), AS_OF).collect()}
    assert [float(rows[k]["assessed_value"]) for k in "npx"] == [7.0, 8.5, 9.0]
    assert {k: rows[k]["data_quality_flag"] for k in "nzgb"} == {"n": "valid", "z": "invalid_acres", "g": "missing_geometry", "b": "invalid_acres"}
    assert None not in rows
    assert [one(spark, staging.size_category(F.lit(a))) for a in (1.0, 10.0, 100.0, 100.1)] == ["medium", "medium", "large", "very_large"]
    assert [one(spark, curation.value_category(F.lit(v))) for v in (49999, 50000, 200000, 500000, 500001)] == ["Low Value", "Medium Value", "Medium Value", "High Value", "Premium Value"]
    assert [one(spark, curation.valid_zip(F.lit(z))) for z in ("78701", " 7870", "7870A")] == ["78701", None, None]


def test_newest_ingestion_wins_and_old_rows_expire(spark):
    docs = [({"id": "a", "acres": a, "geometry": GEO}, t) for a, t in [(1, dt.datetime(2024, 5, 1)), (2, dt.datetime(2024, 5, 20)), (3, dt.datetime(2023, 1, 1))]]
    out = curation.curate_parcels(staging.stage_parcels(raw(spark, docs), AS_OF), AS_OF).collect()
    assert [r["acres"] for r in out] == [2.0] and out[0]["address"] == "Address Not Available"
    assert out[0]["parcel_wkt"].startswith("POLYGON((")


def test_land_cover_summary(spark):
    f = spark.createDataFrame([("p", 82, 60.0), ("p", 41, 30.0), ("p", 11, 10.0), ("q", 21, 0.05), ("q", 81, 99.95)], "parcel_id string, nlcd_code int, area double")
    detail = landcover.detail_rows(landcover.class_statistics(f), F.lit(1.0)).withColumns({"nlcd_year": F.lit(2021), "processing_method": F.lit("polygon")})
    rows = {r["parcel_id"]: r for r in landcover.parcel_summary(detail).collect()}
    p = rows["p"]
    assert (p["dominant_nlcd_code"], p["dominant_class_percentage"], p["agricultural_percentage"], p["natural_percentage"], p["total_classes_count"]) == (82, 60, 60, 40, 3)
    assert rows["q"]["total_classes_count"] == 1  # 0.05 % is not stored


def test_water_gate_and_summary(spark):
    parcels = spark.createDataFrame([("a", "TX", 1.0, 1.0), ("b", "CO", None, None), ("c", " co ", 1.0, 1.0), ("d", "CO", 1.0, 1.0)], "parcel_id string, state_code string, latitude double, longitude double")
    rights = spark.createDataFrame([("c", "1920-05-31", "Well", "groundwater"), ("c", "1985-01-01", "Ditch", "surface")], "parcel_id string, appropriation_date string, structure_name string, water_source string")
    rows = {r["parcel_id"]: r for r in water.status(parcels, rights).collect()}
    assert {k: r["reason"] for k, r in rows.items()} == {"a": "state_not_supported", "b": "no_coordinates", "c": "ok", "d": "no_rights_found"}
    assert (rows["c"]["most_senior_structure"], rows["c"]["rights_count"]) == ("Well", 2)


@pytest.mark.parametrize("xml,want", [("<r><Result>1</Result></r>", ("Corn", "Corn")), ("<r><Result>9</Result></r>", ("Unknown (9)", "Other")), ("<value>5</value", ("Soybeans", "Soybeans")), ("<r/>", (None, None))])
def test_crop_answers(spark, xml, want):
    row = responses.crop_answers(spark.createDataFrame([(xml,)], "x string"), "x").first()
    assert (row["crop_name"], row["crop_category"]) == want


@pytest.mark.parametrize("key,want", [("parcel:coords:35.0135:-80.7434", "coords_35.0135_-80.7434"), ("parcel:id:a:b", "a:b"), ("parcel:address:42", "address_42"), ("x:y", "x_y")])
def test_cache_keys(spark, key, want):
    assert one(spark, requests.parcel_of_cache_key(F.lit(key))) == want


def test_repaired_points(spark):
    for given in ([35.0, -97.0], [-97.0, 35.0]):
        assert tuple(one(spark, requests.repaired_point(F.array(*[F.lit(v) for v in given])))) == (35.0, -97.0)


def test_value_kinds_and_names(spark):
    kinds = [one(spark, crm.value_kind(F.lit(v).cast("string"))) for v in ("true", "12", "-3.5", '{"a":1}', "", None, "x", "{x")]
    assert kinds == ["boolean", "integer", "number", "json", "empty", "empty", "string", "string"]
    assert crm.type_of_name("country") == "string" and crm.type_of_name("phone_number") == "string" and crm.type_of_name("deal_count") == "double"
    assert one(spark, F.date_format(crm.epoch_millis(F.lit("1704067200000")), "yyyy-MM-dd HH:mm")) == "2024-01-01 00:00"


@pytest.mark.parametrize("size,want", [(0, None), (10, "Micro"), (10.01, "Small"), (50, "Small"), (1000, "Large")])
def test_right_closed_bins(spark, size, want):
    assert one(spark, values.right_closed_bin(F.lit(size), crm.SIZE_EDGES, crm.SIZE_LABELS)) == want


def test_whole_days_floor(spark):
    late, early = F.lit(dt.datetime(2024, 1, 3, 1)), F.lit(dt.datetime(2024, 1, 1, 23))
    assert one(spark, values.whole_days(late.cast("timestamp"), early.cast("timestamp"))) == 1


def test_rule_with_unknown_input_passes(spark):
    df = spark.createDataFrame([(0.9, 0.9, None, None, None, None, 0, None)], "lead_score double, churn_risk_score double, lifecyclestage string, days_since_created int, days_since_last_activity int, engagement_score double, total_deals int, predicted_segment string").withColumn("completeness_score", F.lit(None).cast("double"))
    row = rules.recommend(df).first()
    assert row["primary_strategy"] == "churn_prevention" and "data_enrichment" in row["applicable_rules"]


def test_upsert_is_idempotent_and_ignores_key_case(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "id int, v string, t int")
    s = spark.createDataFrame([(2, "c", 2), (3, "d", 2), (3, "e", 3)], "id int, v string, t int")
    first = merge.upsert(t, s, ["ID"], newest=["t"])
    again = merge.upsert(first, s, ["ID"], newest=["t"])
    want = {(1, "a", 1), (2, "c", 2), (3, "e", 3)}
    assert {tuple(r) for r in first.collect()} == want == {tuple(r) for r in again.collect()}


def test_replace_removes_rows_of_empty_result(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    out = merge.replace_by_key(old, spark.createDataFrame([(1,)], "k int"), old.limit(0), "k")
    assert [tuple(r) for r in out.collect()] == [(2, "y")]


def test_merge_rewrites_only_what_it_touches(spark):
    """Partitions without a changed key keep their files; merging twice gives the same table."""
    import pathlib

    root = new_folder(spark, "test")
    rows = spark.range(500).selectExpr("id", "0 AS t", "'old' AS v")
    tables.merge_into(rows, root, ["id"], ["t"])
    files = lambda: {p.parent.name: {f.name for f in p.parent.glob("*.parquet")} for p in pathlib.Path(root.removeprefix("file:")).glob("*/*.parquet")}
    before, changes = files(), spark.createDataFrame([(7, 1, "new"), (900, 1, "new"), (7, 0, "older")], "id bigint, t int, v string")
    for _ in range(2):
        tables.merge_into(changes, root, ["id"], ["t"])
        got = {r["id"]: r["v"] for r in tables.read_table(spark, root).collect()}
        assert len(got) == 501 and got[7] == got[900] == "new" and got[8] == "old"
    after = files()
    assert 0 < sum(after[b] != before.get(b) for b in after) <= 2


def test_chunks(spark):
    df = spark.range(1001).select(F.lit("x").alias("county"), "id")
    got = sorted((r["chunk_index"], r["parcel_count"], r["total_chunks"]) for r in tables.chunk_documents(df, "county", ["id"], 500).collect())
    assert got == [(0, 500, 3), (1, 500, 3), (2, 1, 3)]


@pytest.mark.parametrize("bad,want", [(4, None), (6, "WARNING"), (11, "CRITICAL")])
def test_alerts(spark, bad, want):
    q = spark.createDataFrame([("c", bad, 100)], "county string, error_records int, total_records int")
    row = quality.error_alerts(q).first()
    assert (row and row["severity"]) == want


def test_frame_report(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (2, "x", None)], "id int, email string, z string")
    r = quality.frame_report(df, "id", ["email"]).first()
    assert (r["duplicate_ids"], r["empty_columns"], r["sparse_required"]) == (1, "z", "email")


def test_late_change_does_not_win(spark):
    root = new_folder(spark, "late")
    schema = "id int, t int, v string"
    for i, row in enumerate([(1, 5, "new"), (1, 3, "old")]):
        spark.createDataFrame([row], schema).write.mode("append").parquet(f"{root}/in")
        stream = jobs.file_stream(spark, f"{root}/in", spark.createDataFrame([], schema).schema, pattern="*.parquet")
        jobs.stream_upsert(stream, f"{root}/t", ["id"], ["t"], f"{root}/c").awaitTermination()
    assert [r["v"] for r in tables.read_table(spark, f"{root}/t").collect()] == ["new"]


def test_quota_flag(spark):
    ev = spark.range(1003).select(F.lit("k").alias("key"), F.timestamp_seconds(F.when(F.col("id") < 1000, 1704067200 + F.col("id")).otherwise(1704070800)).alias("ts"))
    rows = {r["requests"]: r["exhausted"] for r in jobs.hourly_quota(ev, "ts", "key").collect()}
    assert rows == {1000: True, 3: False}
