"""Landing files, service responses, requests, streams and merges from raw documents.

Queries that need files write the given tables in the landed form first, into the shared folder.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.functions import values
from fieldbook.operators.merge import replace_by_key
from fieldbook.plans import merges
from fieldbook.registry import query
from fieldbook.registry.raw_documents import AS_OF, parcel_sql, raw_documents
from fieldbook.registry.tables import base, spread, table
from fieldbook.session import new_folder
from fieldbook.registry.space import NEAREST
from fieldbook.sources import catalog, landing, requests, responses, tables as store
from fieldbook.streaming import jobs

FILE_NAME = "'raw/parcels/county_' || (l_suppkey % 50) || '/o' || l_orderkey || '_p' || l_partkey || '_s' || l_suppkey || '.json'"


#: About 70 MB of text, 7 MB compressed.
DOCUMENTS_PER_FILE = 100_000
#: Names of landed files.
LANDED = "*.txt*"


def _landed(spark, sf, label):
    """The raw documents as line-delimited JSON files under four county folders, compressed and of bounded size.

    A compressed file is read by one task, so a file ends after DOCUMENTS_PER_FILE documents.
    """
    root = new_folder(spark, label)
    docs = raw_documents(spark, sf).withColumn("bucket", F.concat(F.lit("c"), (F.length("raw_data") % 4).cast("string")))
    docs.select("bucket", "raw_data").write.partitionBy("bucket").option("compression", "gzip").option("maxRecordsPerFile", DOCUMENTS_PER_FILE).text(f"{root}/landed")
    return f"{root}/landed"


@query("src01_landing_scan", """SELECT count(*) AS documents, count(*) FILTER (WHERE l_orderkey % 37 = 36) AS malformed,
  CAST(sum(CASE WHEN l_orderkey % 37 = 36 THEN 0 WHEN l_partkey % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS parcels, true AS numbered FROM lineitem""")
def src01(spark, sf):
    docs = landing.scan_documents(spark, _landed(spark, sf, "src01"), pattern=LANDED)
    per_file = docs.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n"), F.max("file_row_number").alias("last"), F.sum("parcel_count").alias("p"),
        F.count_if(F.col("is_malformed")).alias("bad"), F.count_distinct("file_row_number").alias("d"),
    )
    return per_file.agg(
        F.sum("n").alias("documents"), F.sum("bad").alias("malformed"), F.sum("p").alias("parcels"),
        F.bool_and((F.col("n") == F.col("last")) & (F.col("n") == F.col("d"))).alias("numbered"),
    )


@query("src03_salvage", """SELECT l_orderkey % 37 = 36 AS is_malformed, count(*) AS documents FROM lineitem GROUP BY 1""")
def src03(spark, sf):
    return landing.lift_fields(raw_documents(spark, sf).select("raw_data")).groupBy("is_malformed").agg(F.count(F.lit(1)).alias("documents"))


@query("src03_bad_payloads", "SELECT (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages) AS malformed")
def src03_bad(spark, sf):
    texts = base(spark, sf, "documents").select(F.col("text").alias("raw_data")).unionByName(base(spark, sf, "pages").select(F.col("html").alias("raw_data")))
    return landing.lift_fields(texts).agg(F.count_if("is_malformed").alias("malformed"))


@query("src04_county_files")
def src04(spark, sf):
    root = _landed(spark, sf, "src04")
    found = landing.county_files(spark, [root, f"{root}/bucket=c0", f"{root}/bucket=c1"], LANDED)
    return found.groupBy(F.regexp_extract("path", "bucket=(c[0-9])", 1).alias("bucket")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


@query("src05_path_columns", """SELECT path_county, path_state, count(*) AS files FROM (SELECT 'county_' || (l_suppkey % 50) AS path_county,
  CASE l_linenumber % 4 WHEN 0 THEN 'texas' WHEN 1 THEN 'california' WHEN 2 THEN 'florida' ELSE 'unknown' END AS path_state FROM lineitem) GROUP BY ALL""")
def src05(spark, sf):
    n = F.col("l_linenumber") % 4
    token = F.when(n == 0, "tx").when(n == 1, "california").when(n == 2, "fl").otherwise("cactus")
    path = F.concat(F.lit("s3a://bucket/raw/parcels/"), token, F.lit("/county_"), (F.col("l_suppkey") % 50).cast("string"), F.lit("/f.json"))
    rows = base(spark, sf, "lineitem").select(path.alias("path")).withColumns(landing.path_columns(F.col("path")))
    return rows.groupBy("path_county", "path_state").agg(F.count(F.lit(1)).alias("files"))


CSV_TYPE = T.StructType([T.StructField("id", T.LongType()), T.StructField("county_id", T.StringType()), T.StructField("state_code", T.StringType()), T.StructField("acres", T.DoubleType())])


def _csv(spark, sf, label):
    root = new_folder(spark, label)
    rows = table(spark, sf, "parcels").select(F.col("k").alias("id"), F.concat(F.lit(" "), "county_id").alias("county_id"), F.lower("state_code").alias("state_code"), "acres")
    bad = rows.where("id % 7 = 6").select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("id"), "county_id", "state_code", "acres")
    good = rows.where("id % 7 <> 6").withColumn("id", F.col("id").cast("string"))
    store.export(good.unionByName(bad), root, "csv")
    return landing.read_csv(spark, root, CSV_TYPE)


@query("src06_csv_load", "SELECT count(*) FILTER (WHERE c_custkey % 7 <> 6) AS loaded, count(*) FILTER (WHERE c_custkey % 7 = 6) AS errors FROM customer")
def src06(spark, sf):
    return landing.load_counts(_csv(spark, sf, "src06"))


@query("src07_parcel_csv", "SELECT k AS id, acres FROM parcels WHERE county_id = 'county_0' AND state_code = 'TX' AND k % 7 <> 6", "parcels")
def src07(spark, sf):
    csv = _csv(spark, sf, "src07").where("_bad IS NULL")
    return landing.parcel_csv(csv, "COUNTY_0", "tx").select("id", "acres")


@query("src10_land_cover_features", """SELECT l_orderkey, 11 + l_partkey % 9 AS nlcd_code, CASE l_linenumber % 3 WHEN 2 THEN 1.0 ELSE l_quantity END AS area FROM lineitem WHERE l_suppkey % 6 <> 5
UNION ALL SELECT l_orderkey, 82, 1.0 FROM lineitem WHERE l_suppkey % 6 <> 5""")
def src10(spark, sf):
    code = (F.lit(11) + F.col("l_partkey") % 9).cast("string")
    field = F.when(F.col("l_suppkey") % 2 == 0, "landcover").otherwise("value")
    area = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit(',"area":'), F.col("l_quantity").cast("string"))).when(
        F.col("l_linenumber") % 3 == 1, F.concat(F.lit(',"Shape_Area":'), F.col("l_quantity").cast("string"))
    ).otherwise("")
    one = F.concat(F.lit('{"properties":{"'), field, F.lit('":'), code, area, F.lit("}}"))
    text = F.when(
        F.col("l_suppkey") % 6 != 5, F.concat(F.lit('{"features":['), one, F.lit(',{"properties":{"class":82}},{"properties":{}}]}'))
    ).otherwise('{"features":[]}')
    rows = spread(base(spark, sf, "lineitem")).select("l_orderkey", text.alias("response"))
    return responses.land_cover_features(rows, "response")


@query("src11_elevation", """SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN l_suppkey % 10 = 0 THEN NULL WHEN l_linenumber % 2 = 0 THEN l_quantity * 3.28084e0 ELSE l_quantity END, 6) AS feet FROM lineitem""")
def src11(spark, sf):
    v = F.when(F.col("l_suppkey") % 10 == 0, "-1000000").otherwise(F.col("l_quantity").cast("string"))
    u = F.when(F.col("l_linenumber") % 2 == 0, "Meters").otherwise("Feet")
    text = F.when(F.col("l_partkey") % 2 == 0, F.concat(F.lit('{"value":'), v, F.lit(',"units":"'), u, F.lit('"}'))).otherwise(
        F.concat(F.lit('{"Elevation_Query":[{"Elevation":'), v, F.lit(',"Units":"'), u, F.lit('"}]}'))
    )
    return spread(base(spark, sf, "lineitem")).select("l_orderkey", "l_linenumber", "l_partkey", F.round(responses.elevation(text), 6).alias("feet"))


@query("src12_crop_answers", """SELECT crop_code, coalesce(crop_name, 'Unknown (' || crop_code || ')') AS crop_name, CASE WHEN crop_code IS NULL THEN NULL ELSE coalesce(crop_category, 'Other') END AS crop_category,
  crop_code IS NOT NULL AS query_success, count(*) AS n FROM (SELECT CASE l_linenumber % 4 WHEN 0 THEN l_suppkey % 60 WHEN 1 THEN CASE WHEN l_suppkey % 60 IN (SELECT crop_code FROM crops) THEN l_suppkey % 60 END WHEN 2 THEN 5 END AS crop_code FROM lineitem)
LEFT JOIN crops USING (crop_code) GROUP BY ALL""", "crops")
def src12(spark, sf):
    code, n = (F.col("l_suppkey") % 60).cast("string"), F.col("l_linenumber") % 4
    text = (
        F.when(n == 0, F.concat(F.lit("<r><Result>"), code, F.lit("</Result></r>")))
        .when(n == 1, F.concat(F.lit("<r><code>"), code, F.lit("</code></r>")))
        .when(n == 2, "<value>5</value")
        .otherwise("<r>none</r>")
    )
    out = responses.crop_answers(spread(base(spark, sf, "lineitem")).select(text.alias("xml")), "xml")
    return out.groupBy("crop_code", "crop_name", "crop_category", "query_success").agg(F.count(F.lit(1)).alias("n"))


@query("src13_statistics", """SELECT year, commodity_desc, value_text, CASE WHEN upper(trim(value_text)) = '(D)' THEN NULL ELSE TRY_CAST(replace(replace(trim(value_text), ',', ''), '$', '') AS DOUBLE) END AS value_numeric, count(*) AS n
FROM county_stats GROUP BY ALL""", "county_stats")
def src13(spark, sf):
    record = F.struct(F.col("year").cast("string").alias("year"), F.col("value_text").alias("Value"), F.lower("commodity_desc").alias("commodity_desc"), "unit_desc")
    rows = spread(table(spark, sf, "county_stats")).select(F.to_json(F.struct(F.array(record).alias("data"))).alias("response"))
    return responses.statistics(rows, "response").groupBy("year", "commodity_desc", "value_text", "value_numeric").agg(F.count(F.lit(1)).alias("n"))


@query("src14_water_rights", """SELECT o_orderkey, 'Well ' || o_custkey AS structure_name, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS appropriation_date, o_totalprice AS net_absolute FROM orders WHERE o_orderkey % 5 <> 0""")
def src14(spark, sf):
    k = F.col("o_orderkey")
    date = F.when(k % 6 == 0, "not-a-date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'-06:00'"))
    right = F.struct(F.concat(F.lit("Well "), F.col("o_custkey").cast("string")).alias("structureName"), date.alias("appropriationDate"), F.col("o_totalprice").alias("netAbsolute"))
    text = F.when(k % 5 != 0, F.to_json(F.struct(F.array(right).alias("ResultList")))).otherwise('{"ResultList":[]}')
    out = responses.water_rights(spread(base(spark, sf, "orders")).select("o_orderkey", text.alias("response")), "response")
    return out.select("o_orderkey", "structure_name", F.date_format("appropriation_date", "yyyy-MM-dd").alias("appropriation_date"), "net_absolute")


@query("src15_lookup", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'parcel_id' WHEN o_orderkey % 3 = 1 THEN 'address' WHEN p.parcel_id IS NOT NULL THEN 'coordinates' ELSE 'unknown' END AS query_type,
  CASE WHEN o_orderkey % 3 < 2 AND o_custkey IN (SELECT c_custkey FROM customer) THEN 'P' || o_custkey WHEN o_orderkey % 3 = 2 THEN p.parcel_id END AS found
  FROM orders LEFT JOIN parcels p ON p.parcel_id = 'P' || o_custkey AND p.latitude IS NOT NULL""", "parcels")
def src15(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    where = table(spark, sf, "parcels").where("latitude IS NOT NULL").select(
        "parcel_id", "latitude", "longitude", F.when(F.abs("longitude") > 90, F.array("longitude", "latitude")).otherwise(F.array("latitude", "longitude")).alias("at")
    )
    orders = base(spark, sf, "orders").select("o_orderkey", "o_custkey", F.concat(F.lit("P"), c).alias("_p"))
    asked = orders.join(where.select(F.col("parcel_id").alias("_p"), "at"), "_p", "left").select(
        "o_orderkey", F.when(k % 3 == 2, F.col("at")).alias("coordinates"), F.when(k % 3 == 1, F.concat(F.lit("  "), c, F.lit(" main  st. "))).alias("address"),
        F.when(k % 3 == 0, F.concat(F.lit(" P"), c)).alias("parcel_id"),
    )
    asked = asked.withColumn("query_type", requests.classify_request(F.col("coordinates"), F.col("address"), F.col("parcel_id")))
    profile = base(spark, sf, "customer").select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("parcel_id"), F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St")).alias("address")
    )
    profile = profile.withColumn("address", F.concat("address", F.lit("."))).join(where.select("parcel_id", "latitude", "longitude"), "parcel_id", "left")
    return requests.lookup(asked, profile, "o_orderkey").select("o_orderkey", "query_type", "found")


@query("src15_repaired_points", "SELECT parcel_id, latitude, longitude FROM parcels", "parcels")
def src15_points(spark, sf):
    p = table(spark, sf, "parcels")
    turned = (F.col("k") % 2 == 1) & (F.abs("longitude") > 90) & F.col("latitude").isNotNull()  # only there the order can be told
    given = F.when(turned, F.array("longitude", "latitude")).otherwise(F.array("latitude", "longitude"))
    return p.select("parcel_id", requests.repaired_point(given).alias("p")).select("parcel_id", "p.*")


@query("p21_county_state", """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'travis' WHEN 1 THEN 'polk' ELSE 'unknown' END AS county,
  CASE o_orderkey % 4 WHEN 0 THEN 'texas' WHEN 1 THEN 'iowa' WHEN 2 THEN 'california' ELSE 'unknown' END AS state FROM orders""")
def p21(spark, sf):
    k = F.col("o_orderkey")
    given = F.when(k % 3 == 0, " Travis ")
    place = F.when(k % 3 == 1, "12 Road, Polk County").otherwise("5 Cactus Lane")
    address = F.when(k % 4 == 2, F.concat(place, F.lit(", CA 90210"))).otherwise(place)
    state = F.when(k % 4 == 0, "TX").when(k % 4 == 1, "Iowa")
    return base(spark, sf, "orders").select(
        "o_orderkey", landing.county_of([given, F.lit("")], address).alias("county"), landing.state_of([state], address).alias("state")
    )


@query("p22_cache_keys", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'coords_' || user_id || '.5_-' || user_id || '.25' WHEN 1 THEN 'address_' || user_id WHEN 2 THEN 'a:' || user_id ELSE 'x_' || user_id END AS parcel_id FROM events""")
def p22(spark, sf):
    n, u = F.col("event_id") % 4, F.col("user_id").cast("string")
    key = (
        F.when(n == 0, F.concat(F.lit("parcel:coords:"), u, F.lit(".5:-"), u, F.lit(".25"))).when(n == 1, F.concat(F.lit("parcel:address:"), u))
        .when(n == 2, F.concat(F.lit("parcel:id:a:"), u)).otherwise(F.concat(F.lit("x:"), u))
    )
    return base(spark, sf, "events").select("event_id", requests.parcel_of_cache_key(key).alias("parcel_id"))


@query("p23_event_classes", """SELECT kind, count(*) AS events, CAST(sum(parcels) AS BIGINT) AS parcels FROM (SELECT CASE event_id % 5 WHEN 0 THEN 'single_parcel' WHEN 1 THEN 'batch_parcels' WHEN 2 THEN 'state_bulk' WHEN 3 THEN 'enrichment_trigger' ELSE 'batch_parcels' END AS kind,
  CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 4 THEN 2 ELSE 0 END AS parcels FROM events UNION ALL SELECT 'single_parcel', 1 FROM events WHERE event_id % 5 = 4) GROUP BY 1""")
def p23(spark, sf):
    n, u = F.col("event_id") % 5, F.col("user_id").cast("string")
    single = F.concat(F.lit('{"parcel_id":"P'), u, F.lit('"}'))
    batch = F.concat(F.lit('{"parcel_ids":["P'), u, F.lit('","Q'), u, F.lit('"]}'))
    record = lambda body: F.to_json(F.struct(body.alias("body")))
    text = (
        F.when(n == 0, single).when(n == 1, batch).when(n == 2, '{"state_code":"TX"}').when(n == 3, '{"action":"nlcd_enrichment"}')
        .otherwise(F.concat(F.lit('{"Records":['), record(batch), F.lit(',{"Sns":'), F.to_json(F.struct(single.alias("Message"))), F.lit("}]}")))
    )
    inner = spread(base(spark, sf, "events")).select(text.alias("event")).select(F.explode(requests.unwrap(F.col("event"))).alias("e"))
    return inner.groupBy(requests.classify_event(F.col("e")).alias("kind")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.size(requests.event_parcels(F.col("e")))).alias("parcels")
    )


@query("p24_enrichment_policy", """SELECT source, count(*) AS events FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 's3_ingestion' WHEN 1 THEN 'api_ingestion' ELSE 'other' END AS source FROM events)
WHERE source = 's3_ingestion' OR event_id % 4 = 0 GROUP BY 1""")
def p24(spark, sf):
    n = F.col("event_id") % 3
    rows = base(spark, sf, "events").select(
        F.when(n == 0, "s3_ingestion").when(n == 1, "api_ingestion").otherwise("other").alias("source"), F.when(F.col("event_id") % 4 == 0, True).alias("explicit")
    )
    return rows.where(requests.should_enrich(F.col("explicit"), F.col("source"))).groupBy("source").agg(F.count(F.lit(1)).alias("events"))


@query("u01_distinct_counties", """SELECT DISTINCT n_name AS state, 'COUNTY_' || (c_custkey % 50) AS county FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def u01(spark, sf):
    k = F.col("c_custkey")
    suffix = F.when(k % 3 == 0, " County").when(k % 3 == 1, " CO").otherwise("")
    rows = base(spark, sf, "customer").join(base(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(F.col("n_name").alias("state"), values.bare_county(F.concat(F.lit(" county_"), (k % 50).cast("string"), suffix)).alias("county")).distinct()


@query("f10_fips", """SELECT c_custkey, lpad('' || (c_custkey % 60 + 1), 2, '0') AS state_fips, lpad('' || (c_custkey % 300), 3, '0') AS county_fips FROM customer""")
def f10(spark, sf):
    k = F.col("c_custkey")
    code = ((k % 60 + 1) * 1000 + k % 300).cast("string")
    return base(spark, sf, "customer").select("c_custkey", values.fips_parts(code).alias("f")).select("c_custkey", "f.*")


@query("f11_f12_normalise", """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'CO' END AS state, CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def f11(spark, sf):
    k = F.col("o_orderkey")
    day = F.when(k % 3 == 0, "not-a-date-text").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    return base(spark, sf, "orders").select(
        "o_orderkey", values.two_letter_state(F.when(k % 2 == 0, " co ").otherwise("Texas")).alias("state"),
        F.date_format(values.iso_day(day), "yyyy-MM-dd").alias("day"),
    )


@query("f18_coordinate_ids", "SELECT parcel_id, 'LAND_' || CAST(trunc(latitude * 1000000) AS BIGINT) || '_' || CAST(trunc(longitude * 1000000) AS BIGINT) AS land_id FROM parcels", "parcels")
def f18(spark, sf):
    return table(spark, sf, "parcels").select("parcel_id", values.coordinate_id("LAND", F.col("latitude"), F.col("longitude")).alias("land_id"))


# Merges from raw documents ----------------------------------------------------------------------


def _target(spark, sf):
    source = merges.merge_source(raw_documents(spark, sf), AS_OF, None).drop("ingestion_timestamp")
    old = base(spark, sf, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("parcel_id"), F.col("p_name").alias("owner_name"))
    empty = source.limit(0).withColumns({"updated_at": F.lit(None).cast("timestamp"), "ingestion_timestamp": F.lit(None).cast("timestamp")})
    return empty.unionByName(old, allowMissingColumns=True)


MERGED = """SELECT parcel_id, CASE WHEN l_shipdate IS NULL THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS ingested, l_shipdate IS NOT NULL AS updated
FROM (SELECT parcel_id, max(l_shipdate) AS l_shipdate FROM (SELECT parcel_id, l_shipdate FROM fields WHERE parcel_id IS NOT NULL {} UNION ALL SELECT 'P' || p_partkey, NULL FROM part) GROUP BY 1)"""


def _merged(spark, sf, first_only):
    raw = raw_documents(spark, sf).withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp"))
    out = merges.curated_merge(_target(spark, sf), raw, AS_OF, None, first_only)
    return out.select("parcel_id", F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("ingested"), F.col("updated_at").isNotNull().alias("updated"))


@query("snk04_curated_merge", parcel_sql(MERGED.format("")))
def snk04(spark, sf):
    return _merged(spark, sf, False)


@query("snk04_first_only", parcel_sql(MERGED.format("AND idx = 0")))
def snk04_first(spark, sf):
    return _merged(spark, sf, True)


@query("u02_merge_source", parcel_sql("SELECT count(*) AS versions, count(DISTINCT parcel_id) AS parcels FROM (SELECT DISTINCT parcel_id, state, parcel_county, county, address, city, zip_code, owner_name, acres, property_type, land_use_description, assessed_value, market_value, tax_amount, tax_year, improvement_value, land_value, year_built, building_count, has_geometry, l_partkey % 1000, l_suppkey % 400, l_shipdate FROM (SELECT * REPLACE (upper(trim(coalesce(parcel_county, county))) AS county, NULL AS parcel_county, trim(address) AS address, upper(trim(state)) AS state, trim(property_type) AS property_type, trim(zip_code) AS zip_code, trim(city) AS city, CASE WHEN has_geometry THEN l_partkey ELSE 0 END AS l_partkey, CASE WHEN has_geometry THEN l_suppkey ELSE 0 END AS l_suppkey) FROM fields WHERE parcel_id IS NOT NULL))"))
def u02(spark, sf):
    return merges.merge_source(raw_documents(spark, sf), AS_OF, None).agg(F.count(F.lit(1)).alias("versions"), F.countDistinct("parcel_id").alias("parcels"))


@query("snk11_station_assignments", f"""WITH {NEAREST} SELECT parcel_id, station_id, round(d, 4) AS distance_miles, data_year FROM assigned LEFT JOIN climate USING (station_id)""",
       "parcels stations station_climate")
def snk11(spark, sf):
    """Assignments as a catalog table of their own, created from the query."""
    root = new_folder(spark, "snk11")
    out = merges.assign_stations(table(spark, sf, "parcels"), table(spark, sf, "stations"), table(spark, sf, "station_climate"))
    stored = catalog.create_table_as(out, f"station_assignments_{uuid.uuid4().hex}", root)
    return stored.select("parcel_id", "station_id", F.round("distance_miles", 4).alias("distance_miles"), "data_year")


@query("seed01_counties", "SELECT n_name AS state_name, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def seed01(spark, sf):
    root = new_folder(spark, "seed01")
    code = F.lpad(F.col("n_nationkey").cast("string"), 5, "0")
    store.export(base(spark, sf, "nation").select(code.alias("county_fips"), F.lit("c").alias("county_name"), F.lit("XX").alias("state_code"), F.col("n_name").alias("state_name")), root, "csv")
    seed = landing.read_seed(spark, root)
    rows = base(spark, sf, "customer").select(F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("county_fips"))
    return rows.join(seed, "county_fips").groupBy("state_name").agg(F.count(F.lit(1)).alias("customers"))


@query("r17_map_overlays", """SELECT p.parcel_id, coalesce(s.codes, '') AS soil_codes, coalesce(f.zones, '') AS flood_zones FROM parcels p
LEFT JOIN (SELECT 'P' || l_partkey AS parcel_id, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS codes FROM lineitem GROUP BY 1) s USING (parcel_id)
LEFT JOIN (SELECT 'P' || o_custkey AS parcel_id, string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) AS zones FROM orders GROUP BY 1) f USING (parcel_id)""", "parcels")
def r17(spark, sf):
    def keyed(df, col, *fields):
        return df.select(F.concat(F.lit("P"), F.col(col).cast("string")).alias("parcel_id"), *fields)

    out = merges.map_overlays(
        table(spark, sf, "parcels").select("parcel_id"),
        {
            "soil": keyed(base(spark, sf, "lineitem"), "l_partkey", F.col("l_linenumber").alias("code")),
            "flood": keyed(base(spark, sf, "orders"), "o_custkey", F.col("o_orderpriority").alias("zone")),
        },
    )
    codes = F.transform("soil.code", lambda c: c.cast("string"))
    return out.select("parcel_id", F.array_join(codes, ",").alias("soil_codes"), F.array_join("flood.zone", ",").alias("flood_zones"))


# Streams ----------------------------------------------------------------------------------------


def _event_stream(spark, sf):
    return jobs.file_stream(spark, sf, base(spark, sf, "events").schema, pattern="events.parquet")


@query("st01_file_ingest", "SELECT count(*) AS documents, count(*) FILTER (WHERE l_orderkey % 37 = 36) AS malformed FROM lineitem")
def st01(spark, sf):
    landed, root = _landed(spark, sf, "st01"), new_folder(spark, "st01-out")
    for _ in range(2):  # the second run finds no new files and adds nothing
        jobs.append_files(jobs.document_stream(spark, landed, LANDED), f"{root}/raw", f"{root}/checkpoint").awaitTermination()
    docs = landing.lift_fields(spark.read.parquet(f"{root}/raw"))
    return docs.agg(F.count(F.lit(1)).alias("documents"), F.count_if("is_malformed").alias("malformed"))


@query("st02_event_filter", "SELECT event_id FROM events WHERE event_type IN ('click', 'view') AND user_id % 2 = 0")
def st02(spark, sf):
    root = new_folder(spark, "st02")
    e = F.col("event_type")
    key = F.concat(F.lit("raw/"), F.when(F.col("user_id") % 2 == 0, "Parcels").otherwise("other"), F.lit("/f"), F.when(e == "error", ".csv").otherwise(".json"))
    name = F.when(e.isin("click", "view", "error"), "ObjectCreated:Put").otherwise("ObjectRemoved:Delete")
    events = _event_stream(spark, sf).select("event_id", key.alias("key"), name.alias("event_name"))
    jobs.append_files(jobs.wanted_events(events).select("event_id"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query("st03_fan_out", """SELECT 'errors' AS route, count(*) AS events FROM events WHERE event_type = 'error' UNION ALL SELECT 'large', count(*) FROM events WHERE value > 50 UNION ALL SELECT 'all', count(*) FROM events""")
def st03(spark, sf):
    root = new_folder(spark, "st03")
    routes = {"errors": F.col("event_type") == "error", "large": F.col("value") > 50, "all": F.lit(True)}
    jobs.fan_out(_event_stream(spark, sf), routes, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy("route").agg(F.count(F.lit(1)).alias("events"))


@query("st04_hourly_quota", """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS requests, count(*) >= 5 AS exhausted FROM events GROUP BY ALL""")
def st04(spark, sf):
    root = new_folder(spark, "st04")
    events = _event_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = jobs.hourly_quota(events, "ts", "event_type", limit=5)
    jobs.stream_upsert(counts, f"{root}/table", ["hour", "event_type"], ["requests"], f"{root}/checkpoint", mode="update").awaitTermination()
    out = store.read_table(spark, f"{root}/table")
    return out.select(F.date_format("hour", "yyyy-MM-dd HH").alias("hour"), "event_type", "requests", "exhausted")


@query("st05_stream_upsert", """SELECT o_custkey AS id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order, strftime(max(o_orderdate), '%Y-%m-%d') AS updated FROM orders GROUP BY 1""")
def st05(spark, sf):
    root = new_folder(spark, "st05")
    pages = base(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("last_order"), F.col("o_orderdate").alias("updated"))
    pages.repartition(3).write.parquet(f"{root}/in")
    changes = jobs.file_stream(spark, f"{root}/in", pages.schema, pattern="*.parquet", per_batch=1)
    jobs.stream_upsert(changes, f"{root}/table", ["id"], ["updated", "last_order"], f"{root}/checkpoint").awaitTermination()
    out = store.read_table(spark, f"{root}/table")
    return out.select("id", "last_order", F.date_format("updated", "yyyy-MM-dd").alias("updated"))


@query("st06_incremental_runs", "SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS orders FROM orders")
def st06(spark, sf):
    """Two scheduled runs: the second picks up only the files that arrived in between."""
    root = new_folder(spark, "st06")
    orders = base(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'"):
        orders.where(status).write.mode("append").parquet(f"{root}/in")
        stream = jobs.file_stream(spark, f"{root}/in", orders.schema, pattern="*.parquet")
        jobs.append_files(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("o_orderkey").alias("orders"))


@query("st07_error_routing", "SELECT 'bad' AS route, count(*) FILTER (WHERE l_orderkey % 37 = 36) AS documents FROM lineitem UNION ALL SELECT 'good', count(*) FILTER (WHERE l_orderkey % 37 <> 36) FROM lineitem")
def st07(spark, sf):
    landed, root = _landed(spark, sf, "st07"), new_folder(spark, "st07-out")
    jobs.route_errors(jobs.document_stream(spark, landed, LANDED), f"{root}/good", f"{root}/bad", f"{root}/checkpoint").awaitTermination()
    out = None
    for route in ("good", "bad"):
        rows = spark.read.parquet(f"{root}/{route}").agg(F.lit(route).alias("route"), F.count(F.lit(1)).alias("documents"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("st08_live_entries", "SELECT event_id FROM events WHERE ts + INTERVAL 2 HOUR >= TIMESTAMP '2024-01-20'")
def st08(spark, sf):
    cache = base(spark, sf, "events").select("event_id", (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("ttl"))
    return jobs.live_entries(cache, F.lit(dt.datetime(2024, 1, 20))).select("event_id")


@query("st08_first_seen", "SELECT count(DISTINCT user_id) AS users FROM events")
def st08_first(spark, sf):
    root = new_folder(spark, "st08")
    events = _event_stream(spark, sf).select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    jobs.append_files(jobs.first_seen(events, "ts", ["user_id"], "60 days"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").agg(F.count(F.lit(1)).alias("users"))


@query("ud03_replace_and_summarise", "SELECT parcel_id, count(DISTINCT nlcd_code) AS classes FROM land_cover GROUP BY 1", "land_cover")
def ud03(spark, sf):
    from fieldbook.operators import landcover

    stats = landcover.class_statistics(table(spark, sf, "land_cover"))
    detail = landcover.detail_rows(stats, F.col("total_area"), minimum=0.0)
    summary = landcover.parcel_summary(detail).select("parcel_id", F.col("total_classes_count").alias("classes"))
    old = summary.withColumn("classes", F.lit(-1).cast("bigint"))
    return replace_by_key(old, summary, summary, "parcel_id")
