"""Quality checks, load monitoring, table maintenance and run-state queries."""

from __future__ import annotations

import datetime as dt
import zlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldbook.operators import merge, quality
from fieldbook.registry import query
from fieldbook.registry.tables import base, table
from fieldbook.session import new_folder
from fieldbook.sources import catalog, tables as store
from fieldbook.streaming import jobs

EVENTS_AS_OF = dt.datetime(2024, 1, 31)
ORDERS_AS_OF = dt.datetime(2002, 1, 1)


def _quality(spark, sf, days=7):
    log = table(spark, sf, "load_log")
    return quality.load_quality(log, F.col("error_text").isNull(), F.col("error_text").isNotNull(), EVENTS_AS_OF, days)


QUALITY = """ quality AS (SELECT CAST(ingestion_timestamp AS DATE) AS ingestion_date, ingestion_type, county, count(*) AS total_records,
  count(*) FILTER (WHERE error_text IS NULL) AS valid_parcel_records, count(*) FILTER (WHERE error_text IS NOT NULL) AS error_records,
  avg(parcel_count) AS avg_parcels, min(ingestion_timestamp) AS first_ts, max(ingestion_timestamp) AS last_ts
  FROM load_log WHERE ingestion_timestamp >= TIMESTAMP '2024-01-31' - INTERVAL {} DAY GROUP BY 1, 2, 3)"""


@query("a01_load_quality", f"""WITH {QUALITY.format(7)} SELECT strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date, ingestion_type, county, total_records,
  valid_parcel_records, error_records, round(avg_parcels, 6) AS avg_parcels_per_file, strftime(first_ts, '%Y-%m-%d %H:%M:%S') AS first_ingestion,
  strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_ingestion FROM quality""", "load_log")
def a01(spark, sf):
    stamp = "yyyy-MM-dd HH:mm:ss"
    return _quality(spark, sf).withColumns(
        {
            "ingestion_date": F.date_format("ingestion_date", "yyyy-MM-dd"),
            "avg_parcels_per_file": F.round("avg_parcels_per_file", 6),
            "first_ingestion": F.date_format("first_ingestion", stamp),
            "last_ingestion": F.date_format("last_ingestion", stamp),
        }
    )


@query("dq08_error_alerts", f"""WITH {QUALITY.format(30)}, s AS (SELECT county, sum(error_records) AS e, sum(total_records) AS t FROM quality GROUP BY 1)
SELECT county, round(e / t * 100, 6) AS error_rate, CASE WHEN e / t * 100 > 10 THEN 'CRITICAL' ELSE 'WARNING' END AS severity FROM s WHERE e / t * 100 > 5""", "load_log")
def dq08(spark, sf):
    out = quality.error_alerts(_quality(spark, sf, 30))
    return out.select("county", F.round("error_rate", 6).alias("error_rate"), "severity")


@query("dq11_county_thresholds", f"""WITH {QUALITY.format(30)}, s AS (SELECT county, sum(error_records) AS e, sum(total_records) AS t FROM quality GROUP BY 1)
SELECT county, CASE WHEN e / t * 100 > 5 THEN 'error_rate' ELSE 'too_few_records' END AS reason FROM s WHERE e / t * 100 > 5 OR t < 100""", "load_log")
def dq11(spark, sf):
    return quality.county_thresholds(_quality(spark, sf, 30)).select("county", "reason")


CONTACT_COLUMNS = ["firstname", "lastname", "email", "phone", "company", "jobtitle"]


@query("a02_null_coverage", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS total, round(count({c}) * 100 / count(*), 1) AS filled_percent FROM contacts" for c in CONTACT_COLUMNS), "contacts")
def a02(spark, sf):
    return quality.null_coverage(table(spark, sf, "contacts"), CONTACT_COLUMNS)


@query("dq01_not_null", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS total, count(*) - count({c}) AS nulls FROM contacts" for c in CONTACT_COLUMNS), "contacts")
def dq01(spark, sf):
    return quality.null_counts(table(spark, sf, "contacts"), CONTACT_COLUMNS)


@query("dq02_unique", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq02(spark, sf):
    return quality.duplicates(base(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq03_accepted_values", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')")
def dq03(spark, sf):
    return quality.not_accepted(base(spark, sf, "events"), "event_type", ["click", "view", "purchase"]).select("event_id", "event_type")


@query("dq04_accepted_range", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity NOT BETWEEN 5 AND 45")
def dq04(spark, sf):
    return quality.out_of_range(base(spark, sf, "lineitem"), "l_quantity", 5, 45).select("l_orderkey", "l_partkey", "l_quantity")




def _deal_checks():
    return {
        "amount_large": F.col("amount") > 20000,
        "probability_set": F.col("stage_probability") > 0,
        "stage_known": F.col("dealstage") != "closedlost",
    }


@query("dq05_expressions", """
SELECT 'amount_large' AS "check", count(*) FILTER (WHERE NOT amount > 20000) AS failures, CASE WHEN count(*) FILTER (WHERE NOT amount > 20000) = 0 THEN 'pass' ELSE 'warn' END AS status FROM deals
UNION ALL SELECT 'probability_set', count(*) FILTER (WHERE stage_probability <= 0), CASE WHEN count(*) FILTER (WHERE stage_probability <= 0) = 0 THEN 'pass' ELSE 'error' END FROM deals
UNION ALL SELECT 'stage_known', count(*) FILTER (WHERE dealstage = 'closedlost'), CASE WHEN count(*) FILTER (WHERE dealstage = 'closedlost') = 0 THEN 'pass' ELSE 'error' END FROM deals""", "deals")
def dq05(spark, sf):
    return quality.run_checks(table(spark, sf, "deals"), _deal_checks(), {"amount_large": "warn"})


@query("dq07_stored_failures", """
SELECT 'amount_large' AS "check", deal_id FROM deals WHERE NOT amount > 20000 UNION ALL SELECT 'probability_set', deal_id FROM deals WHERE stage_probability <= 0
UNION ALL SELECT 'stage_known', deal_id FROM deals WHERE dealstage = 'closedlost'""", "deals")
def dq07(spark, sf):
    root = new_folder(spark, "dq07")
    failed = quality.failing_rows(table(spark, sf, "deals"), _deal_checks())
    failed.write.partitionBy("check").parquet(root)
    return spark.read.parquet(root).select("check", "deal_id")


@query("dq06_freshness", """
SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest, CASE WHEN epoch(TIMESTAMP '2024-01-31') - epoch(max(ts)) > 24 * 3600 THEN 'error'
  WHEN epoch(TIMESTAMP '2024-01-31') - epoch(max(ts)) > 1800 THEN 'warn' ELSE 'pass' END AS status FROM events GROUP BY 1""")
def dq06(spark, sf):
    out = quality.freshness(base(spark, sf, "events"), "ts", EVENTS_AS_OF, 0.5, 24, ["event_type"])
    return out.select("event_type", F.date_format("newest", "yyyy-MM-dd HH:mm:ss").alias("newest"), "status")


@query("dq09_table_check", """SELECT count(*) AS row_count, count(*) > 0 AS has_rows, 'phone' AS missing_columns, 'fail' AS status FROM orders""")
def dq09(spark, sf):
    return quality.table_check(base(spark, sf, "orders"), ["O_ORDERKEY", "o_custkey", "phone"])


@query("dq12_field_types", """
SELECT 'k' AS key, count(*) AS present, CAST(0 AS BIGINT) AS nulls, 'BIGINT' AS types FROM events""")
def dq12(spark, sf):
    docs = base(spark, sf, "events").select(F.parse_json("props").alias("doc"))
    return quality.field_types(docs, "doc")


@query("dq13_profile_coverage", """SELECT count(*) AS total, count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL) AS with_coordinates,
  count(DISTINCT state_code) AS states, count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL) < count(*) * 0.5 AS low_coverage FROM parcels""", "parcels")
def dq13(spark, sf):
    return quality.coverage(table(spark, sf, "parcels"))


@query("dq_orphan_orders", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)")
def dq_orphans(spark, sf):
    parents = base(spark, sf, "customer").where("c_nationkey < 20")
    return quality.orphans(base(spark, sf, "orders"), "o_custkey", parents, "c_custkey").select("o_orderkey", "o_custkey")


@query("a15_frame_report", """
SELECT count(*) AS total_rows, 8 AS total_columns, sum((firstname IS NULL)::INT + (lastname IS NULL)::INT + (email IS NULL)::INT + (phone IS NULL)::INT + (company IS NULL)::INT + (jobtitle IS NULL)::INT + 1)::BIGINT AS null_values,
  'archived' AS empty_columns, '' AS sparse_required, (count(*) - count(DISTINCT contact_id // 3))::BIGINT AS duplicate_ids FROM contacts""", "contacts")
def a15(spark, sf):
    frame = table(spark, sf, "contacts").select(
        F.floor(F.col("contact_id") / 3).alias("id"), *CONTACT_COLUMNS, F.lit(None).cast("string").alias("archived")
    )
    return quality.frame_report(frame, "id", ["email", "firstname", "lastname"])


@query("a20_numeric_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max,
    round((count(*) - count({c})) / count(*), 6) AS missing_rate FROM scored""" for c in ("lead_score", "completeness_score", "days_since_created")), "scored")
def a20(spark, sf):
    out = quality.numeric_profile(table(spark, sf, "scored"), ["lead_score", "completeness_score", "days_since_created"])
    return out.withColumns({"mean": F.round("mean", 5), "std": F.round("std", 5), "missing_rate": F.round("missing_rate", 6)})


@query("a20_categorical_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS unique_values, (SELECT {c} FROM contacts WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1) AS most_frequent,
    round((count(*) - count({c})) / count(*), 6) AS missing_rate FROM contacts""" for c in ("lifecyclestage", "leadsource", "jobtitle")), "contacts")
def a20_cat(spark, sf):
    out = quality.categorical_profile(table(spark, sf, "contacts"), ["lifecyclestage", "leadsource", "jobtitle"])
    return out.withColumn("missing_rate", F.round("missing_rate", 6))


@query("a25_table_info", """SELECT column_name, (SELECT count(*) FROM orders) AS row_count FROM (VALUES ('o_orderkey'), ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'), ('o_orderpriority')) AS t(column_name)""")
def a25(spark, sf):
    return catalog.describe_table(spark, _attached(spark, sf, "orders")).select("column_name", "row_count")


def _attached(spark, sf, name):
    """A base table under a name that its folder determines, so that several scales may be attached side by side."""
    mark = zlib.crc32(sf.encode())
    catalog.attach_table(spark, f"{name}_{mark}", f"{sf.rstrip('/')}/{name}.parquet")
    return f"{name}_{mark}"


LISTED = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6}


@query("a25_table_listing", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, (SELECT count(*) FROM information_schema.columns WHERE table_name = '{name}') AS n_columns, (SELECT count(*) FROM {name}) AS row_count"
    for name in LISTED))
def a25_listing(spark, sf):
    names = [_attached(spark, sf, name) for name in LISTED]
    listing = catalog.list_tables(spark, "*_" + names[0].rsplit("_", 1)[1]).where(F.col("table_name").isin(names))
    return listing.select(F.regexp_replace("table_name", "_[0-9]+$", "").alias("table_name"), F.col("n_columns").cast("bigint").alias("n_columns"), "row_count")


@query("dq09_tables_check", """SELECT * FROM (VALUES ('customer', true, '', 'pass'), ('nation', true, 'phone,population', 'fail'), ('absent_table', false, 'id', 'fail'))
  AS t(table_name, table_exists, missing_columns, status) JOIN (SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
  UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'absent_table', 0) USING (table_name)""")
def dq09_tables(spark, sf):
    expected = {_attached(spark, sf, "customer"): ["C_CUSTKEY", "c_name"], _attached(spark, sf, "nation"): ["n_name", "population", "phone"], "absent_table": ["id"]}
    out = catalog.check_tables(spark, expected)
    name = F.regexp_replace("table_name", "_[0-9]+$", "").alias("table_name")
    return out.select(name, "table_exists", "missing_columns", "status", "row_count")


@query("a26_ingestion_check", """SELECT count(*) AS rows, count(DISTINCT o_custkey) AS customers, min(o_totalprice) AS min_value, max(o_totalprice) AS max_value,
  round(avg(o_totalprice), 4) AS avg_value, count(*) = (SELECT max(o_orderkey) + 1 FROM orders) AS as_expected FROM orders""")
def a26(spark, sf):
    orders = base(spark, sf, "orders")
    return orders.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("o_custkey").alias("customers"), F.min("o_totalprice").alias("min_value"),
        F.max("o_totalprice").alias("max_value"), F.round(F.avg("o_totalprice"), 4).alias("avg_value"),
        (F.count(F.lit(1)) == F.max("o_orderkey") + 1).alias("as_expected"),
    )


@query("u03_missing_columns", "SELECT p.parcel_id, 0.0::DOUBLE AS soil_score, acres FROM parcels p", "parcels")
def u03(spark, sf):
    return quality.with_missing_as_zero(table(spark, sf, "parcels"), ["ACRES", "soil_score"]).select("parcel_id", "soil_score", "acres")


# Merges and table states ------------------------------------------------------------------------

ORDER_DAY = "strftime({}, '%Y-%m-%d')"


#: A third of the changed ids lie beyond the target's, and a third of the target's are not among them.
CHANGED_ID = "o_custkey * 3 DIV 2"


def _target(spark, sf):
    return base(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"),
        F.lit("1990-01-01").alias("updated_at"),
    )


def _changes(spark, sf):
    return base(spark, sf, "orders").select(
        F.expr(CHANGED_ID).alias("id"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_totalprice").alias("amount"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated_at"),
    )


MERGE = """ target AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount, '1990-01-01' AS updated_at FROM customer),
 source AS (SELECT o_custkey * 3 // 2 AS id, 'Order ' || o_orderkey AS name, o_totalprice AS amount, strftime(o_orderdate, '%Y-%m-%d') AS updated_at FROM orders
   QUALIFY row_number() OVER (PARTITION BY o_custkey * 3 // 2 ORDER BY strftime(o_orderdate, '%Y-%m-%d') DESC, o_totalprice DESC) = 1)"""


@query("snk03_upsert", f"""WITH {MERGE} SELECT coalesce(t.id, s.id) AS id, coalesce(s.name, t.name) AS name, coalesce(s.amount, t.amount) AS amount,
  coalesce(s.updated_at, t.updated_at) AS updated_at FROM target t FULL JOIN source s ON t.id = s.id""")
def snk03(spark, sf):
    root = new_folder(spark, "snk03")
    store.merge_into(_target(spark, sf), root, ["id"], ["updated_at"])
    store.merge_into(_changes(spark, sf), root, ["id"], ["updated_at", "amount"])
    return store.read_table(spark, root)


@query("snk05_partial_upsert", f"""WITH {MERGE} SELECT coalesce(t.id, s.id) AS id, coalesce(t.name, s.name) AS name, coalesce(s.amount, t.amount) AS amount,
  CASE WHEN s.id IS NOT NULL THEN '2002-01-01' ELSE t.updated_at END AS updated_at FROM target t FULL JOIN source s ON t.id = s.id""")
def snk05(spark, sf):
    return merge.upsert(
        _target(spark, sf), _changes(spark, sf), ["id"], update=["amount"], newest=["updated_at", "amount"],
        stamp={"updated_at": F.lit("2002-01-01")},
    )


@query("snk06_county_merge", """
SELECT county_name, state_code, year, commodity_desc, value_text, short_desc FROM county_stats
QUALIFY row_number() OVER (PARTITION BY county_name, state_code, year, commodity_desc ORDER BY source_desc DESC, unit_desc DESC, short_desc DESC, value_text DESC) = 1""", "county_stats")
def snk06(spark, sf):
    rows = table(spark, sf, "county_stats")
    keys = ["county_name", "state_code", "year", "commodity_desc"]
    order = ["source_desc", "unit_desc", "short_desc", "value_text"]
    empty = rows.select(*keys, *order).limit(0)
    return merge.upsert(empty, rows.select(*keys, *order), keys, newest=order).select(*keys, "value_text", "short_desc")


@query("snk07_station_merge", """SELECT station_id, data_year, CASE WHEN data_year = 2023 AND station_id LIKE '%5' THEN 0 ELSE precipitation END AS precipitation FROM station_climate""",
       "station_climate")
def snk07(spark, sf):
    target = table(spark, sf, "station_climate").select("station_id", "data_year", "precipitation")
    fixes = target.where("data_year = 2023 AND station_id LIKE '%5'").withColumn("precipitation", F.lit(0).cast("bigint"))
    return merge.upsert(target, fixes, ["station_id", "data_year"])


@query("snk08_update_only", """
SELECT c.c_custkey AS id, c.c_name AS name, coalesce(s.owner, 'none') AS owner FROM customer c LEFT JOIN
 (SELECT o_custkey, max('owner_' || (o_orderkey % 6)) AS owner FROM orders GROUP BY 1) s ON s.o_custkey = c.c_custkey""")
def snk08(spark, sf):
    target = base(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("none").alias("owner"))
    owners = base(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), F.concat(F.lit("owner_"), (F.col("o_orderkey") % 6).cast("string")).alias("owner")
    )
    return merge.update_only(target, owners, "id", ["owner"])


@query("snk09_replace_by_key", """
SELECT l_orderkey AS id, l_partkey AS part, l_quantity AS amount FROM lineitem WHERE l_orderkey % 10 <> 3
UNION ALL SELECT o_orderkey, -1, o_totalprice FROM orders WHERE o_orderkey % 10 = 3 AND o_orderstatus = 'F'""")
def snk09(spark, sf):
    old = base(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"), F.col("l_quantity").alias("amount"))
    done = base(spark, sf, "orders").where("o_orderkey % 10 = 3")
    new = done.where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("id"), F.lit(-1).cast("bigint").alias("part"), F.col("o_totalprice").alias("amount")
    )
    return merge.replace_by_key(old, done.select(F.col("o_orderkey").alias("id")), new, "id")


@query("snk10_retention", """
SELECT 'orders' AS table_name, count(*) FILTER (WHERE o_orderdate < TIMESTAMP '2002-01-01' - INTERVAL 365 DAY) AS deleted,
  count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2002-01-01' - INTERVAL 365 DAY) AS kept FROM orders
UNION ALL SELECT 'lineitem', count(*) FILTER (WHERE l_shipdate < TIMESTAMP '2002-01-01' - INTERVAL 365 DAY),
  count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '2002-01-01' - INTERVAL 365 DAY) FROM lineitem""")
def snk10(spark, sf):
    frames = {
        "orders": base(spark, sf, "orders").select(F.col("o_orderdate").alias("loaded_at")),
        "lineitem": base(spark, sf, "lineitem").select(F.col("l_shipdate").alias("loaded_at")),
    }
    return merge.removal_report(frames, "loaded_at", ORDERS_AS_OF, 365)


@query("snk10_retained_rows", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2002-01-01' - INTERVAL 365 DAY")
def snk10_rows(spark, sf):
    return merge.retained(base(spark, sf, "orders"), "o_orderdate", ORDERS_AS_OF, 365).select("o_orderkey")


@query("snk12_chunk_documents", """
SELECT county_id, CAST((rn - 1) // 500 AS BIGINT) AS chunk_index, CAST(ceil(n / 500) AS BIGINT) AS total_chunks, count(*) AS parcel_count, min(k) AS first_key,
  county_id || '/chunk_' || lpad('' || ((rn - 1) // 500), 4, '0') || '.json' AS path FROM (
  SELECT *, row_number() OVER (PARTITION BY county_id ORDER BY ok, pk, sk, ln) AS rn, count(*) OVER (PARTITION BY county_id) AS n FROM (
    SELECT 'county_' || (l_suppkey % 5) AS county_id, l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln, l_orderkey AS k FROM lineitem)) GROUP BY ALL""")
def snk12(spark, sf):
    rows = base(spark, sf, "lineitem").select(
        F.concat(F.lit("county_"), (F.col("l_suppkey") % 5).cast("string")).alias("county_id"),
        F.col("l_orderkey").alias("ok"), F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"), F.col("l_linenumber").alias("ln"),
    )
    root = new_folder(spark, "snk12")
    docs = store.chunk_documents(rows, "county_id", ["ok", "pk", "sk", "ln"], 500)
    store.export(docs, root)
    back = spark.read.schema(docs.schema).json(root)
    keys = F.from_json("document", "parcels array<struct<ok: bigint>>")["parcels"]
    return back.select(
        "county_id", "chunk_index", "total_chunks", F.size(keys).cast("bigint").alias("parcel_count"), keys[0]["ok"].alias("first_key"), "path"
    )


@query("snk13_export", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def snk13(spark, sf):
    root = new_folder(spark, "snk13")
    rows = base(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    store.export(rows, root, "csv")
    return spark.read.schema(rows.schema).option("header", True).csv(root)


@query("snk14_batch_plan", """
SELECT state_code, CAST(ceil(rn / 100) AS BIGINT) AS batch_number, CAST(ceil(n / 100) AS BIGINT) AS total_batches, count(*) AS batch_size, min(id) AS first_id, max(id) AS last_id FROM (
  SELECT state_code, id, row_number() OVER (PARTITION BY state_code ORDER BY id) AS rn, count(*) OVER (PARTITION BY state_code) AS n FROM (
    SELECT CASE WHEN o_custkey % 3 = 0 THEN 'TX' ELSE o_orderpriority END AS state_code, o_orderkey AS id FROM orders)) GROUP BY ALL""")
def snk14(spark, sf):
    rows = base(spark, sf, "orders").select(
        F.when(F.col("o_custkey") % 3 == 0, "TX").otherwise(F.col("o_orderpriority")).alias("state_code"), F.col("o_orderkey").alias("id")
    )
    out = store.batch_plan(rows, "state_code", "id")
    return out.select(
        "state_code", "batch_number", "total_batches", F.col("batch_size").cast("bigint").alias("batch_size"),
        F.col("keys")[0].alias("first_id"), F.element_at("keys", -1).alias("last_id"),
    )


@query("snk15_delete_keys", """SELECT event_id, event_type FROM events WHERE event_type NOT LIKE 'cl%' AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)
  AND event_id >= 100""")
def snk15(spark, sf):
    rows = base(spark, sf, "events").withColumn("ttl", F.col("event_id"))
    gone = base(spark, sf, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("user_id"))
    left = merge.without_keys(rows, "event_type", prefix="cl")
    return merge.without_keys(merge.without_keys(left, "user_id", keys=gone), "event_id", expired_before=F.lit(100)).select("event_id", "event_type")


@query("snk01_append_raw", """SELECT county, count(*) AS documents FROM (SELECT CASE WHEN event_id % 7 = 0 THEN 'UNKNOWN' ELSE upper(county) END AS county FROM load_log
  UNION ALL SELECT 'COUNTY_X' FROM load_log WHERE event_id % 5 = 0) GROUP BY 1""", "load_log")
def snk01(spark, sf):
    root = new_folder(spark, "snk01")
    log = table(spark, sf, "load_log").select("event_id", "county")
    store.append_raw(log.withColumn("county", F.when(F.col("event_id") % 7 != 0, F.col("county"))), root)
    store.append_raw(log.where("event_id % 5 = 0").withColumn("county", F.lit("county_x ")), root)
    return spark.read.parquet(root).groupBy("county").agg(F.count(F.lit(1)).alias("documents"))


@query("snk02_load_modes", "SELECT (SELECT count(*) FROM orders) AS first_load, 2 * (SELECT count(*) FROM orders) AS after_append, (SELECT count(*) FROM customer) AS after_replace")
def snk02(spark, sf):
    root = new_folder(spark, "snk02")
    orders = base(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    first = store.load_frame(orders, root, "fail")
    store.load_frame(orders, root, "append")
    appended = spark.read.parquet(root).count()
    replaced = store.load_frame(base(spark, sf, "customer").select(F.col("c_custkey").alias("id")), root, "replace")
    return spark.createDataFrame([(first, appended, replaced)], "first_load bigint, after_append bigint, after_replace bigint")


@query("snk16_table_ddl", """SELECT column_name, data_type, filled FROM (VALUES ('o_orderkey', 'BIGINT', (SELECT count(o_orderkey) FROM orders)), ('o_custkey', 'BIGINT', (SELECT count(o_custkey) FROM orders)),
  ('o_orderstatus', 'STRING', (SELECT count(o_orderstatus) FROM orders)), ('o_totalprice', 'DOUBLE', (SELECT count(o_totalprice) FROM orders)),
  ('o_orderdate', 'TIMESTAMP_NTZ', (SELECT count(o_orderdate) FROM orders)), ('o_orderpriority', 'STRING', (SELECT count(o_orderpriority) FROM orders))) AS t(column_name, data_type, filled)""")
def snk16(spark, sf):
    orders = base(spark, sf, "orders")
    kinds = {f.name: store.column_type(f.name, f.dataType.simpleString()) for f in orders.schema.fields}
    # Every column is cast to its declared type, and the filled values of each are counted.
    one = orders.agg(*[F.count(F.col(c).cast(k)).alias(c) for c, k in kinds.items()])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("data_type"), F.col(c).alias("filled")) for c, k in kinds.items()]
    return one.select(F.inline(F.array(*rows)))


@query("snap01_scd2", """
SELECT o_custkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS valid_from, strftime(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate), '%Y-%m-%d') AS valid_to,
  lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) IS NULL AS is_current, price FROM (SELECT o_custkey, o_orderdate, max(o_totalprice) AS price FROM orders GROUP BY 1, 2)""")
def snap01(spark, sf):
    changes = base(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("updated_at"), F.col("o_totalprice").alias("price"))
    out = merge.history(changes, "id", "updated_at")
    day = "yyyy-MM-dd"
    return out.select("id", F.date_format("valid_from", day).alias("valid_from"), F.date_format("valid_to", day).alias("valid_to"), "is_current", "price")


@query("state01_last_success", """SELECT event_type AS job, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_run,
  strftime(max(CASE WHEN event_id % 4 <> 0 THEN ts END), '%Y-%m-%d %H:%M:%S') AS last_success FROM events GROUP BY 1""")
def state01(spark, sf):
    log = base(spark, sf, "events").select(
        F.col("event_type").alias("job"), F.col("ts").alias("end_time"), F.when(F.col("event_id") % 4 != 0, "completed").otherwise("failed").alias("status")
    )
    stamp = "yyyy-MM-dd HH:mm:ss"
    out = store.last_successful_run(log)
    return out.select("job", F.date_format("last_run", stamp).alias("last_run"), F.date_format("last_success", stamp).alias("last_success"))


PROGRESS = """ p AS (SELECT user_id % 10 AS job_id, CAST(1000000 AS BIGINT) AS total, CAST(sum(event_id % 100) AS BIGINT) AS processed, CAST(sum(event_id % 3) AS BIGINT) AS failed,
   min(ts) AS s, max(ts) AS u FROM events GROUP BY 1),
 q AS (SELECT *, greatest(total - processed, 0) AS remaining, processed / ((epoch_us(u) - epoch_us(s)) / 3.6e9) AS rate FROM p),
 progress AS (SELECT job_id, total, processed, failed, remaining, round(rate, 4) AS rate_per_hour, CASE WHEN remaining = 0 THEN 'completed' WHEN processed > 0 THEN 'running' ELSE 'pending' END AS status,
   strftime(make_timestamp(CAST(epoch_us(TIMESTAMP '2024-01-31') + remaining / rate * 3.6e9 AS BIGINT)), '%Y-%m-%d %H:%M') AS estimated_completion,
   CASE WHEN remaining = 0 THEN strftime(u, '%Y-%m-%d %H:%M:%S') END AS completed_at, strftime(u, '%Y-%m-%d %H:%M:%S') AS updated_at FROM q)"""


def _progress(spark, sf):
    batches = base(spark, sf, "events").select(
        (F.col("user_id") % 10).alias("job_id"), F.lit(1000000).cast("bigint").alias("total"), (F.col("event_id") % 100).alias("processed"),
        (F.col("event_id") % 3).alias("failed"), F.col("ts").alias("started_at"), F.col("ts").alias("finished_at"),
    )
    return store.job_progress(batches, EVENTS_AS_OF)


def _shown(progress):
    stamp = "yyyy-MM-dd HH:mm:ss"
    return progress.select(
        "job_id", "total", "processed", "failed", "remaining", F.round("rate_per_hour", 4).alias("rate_per_hour"), "status",
        F.date_format("estimated_completion", "yyyy-MM-dd HH:mm").alias("estimated_completion"), F.date_format("completed_at", stamp).alias("completed_at"),
        F.date_format("updated_at", stamp).alias("updated_at"),
    )


@query("state02_job_progress", f"WITH {PROGRESS} SELECT * FROM progress")
def state02(spark, sf):
    return _shown(_progress(spark, sf))


@query("state02_status_listing", f"""WITH {PROGRESS}, listed AS (SELECT *, row_number() OVER (PARTITION BY status ORDER BY updated_at DESC, job_id) AS place FROM progress)
SELECT status, job_id, updated_at, place FROM listed UNION ALL SELECT 'job 3', job_id, updated_at, 1 FROM progress WHERE job_id = 3""")
def state02_listing(spark, sf):
    """Listings by state and by job, newest first."""
    progress = _progress(spark, sf).withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss")).persist()
    out = None
    asked = [(s, {"status": s}) for s in ("completed", "running", "pending")] + [("job 3", {"job": 3})]
    for name, which in asked:
        rows = store.progress_listing(progress, **which).withColumn("place", F.monotonically_increasing_id())
        rows = rows.select(F.lit(name).alias("status"), "job_id", "updated_at", "place")
        out = rows if out is None else out.unionByName(rows)
    place = F.row_number().over(Window.partitionBy("status").orderBy("place")).cast("bigint")
    return out.withColumn("place", place)


@query("state02_tracked_stream", """SELECT 'load' AS job_id, count(*) FILTER (WHERE event_type <> 'error') AS processed, count(*) FILTER (WHERE event_type = 'error') AS failed,
  count(*) AS stored, 3 AS batches, true AS in_order FROM events""")
def state02_stream(spark, sf):
    """A streaming load of three files whose figures are counted while it writes; a second run adds nothing."""
    root, events = new_folder(spark, "state02"), base(spark, sf, "events")
    events.repartition(3).write.parquet(f"{root}/in")
    for _ in range(2):
        stream = jobs.file_stream(spark, f"{root}/in", events.schema, pattern="*.parquet", per_batch=1)
        jobs.tracked(stream, f"{root}/out", f"{root}/progress", "load", F.col("event_type") == "error", f"{root}/checkpoint").awaitTermination()
    figures = spark.read.parquet(f"{root}/progress").drop("job", "batch")
    progress = store.job_progress(figures, EVENTS_AS_OF)
    counted = figures.agg(F.count(F.lit(1)).cast("int").alias("batches"), F.bool_and(F.col("started_at") <= F.col("finished_at")).alias("in_order"))
    stored = spark.read.parquet(f"{root}/out").agg(F.count(F.lit(1)).alias("stored"))
    return progress.select("job_id", "processed", "failed").withColumns(
        {"stored": stored.scalar(), "batches": counted.select("batches").scalar(), "in_order": counted.select("in_order").scalar()}
    )
