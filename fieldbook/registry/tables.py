"""Domain tables derived from the driver's tables.

Each definition is plain SQL that Spark and the comparison engine both accept (integer arithmetic,
CASE, casts to double/bigint), so a query and its SQL start from the same rows. Every definition is
a projection or a combinable aggregate over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldbook.operators.dimensions import CROP_CATEGORIES, CROP_NAMES, LAND_COVER_CLASSES

AS_OF = "2002-01-01 00:00:00"
AS_OF_EPOCH = 1009843200
STATES = "TX IA IL NE CO OK NM KS CA FL GA AK HI PR MN WA MO OH IN WI AR MS AL NC SD".split()
LAND_CODES = [row[0] for row in LAND_COVER_CLASSES]
CROP_CODES = [*CROP_NAMES, 9, 240]


def case_of(expr: str, values, text: bool) -> str:
    """CASE over ``expr % n`` picking from a list."""
    quote = "'" if text else ""
    arms = " ".join(f"WHEN {i} THEN {quote}{v}{quote}" for i, v in enumerate(values))
    return f"CASE {expr} % {len(values)} {arms} END"


TABLES: dict[str, str] = {
    # One row per customer: a parcel with coordinates, acreage, state and creation time.
    "parcels": f"""
        SELECT 'P' || c_custkey AS parcel_id, c_custkey AS k,
          CASE WHEN c_custkey % 17 = 16 THEN NULL ELSE (25000 + c_custkey * 7919 % 24000) / 1000e0 END AS latitude,
          CASE WHEN c_custkey % 17 = 16 THEN NULL ELSE (c_custkey * 104729 % 59000 - 125000) / 1000e0 END AS longitude,
          'county_' || (c_custkey % 50) AS county_id,
          {case_of("c_nationkey", STATES, True)} AS state_code,
          (c_acctbal + 1000) / 20e0 AS acres,
          c_custkey * 7919 % 5184000 + 1004572800 AS created_epoch
        FROM customer""",
    "stations": f"""
        SELECT 'S' || s_suppkey AS station_id, s_suppkey AS k, s_name AS station_name,
          (25000 + s_suppkey * 6661 % 24000) / 1000e0 AS latitude,
          (s_suppkey * 92821 % 59000 - 125000) / 1000e0 AS longitude,
          {case_of("s_nationkey", STATES, True)} AS state_code,
          (s_suppkey % 10) / 10e0 AS data_coverage,
          2020 + s_suppkey % 6 AS max_year
        FROM supplier""",
    # Two climate years for two stations of three.
    "station_climate": """
        SELECT 'S' || s_suppkey AS station_id, 2022 AS data_year, 20 + (s_suppkey * 31 + 2022) % 40 AS precipitation,
          40 + (s_suppkey * 17 + 2022) % 45 AS avg_temperature FROM supplier WHERE s_suppkey % 3 <> 0
        UNION ALL
        SELECT 'S' || s_suppkey AS station_id, 2023 AS data_year, 20 + (s_suppkey * 31 + 2023) % 40 AS precipitation,
          40 + (s_suppkey * 17 + 2023) % 45 AS avg_temperature FROM supplier WHERE s_suppkey % 3 <> 0""",
    "land_cover": f"""
        SELECT 'P' || l_orderkey AS parcel_id, {case_of("l_partkey", LAND_CODES, False)} AS nlcd_code,
          1995 + l_linenumber AS nlcd_year, l_quantity AS area,
          CASE WHEN l_linestatus = 'F' THEN 'polygon' ELSE 'point_sample' END AS processing_method
        FROM lineitem""",
    "topography": """
        SELECT 'P' || l_partkey AS parcel_id, l_extendedprice / 100e0 AS mean_elevation_ft,
          l_extendedprice / 100e0 + l_quantity AS max_elevation_ft, 'US_Feet' AS elevation_units,
          CASE WHEN l_linestatus = 'F' THEN 'bulk_points' ELSE 'raster_sampling' END AS processing_method,
          l_discount * 200 AS slope_degrees, l_orderkey AS topo_id, l_linenumber AS topo_line
        FROM lineitem""",
    "crop_history": f"""
        SELECT 'P' || l_orderkey AS parcel_id, 2015 + l_linenumber AS crop_year,
          {case_of("l_suppkey", CROP_CODES, False)} AS crop_code,
          {case_of("l_suppkey", STATES, True)} AS state_code, l_returnflag <> 'R' AS query_success,
          l_quantity AS acres
        FROM lineitem""",
    # Published county statistics with thousands separators and suppressed values.
    "county_stats": f"""
        SELECT 'county_' || (l_suppkey % 50) AS county_name, {case_of("l_suppkey", STATES, True)} AS state_code,
          2010 + l_linenumber AS year,
          {case_of("l_partkey", ["CORN", "SOYBEANS", "WHEAT", "HAY", "CATTLE"], True)} AS commodity_desc,
          CASE WHEN l_partkey % 5 = 4 THEN
              CASE l_orderkey % 3 WHEN 0 THEN 'CATTLE, INCL CALVES - INVENTORY' WHEN 1 THEN 'CATTLE, COWS, BEEF - INVENTORY'
                ELSE 'CATTLE - OPERATIONS' END
            ELSE 'SERIES ' || (l_orderkey % 4) END AS short_desc,
          CASE WHEN l_partkey % 5 = 4 THEN CASE l_orderkey % 3 WHEN 2 THEN 'OPERATIONS' ELSE 'HEAD' END
            WHEN l_orderkey % 11 = 0 THEN 'TONS' ELSE 'BU / ACRE' END AS unit_desc,
          CASE l_linenumber % 5 WHEN 0 THEN '(D)' WHEN 1 THEN '1,' || (100 + l_partkey % 900)
            WHEN 2 THEN ' ' || (l_partkey % 900) || ' ' WHEN 3 THEN '$' || (l_orderkey % 97) || '.5'
            ELSE '' || (l_suppkey % 300) END AS value_text,
          CASE WHEN l_linestatus = 'F' THEN 'SURVEY' ELSE 'CENSUS' END AS source_desc,
          l_orderkey AS ok, l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln
        FROM lineitem""",
    "companies": f"""
        SELECT s_suppkey AS company_id, 'Supplier#' || s_suppkey AS company_name,
          {case_of("s_suppkey", ["Agriculture", "Food Production", "Software", "Real Estate", "Livestock"], True)} AS company_industry,
          s_acctbal * 2000 AS company_revenue, s_suppkey * 37 % 1200 AS company_size,
          {case_of("s_nationkey", STATES, True)} AS company_state,
          {case_of("s_suppkey", ["Pleasant Valley", "Austin", "Prairie City", "Denver"], True)} AS company_city
        FROM supplier""",
    "deals": """
        SELECT o_orderkey AS deal_id, 'owner_' || (o_custkey % 6) AS owner_id, o_custkey AS contact_key,
          o_totalprice / 4e0 AS amount, o_orderdate AS createdate,
          CASE o_orderkey % 7 WHEN 0 THEN 'appointmentscheduled' WHEN 1 THEN 'qualifiedtobuy'
            WHEN 2 THEN 'presentationscheduled' WHEN 3 THEN 'decisionmakerboughtin' WHEN 4 THEN 'contractsent'
            WHEN 5 THEN 'closedwon' ELSE 'closedlost' END AS dealstage,
          (o_orderkey * 13 % 101) / 100e0 AS stage_probability,
          o_orderkey * 31 % 120 AS days_open, o_orderstatus <> 'O' AS is_closed
        FROM orders""",
    "contacts": """
        SELECT c_custkey AS contact_id,
          CASE WHEN c_custkey % 19 = 18 THEN NULL ELSE 'First' || c_custkey END AS firstname,
          CASE WHEN c_custkey % 23 = 22 THEN NULL ELSE 'Last' || c_custkey END AS lastname,
          CASE WHEN c_custkey % 29 = 28 THEN NULL ELSE 'user' || c_custkey || '@' ||
            CASE c_custkey % 6 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'farmco.com' WHEN 2 THEN 'acme' || (c_custkey % 40) || '.com'
              WHEN 3 THEN 'Yahoo.com' WHEN 4 THEN 'landtrust.org' ELSE 'biz.net' END END AS email,
          CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE '555-' || c_custkey END AS phone,
          CASE WHEN c_custkey % 13 = 12 THEN NULL
            WHEN c_custkey % 5 = 0 THEN 'Prairie Land Farm Holdings ' || c_custkey
            WHEN c_custkey % 5 = 1 THEN 'Family Farm Trust ' || c_custkey
            ELSE 'Supplier#' || (c_custkey * 7 % 120) END AS company,
          CASE c_custkey % 4 WHEN 0 THEN 'Owner' WHEN 1 THEN 'Analyst' WHEN 2 THEN 'President' ELSE NULL END AS jobtitle,
          CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'subscriber' WHEN 'MACHINERY' THEN 'lead'
            WHEN 'BUILDING' THEN 'marketingqualifiedlead' WHEN 'AUTOMOBILE' THEN 'opportunity' ELSE 'customer' END AS lifecyclestage,
          CASE c_custkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'referral' ELSE NULL END AS leadsource,
          c_custkey * 7919 % 94608000 + 915148800 AS created_epoch,
          c_custkey * 7919 % 94608000 + 915148800 + c_custkey * 104729 % 200000 AS modified_epoch,
          c_acctbal AS acctbal
        FROM customer""",
    # Load log: one row per event.
    "load_log": """
        SELECT event_id, ts AS ingestion_timestamp, event_type AS ingestion_type,
          'county_' || (user_id % 10) AS county, user_id % 10 AS county_no,
          CASE WHEN event_type = 'error' AND user_id % 10 < 4 THEN 'malformed' ELSE NULL END AS error_text,
          event_id % 500 + 1 AS parcel_count
        FROM events""",
    # Scored contacts: deterministic stand-ins for model outputs, so rule operators can be compared.
    "scored": """
        SELECT c_custkey AS id, 'user' || c_custkey || '@biz.net' AS email, 'Company ' || (c_custkey % 37) AS company,
          c_custkey * 7919 % 1001 / 1000e0 AS lead_score, c_custkey * 104729 % 1001 / 1000e0 AS churn_risk_score,
          CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'subscriber' WHEN 'MACHINERY' THEN 'lead'
            WHEN 'BUILDING' THEN 'marketingqualifiedlead' WHEN 'AUTOMOBILE' THEN 'salesqualifiedlead'
            ELSE 'customer' END AS lifecyclestage,
          c_custkey * 31 % 200 AS days_since_created, c_custkey * 17 % 150 AS days_since_last_activity,
          c_custkey * 13 % 101 / 100e0 AS engagement_score,
          CASE WHEN c_custkey % 11 = 10 THEN NULL ELSE c_custkey * 29 % 101 / 100e0 END AS completeness_score,
          c_custkey % 5 AS total_deals,
          CASE c_custkey % 3 WHEN 0 THEN 'Enterprise Landowners' WHEN 1 THEN 'Small Farms' ELSE 'Segment_0' END AS predicted_segment,
          CASE c_custkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'referral' ELSE NULL END AS leadsource,
          'industry_' || (c_nationkey % 7) AS company_industry,
          c_custkey * 7919 % 94608000 + 915148800 AS created_epoch,
          c_custkey % 6 <> 0 AS is_business_email, c_custkey % 4 <> 3 AS has_phone
        FROM customer""",
}

TABLES["classes"] = "SELECT * FROM (VALUES {}) AS t(nlcd_code, class_name, class_category, class_color, is_agricultural, is_natural)".format(
    ", ".join(str(row).replace("True", "true").replace("False", "false") for row in LAND_COVER_CLASSES)
)
TABLES["crops"] = "SELECT * FROM (VALUES {}) AS t(crop_code, crop_name, crop_category)".format(
    ", ".join(
        f"({code}, '{name}', '{next((k for k, v in CROP_CATEGORIES.items() if code in v), 'Other')}')"
        for code, name in CROP_NAMES.items()
    )
)

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def with_tables(names: list[str], sql: str) -> str:
    """``WITH name AS (…) …`` in front of a query (merging with a leading WITH of its own)."""
    if not names:
        return sql.strip()
    ctes = ", ".join(f"{n} AS ({TABLES[n]})" for n in names)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


def base(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a tiny single-file input to all cores; inputs with enough splits pass unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A base table, or a derived table over the base tables it names."""
    if name in BASE:
        return base(spark, sf, name)
    text = TABLES[name]
    used = [b for b in BASE if f"FROM {b}" in text]
    for b in used:
        text = text.replace(f"FROM {b}", f"FROM {{{b}}}")
    frames = {b: base(spark, sf, b) for b in used}
    return spark.sql(text, **{b: spread(df) if b == "lineitem" else df for b, df in frames.items()})
