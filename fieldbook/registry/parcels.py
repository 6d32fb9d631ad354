"""Staging and curation queries over the raw documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldbook.functions.documents import explode_variants, parse_or_salvage, shape_of
from fieldbook.functions.values import surrogate_key, text_or
from fieldbook.operators import curation, staging
from fieldbook.plans.parcels import curated_parcels
from fieldbook.registry import query
from fieldbook.registry.raw_documents import AS_OF, parcel_sql, raw_documents


def _staged(spark, sf):
    return staging.stage_parcels(raw_documents(spark, sf), AS_OF, retention_days=None, numbers=[])


def _parsed(spark, sf, fields=None):
    """Parcels with the fields that the query goes on to use; the planner does not prune what is read from a text."""
    return staging.extract_fields(staging.flatten_parcels(raw_documents(spark, sf), fields), fields)


FLAG = """CASE WHEN parcel_id IS NULL THEN 'missing_id' WHEN acres IS NULL OR acres <= 0 THEN 'invalid_acres'
  WHEN NOT has_geometry THEN 'missing_geometry' ELSE 'valid' END"""
RECORD_ID = "md5(file_name || '-' || l_linenumber || '-' || idx)"
LATEST = f"""
 staged AS (SELECT *, {FLAG} AS flag, {RECORD_ID} AS record_id,
    coalesce(lower(land_use_description) SIMILAR TO '.*(farm|agriculture|crop|pasture|ranch).*', false) AS farm FROM fields),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY l_shipdate DESC, record_id DESC) AS rn
    FROM staged WHERE flag = 'valid'),
 latest AS (SELECT *, trim(property_type) AS ptype,
    CASE WHEN acres > 0 THEN round(assessed_value, 2) / acres END AS per_acre FROM ranked WHERE rn = 1),
 categories AS (SELECT *, CASE WHEN lower(ptype) LIKE '%residential%' THEN 'Residential' WHEN lower(ptype) LIKE '%commercial%' THEN 'Commercial'
      WHEN lower(ptype) LIKE '%industrial%' THEN 'Industrial' WHEN lower(ptype) LIKE '%agricultural%' OR farm THEN 'Agricultural'
      WHEN lower(ptype) LIKE '%vacant%' THEN 'Vacant' ELSE 'Other' END AS property_category FROM latest)"""


def latest_sql(select):
    """SQL over the newest valid record of each parcel."""
    return parcel_sql("").rstrip() + "," + LATEST + select


@query("p01_flatten", parcel_sql("""
SELECT file_name, CAST(l_linenumber AS BIGINT) AS file_row_number, CAST(idx AS BIGINT) AS parcel_index, parcel_id FROM fields"""))
def p01(spark, sf):
    flat = staging.flatten_parcels(raw_documents(spark, sf))
    return flat.select(
        "file_name", "file_row_number", F.col("parcel_index_in_chunk").cast("bigint").alias("parcel_index"),
        F.col("parcel.id").alias("parcel_id"),
    )


@query("p02_typed_fields", parcel_sql("""
SELECT parcel_id, state, parcel_county, address, city, zip_code, owner_name, acres, property_type, land_use_description,
  CAST(year_built AS BIGINT) AS year_built, CAST(building_count AS BIGINT) AS building_count, has_geometry FROM fields"""))
def p02(spark, sf):
    return _parsed(spark, sf).select(
        "parcel_id", "state", "parcel_county", "address", "city", "zip_code", "owner_name", "acres", "property_type",
        "land_use_description", F.col("year_built").cast("bigint").alias("year_built"), "building_count",
        F.col("geometry_json").isNotNull().alias("has_geometry"),
    )


@query("p03_alias_resolution", parcel_sql("""
SELECT parcel_id, round(assessed_value, 2) AS assessed_value, round(market_value, 2) AS market_value,
  round(tax_amount, 2) AS tax_amount, CAST(tax_year AS BIGINT) AS tax_year, round(improvement_value, 2) AS improvement_value,
  round(land_value, 2) AS land_value FROM fields"""))
def p03(spark, sf):
    money = ["assessed_value", "market_value", "tax_amount", "improvement_value", "land_value"]
    return _parsed(spark, sf, ["parcel_id", "tax_year", *money]).select(
        "parcel_id", *[F.col(c).cast("double").alias(c) for c in money], F.col("tax_year").cast("bigint").alias("tax_year")
    )


@query("p04_clean_columns", parcel_sql("""
SELECT parcel_id, upper(trim(state)) AS state, upper(trim(coalesce(parcel_county, county))) AS county_name,
  trim(address) AS address, trim(city) AS city, trim(zip_code) AS zip_code FROM fields"""))
def p04(spark, sf):
    cleaned = staging.clean_columns(_parsed(spark, sf, staging.TEXT_FIELDS))
    return cleaned.select("parcel_id", "state", "county_name", "address", "city", "zip_code")


@query("p05_default_text", parcel_sql("""
SELECT parcel_id, coalesce(nullif(trim(address), ''), 'Address Not Available') AS address,
  coalesce(nullif(trim(city), ''), 'Unknown') AS city, coalesce(nullif(trim(owner_name), ''), 'Owner Not Available') AS owner_name
FROM fields"""))
def p05(spark, sf):
    return _parsed(spark, sf, ["parcel_id", "address", "city", "owner_name"]).select(
        "parcel_id", text_or("address", "Address Not Available").alias("address"),
        text_or("city", "Unknown").alias("city"), text_or("owner_name", "Owner Not Available").alias("owner_name"),
    )


@query("p06_range_guards", parcel_sql("""
SELECT parcel_id, CASE WHEN acres > 0 AND acres < 100000 THEN acres END AS acres,
  CASE WHEN tax_year BETWEEN 1900 AND 2002 THEN CAST(tax_year AS BIGINT) END AS tax_year,
  CASE WHEN year_built BETWEEN 1800 AND 2002 THEN CAST(year_built AS BIGINT) END AS year_built,
  CASE WHEN building_count >= 0 AND building_count < 1000 THEN CAST(building_count AS BIGINT) END AS building_count,
  CASE WHEN assessed_value > 0 AND assessed_value < 1000000000 THEN round(assessed_value, 2) END AS assessed_value,
  CASE WHEN tax_amount >= 0 AND tax_amount < 10000000 THEN round(tax_amount, 2) END AS tax_amount FROM fields"""))
def p06(spark, sf):
    guarded = _parsed(spark, sf).withColumns(curation.range_guards(AS_OF.year))
    return guarded.select(
        "parcel_id", "acres", F.col("tax_year").cast("bigint").alias("tax_year"),
        F.col("year_built").cast("bigint").alias("year_built"), "building_count",
        F.col("assessed_value").cast("double").alias("assessed_value"), F.col("tax_amount").cast("double").alias("tax_amount"),
    )


@query("p07_zip_check", parcel_sql("""
SELECT parcel_id, trim(zip_code) AS given, CASE WHEN regexp_full_match(trim(zip_code), '[0-9]{5}') THEN trim(zip_code) END AS zip_code FROM fields"""))
def p07(spark, sf):
    given = F.trim("zip_code")
    return _parsed(spark, sf, ["parcel_id", "zip_code"]).select("parcel_id", given.alias("given"), curation.valid_zip(given).alias("zip_code"))


@query("p08_ratios", parcel_sql("""
SELECT parcel_id, round(CASE WHEN acres > 0 THEN round(assessed_value, 2) / acres END, 6) AS assessed_value_per_acre,
  round(CASE WHEN market_value > 0 AND assessed_value > 0 THEN round(assessed_value, 2) / round(market_value, 2) END, 6) AS assessment_ratio FROM fields"""))
def p08(spark, sf):
    out = staging.add_ratios(_parsed(spark, sf, ["parcel_id", "acres", "assessed_value", "market_value"]))
    return out.select(
        "parcel_id", F.round("assessed_value_per_acre", 6).alias("assessed_value_per_acre"),
        F.round("assessment_ratio", 6).alias("assessment_ratio"),
    )


@query("p09_buckets", parcel_sql("""
SELECT CASE WHEN acres IS NULL THEN 'unknown' WHEN acres < 1 THEN 'small' WHEN acres BETWEEN 1 AND 10 THEN 'medium'
    WHEN acres BETWEEN 10 AND 100 THEN 'large' ELSE 'very_large' END AS size_category,
  CASE WHEN assessed_value IS NULL THEN 'Unknown' WHEN assessed_value < 50000 THEN 'Low Value'
    WHEN assessed_value BETWEEN 50000 AND 200000 THEN 'Medium Value' WHEN assessed_value BETWEEN 200000 AND 500000 THEN 'High Value'
    ELSE 'Premium Value' END AS value_category,
  CASE WHEN year_built IS NULL THEN 'Unknown' WHEN year_built >= 1992 THEN 'New (0-10 years)' WHEN year_built >= 1972 THEN 'Modern (11-30 years)'
    WHEN year_built >= 1952 THEN 'Mature (31-50 years)' ELSE 'Historic (50+ years)' END AS age_category,
  count(*) AS parcels FROM fields GROUP BY ALL"""))
def p09(spark, sf):
    return (
        _parsed(spark, sf, ["acres", "assessed_value", "year_built"])
        .groupBy(
            staging.size_category(F.col("acres")).alias("size_category"),
            curation.value_category(F.col("assessed_value")).alias("value_category"),
            curation.age_category(F.col("year_built"), AS_OF.year).alias("age_category"),
        )
        .agg(F.count(F.lit(1)).alias("parcels"))
    )


@query("p10_farm_flag", parcel_sql("""
SELECT land_use_description, coalesce(lower(land_use_description) LIKE '%farm%' OR lower(land_use_description) LIKE '%agriculture%'
  OR lower(land_use_description) LIKE '%crop%' OR lower(land_use_description) LIKE '%pasture%' OR lower(land_use_description) LIKE '%ranch%', false) AS is_agricultural,
  count(*) AS n FROM fields GROUP BY ALL"""))
def p10(spark, sf):
    return (
        _parsed(spark, sf, ["land_use_description"])
        .groupBy("land_use_description", staging.is_farm_use(F.col("land_use_description")).alias("is_agricultural"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("p11_property_category", latest_sql("""
SELECT parcel_id, property_category, CASE WHEN assessed_value IS NULL OR acres IS NULL THEN NULL
  WHEN farm AND acres > 10 AND per_acre < 10000 THEN 'High'
  WHEN property_category = 'Residential' AND assessed_value BETWEEN 100000 AND 300000 THEN 'Medium'
  WHEN property_category = 'Commercial' AND assessed_value > 200000 THEN 'High' ELSE 'Low' END AS investment_potential FROM categories"""))
def p11(spark, sf):
    return curation.curate_parcels(_staged(spark, sf), AS_OF, ["parcel_id", "property_category", "investment_potential"])


@query("p12_record_keys", parcel_sql(f"""
SELECT file_name, CAST(idx AS BIGINT) AS parcel_index, {RECORD_ID} AS record_id,
  md5(coalesce(parcel_id, '~null~') || '-' || coalesce(owner_name, '~null~') || '-' || coalesce(address, '~null~')) AS change_key FROM fields"""))
def p12(spark, sf):
    return _parsed(spark, sf, ["parcel_id", "owner_name", "address"]).select(
        "file_name", F.col("parcel_index_in_chunk").cast("bigint").alias("parcel_index"),
        surrogate_key("file_name", "file_row_number", "parcel_index_in_chunk").alias("record_id"),
        surrogate_key("parcel_id", "owner_name", "address").alias("change_key"),
    )


@query("p13_retention", """
SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-10-03 00:00:00'""")
def p13(spark, sf):
    from fieldbook.registry.tables import base

    rows = base(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    return staging.recent(rows, AS_OF, 90, "l_shipdate").drop("l_shipdate")


@query("p14_quality_flag", parcel_sql(f"SELECT {FLAG} AS data_quality_flag, count(*) AS n FROM fields GROUP BY 1"))
def p14(spark, sf):
    return _parsed(spark, sf, ["parcel_id", "acres", "geometry_json"]).groupBy(staging.quality_flag().alias("data_quality_flag")).agg(F.count(F.lit(1)).alias("n"))


@query("w01_latest_per_parcel", latest_sql("""
SELECT parcel_id, record_id, strftime(l_shipdate, '%Y-%m-%d') AS ingested FROM latest"""))
def w01(spark, sf):
    return curation.latest_parcels(_staged(spark, sf), ["ingestion_timestamp", "record_id"]).select(
        "parcel_id", "record_id", F.date_format("ingestion_timestamp", "yyyy-MM-dd").alias("ingested")
    )


@query("curated_parcels", latest_sql("""
SELECT parcel_id, upper(trim(state)) AS state, upper(trim(coalesce(parcel_county, county))) AS county_name,
  coalesce(nullif(trim(address), ''), 'Address Not Available') AS address, coalesce(nullif(trim(city), ''), 'Unknown') AS city,
  CASE WHEN regexp_full_match(trim(zip_code), '[0-9]{5}') THEN trim(zip_code) END AS zip_code,
  coalesce(nullif(trim(owner_name), ''), 'Owner Not Available') AS owner_name, acres,
  coalesce(nullif(ptype, ''), 'Unknown') AS property_type, round(assessed_value, 2) AS assessed_value,
  round(market_value, 2) AS market_value, CASE WHEN year_built BETWEEN 1800 AND 2002 THEN CAST(year_built AS BIGINT) END AS year_built,
  round(per_acre, 6) AS assessed_value_per_acre, farm AS is_agricultural, property_category,
  CASE WHEN assessed_value < 50000 THEN 'Low Value' WHEN assessed_value <= 200000 THEN 'Medium Value'
    WHEN assessed_value <= 500000 THEN 'High Value' ELSE 'Premium Value' END AS value_category,
  CASE WHEN year_built >= 1992 THEN 'New (0-10 years)' WHEN year_built >= 1972 THEN 'Modern (11-30 years)'
    WHEN year_built >= 1952 THEN 'Mature (31-50 years)' ELSE 'Historic (50+ years)' END AS age_category,
  CASE WHEN acres < 1 THEN 'small' WHEN acres <= 10 THEN 'medium' WHEN acres <= 100 THEN 'large' ELSE 'very_large' END AS size_category
FROM categories"""))
def curated(spark, sf):
    names = (
        "parcel_id state county_name address city zip_code owner_name acres property_type assessed_value market_value year_built "
        "assessed_value_per_acre is_agricultural property_category value_category age_category size_category"
    ).split()
    out = curated_parcels(raw_documents(spark, sf), AS_OF, retention_days=None, columns=names)
    return out.select(
        "parcel_id", "state", "county_name", "address", "city", "zip_code", "owner_name", "acres", "property_type",
        F.col("assessed_value").cast("double").alias("assessed_value"), F.col("market_value").cast("double").alias("market_value"),
        F.col("year_built").cast("bigint").alias("year_built"),
        F.round("assessed_value_per_acre", 6).alias("assessed_value_per_acre"), "is_agricultural", "property_category",
        "value_category", "age_category", "size_category",
    )


@query("src02_document_shapes", """
SELECT CASE WHEN l_orderkey % 37 = 36 THEN 'malformed' WHEN l_partkey % 2 = 1 AND l_suppkey % 5 = 0 THEN 'single'
  WHEN l_partkey % 8 < 2 THEN 'parcels' WHEN l_partkey % 8 < 4 THEN 'array' WHEN l_partkey % 8 < 6 THEN 'features' ELSE 'results' END AS shape,
  count(*) AS documents, CAST(sum(CASE WHEN l_orderkey % 37 = 36 THEN 0 WHEN l_partkey % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS parcels
FROM lineitem GROUP BY 1""")
def src02(spark, sf):
    from fieldbook.functions.documents import parcels_of

    docs = raw_documents(spark, sf).withColumn("doc", parse_or_salvage(F.col("raw_data")))
    found = F.coalesce(F.size(parcels_of(F.col("doc"))), F.lit(0))
    return docs.groupBy(shape_of(F.col("doc")).alias("shape")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(found).alias("parcels")
    )


@query("p28_document_keys", parcel_sql("""
SELECT key, count(*) AS documents FROM (
  SELECT unnest(list_filter(['id','state','county','address','city','zip_code','owner_name','acres','property_type','land_use_description','year_built','building_count','geometry',
    CASE WHEN style IN (0, 1) THEN 'assessed_value' END,
    CASE WHEN style = 1 THEN 'parval' END, CASE WHEN style = 2 THEN 'fields' END], lambda k: k IS NOT NULL
     AND (style = 1 OR CASE k WHEN 'id' THEN parcel_id IS NOT NULL WHEN 'state' THEN state IS NOT NULL WHEN 'county' THEN parcel_county IS NOT NULL
       WHEN 'address' THEN address IS NOT NULL WHEN 'owner_name' THEN owner_name IS NOT NULL WHEN 'acres' THEN acres IS NOT NULL
       WHEN 'property_type' THEN property_type IS NOT NULL WHEN 'land_use_description' THEN land_use_description IS NOT NULL
       WHEN 'geometry' THEN has_geometry ELSE true END))) AS key FROM fields)
GROUP BY 1"""))
def p28(spark, sf):
    from fieldbook.operators.quality import key_presence

    flat = explode_variants(raw_documents(spark, sf), "raw_data", [])
    names = (
        "id state county address city zip_code owner_name acres property_type land_use_description year_built "
        "building_count geometry assessed_value parval fields"
    ).split()
    return key_presence(flat, "parcel_json").where(F.col("key").isin(names))
