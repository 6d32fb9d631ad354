"""Raw parcel documents built from lineitem: every row becomes one landed file row.

A document holds one parcel, or two when the part number is even, all from the same source row, so
building it needs no grouping. Field aliases vary by line number, the document shape by part number.

Fused with its neighbours, the step that writes the texts would be one generated method of more than 8,000
bytes of bytecode, which the JVM only interprets. A projection with a lambda function is not fused but
generated in many small methods, so both wide steps hold one (``_unfused_text``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.registry.tables import base, spread

AS_OF = dt.datetime(2002, 1, 1)

# The same rows for the comparison engine: one line per parcel of a well-formed document.
RAW_SQL = """
 raw AS (
  SELECT *, 'raw/parcels/county_' || (l_suppkey % 50) || '/o' || l_orderkey || '_p' || l_partkey || '_s' || l_suppkey || '.json' AS file_name
  FROM lineitem),
 parcels_raw AS (
  SELECT *, 0 AS idx, CASE WHEN l_orderkey % 31 = 30 THEN NULL ELSE 'P' || l_partkey END AS parcel_id,
    l_linenumber % 3 AS style FROM raw WHERE l_orderkey % 37 <> 36
  UNION ALL
  SELECT *, 1 AS idx, 'Q' || l_suppkey AS parcel_id, 0 AS style FROM raw WHERE l_orderkey % 37 <> 36 AND l_partkey % 2 = 0),
 fields AS (
  SELECT *, 'county_' || (l_suppkey % 50) AS county,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity * 3 - 6 END AS acres,
    l_extendedprice * 4 AS assessed_value,
    CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice * 5 END AS market_value,
    l_tax * 1000 AS tax_amount, 1890 + l_linenumber * 20 AS tax_year,
    1780 + l_partkey % 250 AS year_built, l_suppkey % 5 - 1 AS building_count,
    l_extendedprice AS improvement_value, l_quantity * 100 AS land_value,
    CASE l_partkey % 6 WHEN 0 THEN ' Residential ' WHEN 1 THEN 'Commercial Retail' WHEN 2 THEN 'industrial'
      WHEN 3 THEN 'Vacant Lot' WHEN 4 THEN '  ' ELSE NULL END AS property_type,
    CASE l_suppkey % 7 WHEN 0 THEN 'Dairy Farm' WHEN 1 THEN 'CROPLAND' WHEN 2 THEN 'Single family'
      WHEN 3 THEN 'Ranch land' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE 'Retail store' END AS land_use_description,
    CASE l_linenumber % 4 WHEN 0 THEN ' tx' WHEN 1 THEN 'IA ' WHEN 2 THEN 'ne' ELSE NULL END AS state,
    CASE l_partkey % 3 WHEN 0 THEN ' Travis ' ELSE NULL END AS parcel_county,
    CASE l_suppkey % 4 WHEN 0 THEN '   ' WHEN 1 THEN ' ' || l_suppkey || ' Main St ' ELSE NULL END AS address,
    CASE l_suppkey % 3 WHEN 0 THEN 'Austin ' ELSE '' END AS city,
    CASE l_partkey % 4 WHEN 0 THEN '78701' WHEN 1 THEN ' 7870' WHEN 2 THEN '7870A' ELSE ' 50309 ' END AS zip_code,
    CASE l_orderkey % 5 WHEN 0 THEN NULL ELSE 'Owner ' || (l_orderkey % 100) END AS owner_name,
    l_linenumber <> 5 AS has_geometry
  FROM parcels_raw)"""


def _money(extra):
    """Value fields under the names of one source style."""
    value = {
        "assessed": F.col("l_extendedprice") * 4,
        "market": F.when(F.col("l_discount") == 0, None).otherwise(F.col("l_extendedprice") * 5),
        "tax": F.col("l_tax") * 1000,
        "year": F.lit(1890) + F.col("l_linenumber") * 20,
        "improvement": F.col("l_extendedprice"),
        "land": F.col("l_quantity") * 100,
    }
    return [value[k].alias(n) for k, n in extra.items()]


PLAIN = dict(
    assessed="assessed_value", market="market_value", tax="tax_amount", year="tax_year",
    improvement="improvement_value", land="land_value",
)
SHORT = dict(assessed="parval", market="mktval", tax="taxamt", year="taxyear", improvement="improvval", land="landval")
NESTED = dict(
    assessed="parval", market="saleprice", tax="taxamt", year="taxyear", improvement="improvval", land="landval"
)


def _unfused_text(number):
    return F.transform(F.array(number), lambda n: n.cast("string"))[0]


def raw_documents(spark: SparkSession, sf: str) -> DataFrame:
    li = spread(base(spark, sf, "lineitem"))
    part, supp, line, order = (F.col(f"l_{c}") for c in ("partkey", "suppkey", "linenumber", "orderkey"))
    lon, lat = (part % 1000).cast("double") / 10 - 150, (supp % 400).cast("double") / 10 + 10
    corners = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    ring = F.array(*[F.array(lon + dx * 0.01, lat + dy * 0.01) for dx, dy in corners])
    geometry = F.when(line != 5, F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))

    def pick(key, n, values):
        out = None
        for i, v in enumerate(values):
            out = F.when(key % n == i, v) if out is None else out.when(key % n == i, v)
        return out

    common = [
        pick(line, 4, [" tx", "IA ", "ne"]).alias("state"),
        pick(part, 3, [" Travis "]).alias("county"),
        F.when(supp % 4 == 0, "   ").when(supp % 4 == 1, F.concat(F.lit(" "), supp.cast("string"), F.lit(" Main St "))).alias("address"),
        F.when(supp % 3 == 0, "Austin ").otherwise("").alias("city"),
        pick(part, 4, ["78701", " 7870", "7870A", " 50309 "]).alias("zip_code"),
        F.when(order % 5 != 0, F.concat(F.lit("Owner "), (order % 100).cast("string"))).alias("owner_name"),
        F.when(line != 6, F.col("l_quantity") * 3 - 6).alias("acres"),
        pick(part, 6, [" Residential ", "Commercial Retail", "industrial", "Vacant Lot", "  "]).alias("property_type"),
        F.when(supp % 7 == 6, "Retail store").otherwise(
            pick(supp, 7, ["Dairy Farm", "CROPLAND", "Single family", "Ranch land", ""])
        ).alias("land_use_description"),
        (F.lit(1780) + part % 250).alias("year_built"),
        (supp % 5 - 1).alias("building_count"),
        geometry.alias("geometry"),
    ]
    ident = F.when(order % 31 != 30, F.concat(F.lit("P"), _unfused_text(part))).alias("id")
    nulls = {"ignoreNullFields": "false"}
    first = (
        F.when(line % 3 == 0, F.to_json(F.struct("id", "common.*", *_money(PLAIN))))
        .when(line % 3 == 1, F.to_json(F.struct("id", "common.*", F.lit(None).cast("string").alias("assessed_value"), *_money(SHORT)), nulls))
        .otherwise(F.to_json(F.struct("id", "common.*", F.struct(*_money(NESTED)).alias("fields"))))
    )
    second = F.to_json(F.struct(F.concat(F.lit("Q"), supp.cast("string")).alias("id"), "common.*", *_money(PLAIN)))
    two = part % 2 == 0
    # Built in steps, so that the text of a parcel is computed once per row.
    li = li.withColumns({"id": ident, "common": F.struct(*common)})
    li = li.withColumns({"first": first, "second": F.when(two, second), "chunk": _unfused_text(line)})
    li = li.withColumn("body", F.concat_ws(",", "first", "second"))
    li = li.withColumn("listed", F.concat(F.lit("["), F.col("body"), F.lit("]")))
    listed = F.col("listed")
    wrapped = (
        F.when(~two & (supp % 5 == 0), F.col("first"))
        .when(part % 8 < 2, F.concat(F.lit('{"chunk_index":'), F.col("chunk"), F.lit(',"parcels":'), listed, F.lit("}")))
        .when(part % 8 < 4, listed)
        .when(part % 8 < 6, F.concat(F.lit('{"features":'), listed, F.lit("}")))
        .otherwise(F.concat(F.lit('{"results":'), listed, F.lit("}")))
    )
    malformed = F.concat(F.lit('{"parcels":[{"id":"P'), part.cast("string"), F.lit('"'))
    return li.select(
        F.concat(
            F.lit("raw/parcels/county_"), (supp % 50).cast("string"), F.lit("/o"), order.cast("string"), F.lit("_p"),
            part.cast("string"), F.lit("_s"), supp.cast("string"), F.lit(".json"),
        ).alias("file_name"),
        line.cast("bigint").alias("file_row_number"),
        F.when(order % 37 == 36, malformed).otherwise(wrapped).alias("raw_data"),
        F.col("l_shipdate").alias("ingestion_timestamp"),
        pick(line, 3, ["bulk", "api", "manual"]).alias("ingestion_type"),
        F.concat(F.lit("county_"), (supp % 50).cast("string")).alias("county"),
        line.cast("bigint").alias("chunk_index"),
        F.when(two, 2).otherwise(1).cast("bigint").alias("parcel_count"),
    )


def parcel_sql(select: str) -> str:
    return f"WITH {RAW_SQL.strip()} {select}"
