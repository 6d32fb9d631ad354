"""SQL functions for use in ``spark.sql``; plain expressions, so the planner inlines them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SLOPE = """
CREATE OR REPLACE TEMPORARY FUNCTION slope_between(
  lat1 DOUBLE, lon1 DOUBLE, elev1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE, elev2 DOUBLE)
RETURNS DOUBLE
RETURN CASE WHEN lat1 = lat2 AND lon1 = lon2 THEN 0.0D
  ELSE degrees(atan2(abs(elev2 - elev1),
    sqrt(power(111319.5D * (lat2 - lat1), 2) + power(111319.5D * cos(radians(lat1)) * (lon2 - lon1), 2)))) END
"""

DISTANCE = """
CREATE OR REPLACE TEMPORARY FUNCTION metres_between(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
RETURNS DOUBLE
RETURN CASE WHEN lat1 = lat2 AND lon1 = lon2 THEN 0.0D
  ELSE 6371000.0D * acos(least(1.0D, greatest(-1.0D,
    cos(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2) - radians(lon1)) + sin(radians(lat1)) * sin(radians(lat2))))) END
"""


def register_geo_functions(spark: SparkSession) -> None:
    spark.sql(SLOPE)
    spark.sql(DISTANCE)


def register_document_function(spark: SparkSession, name: str, documents: DataFrame, key: str = "parcel_id") -> None:
    """A table function ``name(key)`` that returns the documents of one key as objects.

    Used with LATERAL it becomes a join on the key, so it serves one parcel or all of them alike.
    """
    view = f"{name}_source"
    documents.select(key, "document").createOrReplaceTempView(view)
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted STRING) RETURNS TABLE (document VARIANT)
      RETURN SELECT parse_json(s.document) AS document FROM {view} AS s WHERE s.{key} = wanted""")
