"""Land cover, topography, crop history, county statistics and climate queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fieldbook.functions.values import SQUARE_FEET_PER_ACRE
from fieldbook.functions.sql_functions import register_document_function
from fieldbook.operators import climate, crops, gaps, landcover, topography
from fieldbook.operators.dimensions import (
    CROP_HISTORY_STATES, FULL_COVERAGE_STATES, MAJOR_FARM_STATES, MIXED_FARM_STATES, STATION_BOXES,
    land_cover_classes, name_crops,
)
from fieldbook.registry import query
from fieldbook.registry.tables import base, table

AS_OF = dt.datetime(2002, 1, 1)


def quoted(names):
    return ", ".join(f"'{n}'" for n in names)


STATS = """
 stats AS (SELECT parcel_id, nlcd_code, sum(area) AS class_area, count(*) AS feature_count, max(nlcd_year) AS nlcd_year,
    max(processing_method) AS processing_method FROM land_cover GROUP BY 1, 2),
 shares AS (SELECT *, sum(class_area) OVER (PARTITION BY parcel_id) AS total_area,
    class_area / sum(class_area) OVER (PARTITION BY parcel_id) * 100 AS pct,
    row_number() OVER (PARTITION BY parcel_id ORDER BY class_area DESC, nlcd_code) = 1 AS is_dominant FROM stats),
 detail AS (SELECT s.*, c.class_name, c.class_category, c.is_agricultural, c.is_natural,
    total_area * 43560 * pct / 100 AS sqft FROM shares s JOIN classes c USING (nlcd_code) WHERE pct > 0.1)
"""


def _detail(spark, sf):
    stats = landcover.class_statistics(table(spark, sf, "land_cover"))
    return landcover.detail_rows(stats, F.col("total_area"))


@query("j20_land_cover_classes", """
SELECT nlcd_code, class_name, class_category, class_color, is_agricultural, is_natural, count(*) AS features
FROM land_cover JOIN classes USING (nlcd_code) GROUP BY ALL""", "land_cover classes")
def j20(spark, sf):
    dim = land_cover_classes(spark)
    counts = table(spark, sf, "land_cover").groupBy("nlcd_code").agg(F.count(F.lit(1)).alias("features"))
    return counts.join(F.broadcast(dim), "nlcd_code")


@query("j01_class_detail", """
SELECT parcel_id, nlcd_year, nlcd_code, class_name, class_category, area, processing_method, is_agricultural, is_natural
FROM land_cover JOIN classes USING (nlcd_code)""", "land_cover classes")
def j01(spark, sf):
    return landcover.with_class(table(spark, sf, "land_cover")).drop("class_color")


@query("a08_class_statistics", f"""
WITH {STATS} SELECT parcel_id, nlcd_code, class_area, feature_count, total_area, round(pct, 6) AS coverage_percentage,
  is_dominant AS is_dominant_class FROM shares""", "land_cover classes")
def a08(spark, sf):
    out = landcover.class_statistics(table(spark, sf, "land_cover")).drop("nlcd_year", "processing_method")
    return out.withColumn("coverage_percentage", F.round("coverage_percentage", 6))


@query("p25_sparse_classes", f"""
WITH {STATS} SELECT parcel_id, nlcd_code, round(sqft, 3) AS coverage_area_sqft, is_dominant AS is_dominant_class FROM detail""",
       "land_cover classes")
def p25(spark, sf):
    out = _detail(spark, sf)
    return out.select("parcel_id", "nlcd_code", F.round("coverage_area_sqft", 3).alias("coverage_area_sqft"), "is_dominant_class")


SUMMARY = f"""{STATS}, summary AS (SELECT parcel_id, arg_max(nlcd_code, (class_area, -nlcd_code)) AS dominant_nlcd_code,
    arg_max(class_name, (class_area, -nlcd_code)) AS dominant_class_name, round(max(pct), 6) AS dominant_class_percentage,
    max(nlcd_year) AS nlcd_year, count(*) AS total_classes_count, bool_or(is_agricultural) AS is_agricultural, bool_or(is_natural) AS is_natural,
    bool_or(class_category = 'Developed') AS is_developed, round(sum(CASE WHEN is_agricultural THEN pct ELSE 0 END), 6) AS agricultural_percentage,
    round(sum(CASE WHEN is_natural THEN pct ELSE 0 END), 6) AS natural_percentage,
    round(sum(CASE WHEN class_category = 'Developed' THEN pct ELSE 0 END), 6) AS developed_percentage,
    max(processing_method) AS processing_method, round(sum(sqft), 3) AS total_area_sqft FROM detail GROUP BY parcel_id)"""


def _rounded(df):
    shares = [c for c in df.columns if c.endswith("_percentage")]
    return df.withColumns({c: F.round(c, 6) for c in shares} | {"total_area_sqft": F.round("total_area_sqft", 3)})


@query("a07_land_cover_summary", f"WITH {SUMMARY} SELECT * FROM summary", "land_cover classes")
def a07(spark, sf):
    return _rounded(landcover.parcel_summary(_detail(spark, sf)))


@query("a07_dominant_only", f"""WITH {SUMMARY} SELECT s.parcel_id, s.dominant_nlcd_code, 1 AS total_classes_count, d.is_agricultural, d.is_natural
FROM summary s JOIN detail d ON s.parcel_id = d.parcel_id AND s.dominant_nlcd_code = d.nlcd_code""", "land_cover classes")
def a07_dominant(spark, sf):
    return landcover.parcel_summary(_detail(spark, sf), dominant_only=True).select(
        "parcel_id", "dominant_nlcd_code", "total_classes_count", "is_agricultural", "is_natural"
    )


@query("p29_agricultural_parcels", f"""WITH {SUMMARY} SELECT parcel_id, dominant_class_name, dominant_class_percentage,
  agricultural_percentage, nlcd_year FROM summary WHERE is_agricultural""", "land_cover classes")
def p29(spark, sf):
    return landcover.agricultural_parcels(_rounded(landcover.parcel_summary(_detail(spark, sf))))


@query("a14_land_cover_documents", f"""WITH {SUMMARY} SELECT s.parcel_id, s.dominant_class_name AS dominant_class, CAST(s.total_classes_count AS BIGINT) AS classes,
  s.is_natural, CAST(s.nlcd_year AS BIGINT) AS nlcd_year,
  (SELECT string_agg(nlcd_code, ',' ORDER BY pct DESC, nlcd_code) FROM detail d WHERE d.parcel_id = s.parcel_id) AS codes FROM summary s""",
       "land_cover classes")
def a14(spark, sf):
    docs = landcover.parcel_documents(_detail(spark, sf))
    doc = F.parse_json("document")
    codes = F.transform(
        F.from_json("document", "classes array<struct<nlcd_code: int>>")["classes"], lambda c: c["nlcd_code"].cast("string")
    )
    return docs.select(
        "parcel_id",
        F.variant_get(doc, "$.summary.dominant_class", "string").alias("dominant_class"),
        F.size(codes).cast("bigint").alias("classes"),
        F.variant_get(doc, "$.summary.is_natural", "boolean").alias("is_natural"),
        F.variant_get(doc, "$.summary.nlcd_year", "bigint").alias("nlcd_year"),
        F.array_join(codes, ",").alias("codes"),
    )


@query("dq10_integrity", """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE share IS NULL OR share < 0 OR share > 100) AS bad_percentage,
  count(*) FILTER (WHERE code NOT IN (SELECT nlcd_code FROM classes)) AS unknown_code
FROM (SELECT l_quantity * 2.5 - 5 AS share, CASE WHEN l_partkey % 9 = 0 THEN 99 ELSE nlcd END AS code
  FROM (SELECT *, 11 + l_linenumber % 2 AS nlcd FROM lineitem))""", "classes")
def dq10(spark, sf):
    rows = base(spark, sf, "lineitem").select(
        (F.col("l_quantity") * 2.5 - 5).alias("coverage_percentage"),
        F.when(F.col("l_partkey") % 9 == 0, 99).otherwise(F.lit(11) + F.col("l_linenumber") % 2).alias("nlcd_code"),
    )
    return landcover.integrity_counts(rows)


@query("j18_valid_codes", """
SELECT count(*) AS valid FROM lineitem WHERE l_partkey % 100 IN (SELECT nlcd_code FROM classes)""", "classes")
def j18(spark, sf):
    rows = base(spark, sf, "lineitem").select((F.col("l_partkey") % 100).alias("nlcd_code"))
    known = F.broadcast(land_cover_classes(spark).select("nlcd_code"))
    return rows.join(known, "nlcd_code", "left_semi").agg(F.count(F.lit(1)).alias("valid"))


@query("r14_processing_method", """
SELECT method, CASE WHEN method IS NULL THEN 'No coordinates available for parcel' END AS error, count(*) AS parcels FROM (
  SELECT CASE WHEN k % 3 <> 0 AND acres >= 1 THEN 'polygon' WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 'point_sample' END AS method FROM parcels)
GROUP BY ALL""", "parcels")
def r14(spark, sf):
    p = table(spark, sf, "parcels")
    method = landcover.processing_method(F.col("k") % 3 != 0, F.col("acres"), F.col("latitude"), F.col("longitude"))
    return (
        p.withColumn("method", method).groupBy("method", landcover.method_errors(F.col("method")).alias("error"))
        .agg(F.count(F.lit(1)).alias("parcels"))
    )


TOPO = """SELECT parcel_id, min(mean_elevation_ft) AS elevation_min, max(max_elevation_ft) AS elevation_max,
  avg(mean_elevation_ft) AS elevation_mean, stddev_samp(mean_elevation_ft) AS elevation_std, quantile_cont(mean_elevation_ft, 0.5) AS elevation_median,
  count(*) AS elevation_points_count, max(processing_method) AS processing_method, avg(slope_degrees) AS slope_degrees FROM topography GROUP BY 1"""


@query("a09_topography_summary", f"""WITH t AS ({TOPO}) SELECT parcel_id, elevation_min, round(elevation_max, 6) AS elevation_max, round(elevation_mean + 1e-9, 6) AS elevation_mean,
  round(elevation_std, 6) AS elevation_std, round(elevation_median, 6) AS elevation_median, elevation_points_count, processing_method FROM t""", "topography")
def a09(spark, sf):
    out = topography.parcel_summary(table(spark, sf, "topography"))
    r = ["elevation_max", "elevation_mean", "elevation_std", "elevation_median"]
    nudged = {"elevation_mean": F.round(F.col("elevation_mean") + 1e-9, 6)}  # keeps exact halves off the rounding edge
    return out.withColumns({c: F.round(c, 6) for c in r} | nudged).drop("elevation_units", "slope_degrees")


@query("a10_elevation_statistics", f"""WITH t AS ({TOPO}) SELECT count(*) AS total_parcels, round(avg(elevation_mean), 5) AS avg_elevation,
  min(elevation_min) AS overall_min_elevation, round(max(elevation_max), 6) AS overall_max_elevation, round(stddev_samp(elevation_mean), 5) AS elevation_std_dev,
  count(*) FILTER (WHERE elevation_mean < 100) AS low_elevation_parcels, count(*) FILTER (WHERE elevation_mean BETWEEN 100 AND 500) AS mid_elevation_parcels,
  count(*) FILTER (WHERE elevation_mean > 500) AS high_elevation_parcels, round(avg(slope_degrees), 5) AS avg_slope,
  count(*) FILTER (WHERE slope_degrees > 15) AS steep_slope_parcels FROM t""", "topography")
def a10(spark, sf):
    out = topography.elevation_statistics(topography.parcel_summary(table(spark, sf, "topography")))
    return out.withColumns(
        {c: F.round(c, 5) for c in ("avg_elevation", "elevation_std_dev", "avg_slope")}
        | {"overall_max_elevation": F.round("overall_max_elevation", 6)}
    )


@query("j02_topography_detail", f"""WITH t AS ({TOPO}) SELECT p.parcel_id, topo_id, topo_line, mean_elevation_ft, elevation_min AS summary_min, round(elevation_mean + 1e-9, 6) AS summary_mean
FROM topography p LEFT JOIN t USING (parcel_id)""", "topography")
def j02(spark, sf):
    points = table(spark, sf, "topography")
    out = topography.detail_view(points, topography.parcel_summary(points))
    return out.select(
        "parcel_id", "topo_id", "topo_line", "mean_elevation_ft", "summary_min", F.round(F.col("summary_mean") + 1e-9, 6).alias("summary_mean")
    )


@query("a14_topography_documents", """
SELECT parcel_id, CAST((rn - 1) // 20 AS BIGINT) AS part, count(*) AS points, min(rn) AS first_position, max(topo_id) AS max_topo
FROM (SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY topo_id, topo_line, mean_elevation_ft, slope_degrees) AS rn FROM topography)
GROUP BY 1, 2""", "topography")
def a14_topo(spark, sf):
    order = [F.col(c) for c in ("topo_id", "topo_line", "mean_elevation_ft", "slope_degrees")]
    points = table(spark, sf, "topography").select("parcel_id", "topo_id", "topo_line", "mean_elevation_ft", "slope_degrees")
    docs = topography.parcel_documents(points, order, per_document=20)
    rows = F.from_json("document", "elevation_points array<struct<position: bigint, topo_id: bigint>>")["elevation_points"]
    return docs.select(
        "parcel_id", "part", F.col("points").cast("bigint").alias("points"), rows[0]["position"].alias("first_position"),
        F.array_max(F.transform(rows, lambda r: r["topo_id"])).alias("max_topo"),
    )


TOPO_DOCS = f"""WITH t AS ({TOPO}), n AS (SELECT *, row_number() OVER (PARTITION BY parcel_id ORDER BY topo_id, topo_line, mean_elevation_ft, slope_degrees) AS rn FROM topography),
 parts AS (SELECT parcel_id, CAST((rn - 1) // 20 AS BIGINT) AS part, count(*) AS points, min(topo_id) FILTER ((rn - 1) % 20 = 0) AS first_topo FROM n GROUP BY 1, 2)
SELECT parcel_id, part, points, first_topo, CASE WHEN part = 0 THEN round(elevation_min, 6) END AS elevation_min, CASE WHEN part = 0 THEN round(elevation_median, 6) END AS elevation_median,
  CASE WHEN part = 0 THEN elevation_points_count END AS summary_points, CASE WHEN part = 0 THEN CASE WHEN elevation_max - elevation_min < 50 THEN 'level' ELSE 'uneven' END END AS relief
FROM parts LEFT JOIN t USING (parcel_id)"""


def _topo_documents(spark, sf):
    points = table(spark, sf, "topography")
    order = [F.col(c) for c in ("topo_id", "topo_line", "mean_elevation_ft", "slope_degrees")]
    span = F.max("max_elevation_ft") - F.min("mean_elevation_ft")
    terrain = points.groupBy("parcel_id").agg(F.when(span < 50, "level").otherwise("uneven").alias("relief"))
    return topography.whole_documents(points, terrain, order, per_document=20)


def _topo_fields(documents):
    get = lambda path, kind: F.variant_get(F.col("document"), path, kind)
    return documents.select(
        "parcel_id", get("$.part", "bigint").alias("part"), F.size(get("$.elevation_points", "array<variant>")).cast("bigint").alias("points"),
        get("$.elevation_points[0].topo_id", "bigint").alias("first_topo"), F.round(get("$.summary.elevation_min", "double"), 6).alias("elevation_min"),
        F.round(get("$.summary.elevation_median", "double"), 6).alias("elevation_median"), get("$.summary.elevation_points_count", "bigint").alias("summary_points"),
        get("$.terrain_analysis.relief", "string").alias("relief"),
    )


@query("a14_topography_whole", TOPO_DOCS, "topography")
def a14_topo_whole(spark, sf):
    """Documents with summary, points and terrain analysis."""
    docs = _topo_documents(spark, sf)
    return _topo_fields(docs.select("parcel_id", F.parse_json("document").alias("document")))


@query("ud02_topography_document", TOPO_DOCS, "topography")
def ud02_topo(spark, sf):
    """The same documents through a table function that is called from SQL for every parcel."""
    register_document_function(spark, "topography_document", _topo_documents(spark, sf))
    parcels = table(spark, sf, "topography").select("parcel_id").distinct()
    return _topo_fields(spark.sql("SELECT p.parcel_id, d.document FROM {parcels} AS p, LATERAL topography_document(p.parcel_id) AS d", parcels=parcels))


@query("ud02_land_cover_document", f"""WITH {SUMMARY} SELECT s.parcel_id, s.dominant_class_name AS dominant_class, CAST(s.total_classes_count AS BIGINT) AS classes, s.is_natural FROM summary s""",
       "land_cover classes")
def ud02_cover(spark, sf):
    register_document_function(spark, "land_cover_document", landcover.parcel_documents(_detail(spark, sf)))
    parcels = table(spark, sf, "land_cover").select("parcel_id").distinct()
    return spark.sql("""SELECT p.parcel_id, d.document:summary.dominant_class::string AS dominant_class, CAST(size(d.document:classes::array<variant>) AS BIGINT) AS classes,
      d.document:summary.is_natural::boolean AS is_natural FROM {parcels} AS p, LATERAL land_cover_document(p.parcel_id) AS d""", parcels=parcels)


@query("t05_best_dem_product", """
SELECT brand, arg_min(title, (priority, k)) AS title, arg_min(resolution, (priority, k)) AS resolution FROM (
  SELECT p_brand AS brand, p_name || CASE p_partkey % 4 WHEN 0 THEN ' DEM' WHEN 1 THEN ' 3DEP' WHEN 2 THEN ' photo' ELSE ' Elevation' END AS title,
    CASE p_partkey % 5 WHEN 0 THEN '30 meter' WHEN 1 THEN '10 Meter' WHEN 2 THEN '1/3 arc-second' WHEN 3 THEN '1 meter' ELSE 'other' END AS resolution,
    CASE p_partkey % 5 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 5 END AS priority,
    p_size * 15000000 AS size_bytes, p_partkey AS k FROM part)
WHERE size_bytes <= 524288000 AND title NOT LIKE '%photo' GROUP BY 1""")
def t05(spark, sf):
    k = F.col("p_partkey")

    def choose(n, values):
        return F.get(F.array(*[F.lit(v) for v in values]), (k % n).cast("int"))

    products = base(spark, sf, "part").select(
        F.col("p_brand").alias("brand"),
        F.concat("p_name", choose(4, [" DEM", " 3DEP", " photo", " Elevation"])).alias("title"),
        choose(5, ["30 meter", "10 Meter", "1/3 arc-second", "1 meter", "other"]).alias("resolution"),
        (F.col("p_size").cast("bigint") * 15000000).alias("size_bytes"), k.alias("position"),
    )
    return topography.best_product(products, "brand").drop("size_bytes")


@query("p15_coordinate_check", """
SELECT CASE WHEN lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 THEN true ELSE false END AS is_valid, count(*) AS n
FROM (SELECT TRY_CAST(CASE WHEN c_custkey % 13 = 0 THEN 'abc' ELSE '' || (c_custkey % 100) END AS DOUBLE) AS lat, (c_custkey % 400 - 200) AS lon FROM customer)
GROUP BY 1""")
def p15(spark, sf):
    k = F.col("c_custkey")
    rows = base(spark, sf, "customer").select(
        F.when(k % 13 == 0, "abc").otherwise((k % 100).cast("string")).alias("lat"), (k % 400 - 200).cast("string").alias("lon")
    )
    return topography.checked_coordinates(rows, "lat", "lon").groupBy("is_valid").agg(F.count(F.lit(1)).alias("n"))


# Gaps and freshness -----------------------------------------------------------------------------


def _results(spark, sf):
    return base(spark, sf, "orders").select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("parcel_id"), F.col("o_orderdate").alias("processed_at")
    )


AGE = 365


@query("j03_stale_results", f"""
SELECT parcel_id, state_code FROM parcels WHERE parcel_id NOT IN
  (SELECT 'P' || o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2002-01-01' - INTERVAL {AGE} DAY)""", "parcels")
def j03(spark, sf):
    wanted = table(spark, sf, "parcels").select("parcel_id", "state_code")
    return gaps.needs_processing(wanted, _results(spark, sf), "parcel_id", "processed_at", AS_OF, AGE)


@query("r15_result_status", f"""
SELECT status, count(*) AS parcels FROM (SELECT p.parcel_id, CASE WHEN m IS NULL THEN 'missing'
  WHEN m >= TIMESTAMP '2002-01-01' - INTERVAL {AGE} DAY THEN 'fresh' ELSE 'stale' END AS status FROM parcels p
  LEFT JOIN (SELECT 'P' || o_custkey AS parcel_id, max(o_orderdate) AS m FROM orders GROUP BY 1) r ON p.parcel_id = r.parcel_id)
GROUP BY 1""", "parcels")
def r15(spark, sf):
    results = base(spark, sf, "orders").select(
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("parcel_id"), F.col("o_orderdate").alias("processed_at")
    )
    out = gaps.result_status(table(spark, sf, "parcels"), results, "parcel_id", "processed_at", AS_OF, AGE)
    return out.groupBy("status").agg(F.count(F.lit(1)).alias("parcels"))


@query("j04_missing_history", f"""
SELECT parcel_id, state_code, acres FROM parcels WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND state_code IN ({quoted(CROP_HISTORY_STATES)})
  AND NOT EXISTS (SELECT 1 FROM crop_history h WHERE h.parcel_id = parcels.parcel_id AND h.query_success AND h.crop_year >= 2020)""",
       "parcels crop_history")
def j04(spark, sf):
    history = table(spark, sf, "crop_history").where(F.col("query_success") & (F.col("crop_year") >= 2020))
    out = gaps.without_history(table(spark, sf, "parcels"), history, CROP_HISTORY_STATES)
    return out.select("parcel_id", "state_code", "acres")


@query("t03_large_parcels_first", f"""
SELECT parcel_id, acres FROM parcels WHERE latitude IS NOT NULL AND state_code IN ({quoted(CROP_HISTORY_STATES)})
ORDER BY acres DESC, parcel_id LIMIT 100""", "parcels")
def t03(spark, sf):
    from fieldbook.operators.ranking import top_n

    out = gaps.eligible(table(spark, sf, "parcels"), CROP_HISTORY_STATES).select("parcel_id", "acres")
    return top_n(out, [F.desc("acres"), F.col("parcel_id")], 100)


@query("p27_eligible_parcels", f"""
SELECT state_code, count(*) AS parcels FROM parcels WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND state_code IN ({quoted(CROP_HISTORY_STATES)}) GROUP BY 1""", "parcels")
def p27(spark, sf):
    out = gaps.eligible(table(spark, sf, "parcels"), CROP_HISTORY_STATES)
    return out.groupBy("state_code").agg(F.count(F.lit(1)).alias("parcels"))


@query("j05_gap_detection", """
SELECT p.parcel_id, created_epoch, s.id IS NOT NULL AS has_soil, c.id IS NOT NULL AS has_crop, w.id IS NOT NULL AS has_climate FROM parcels p
LEFT JOIN (SELECT DISTINCT 'P' || (l_partkey * 3 // 2) AS id FROM lineitem) s ON s.id = p.parcel_id
LEFT JOIN (SELECT DISTINCT parcel_id AS id FROM crop_history) c ON c.id = p.parcel_id
LEFT JOIN (SELECT DISTINCT 'P' || o_custkey AS id FROM orders) w ON w.id = p.parcel_id
WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND created_epoch >= 1005000000 AND (s.id IS NULL OR c.id IS NULL OR w.id IS NULL)""",
       "parcels crop_history")
def j05(spark, sf):
    def keyed(df, col):
        return df.select(F.concat(F.lit("P"), col.cast("string")).alias("parcel_id"))

    sources = {
        "soil": keyed(base(spark, sf, "lineitem"), F.floor(F.col("l_partkey") * 3 / 2)),
        "crop": table(spark, sf, "crop_history"),
        "climate": keyed(base(spark, sf, "orders"), F.col("o_custkey")),
    }
    parcels = table(spark, sf, "parcels").withColumn("created_at", F.timestamp_seconds("created_epoch"))
    out = gaps.enrichment_gaps(parcels, sources, F.timestamp_seconds(F.lit(1005000000)))
    return out.select("parcel_id", "created_epoch", "has_soil", "has_crop", "has_climate")


@query("u04_parcel_years", """
SELECT parcel_id, CAST(y AS BIGINT) AS crop_year FROM parcels, range(2019, 2024) AS r(y)""", "parcels")
def u04(spark, sf):
    out = gaps.parcel_years(table(spark, sf, "parcels").select("parcel_id"), 2019, 2023)
    return out.select("parcel_id", F.col("crop_year").cast("bigint").alias("crop_year"))


@query("a23_batch_summary", """
SELECT count(*) AS total, count(*) FILTER (WHERE event_type IN ('click', 'purchase', 'signup')) AS successful,
  count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'view') AS skipped FROM events""")
def a23(spark, sf):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped").otherwise("success")
    return gaps.job_status(base(spark, sf, "events").withColumn("status", status))


@query("a23_failures", "SELECT event_id, props AS error FROM events WHERE event_type = 'error'")
def a23_failures(spark, sf):
    rows = base(spark, sf, "events").withColumn("status", F.when(F.col("event_type") == "error", "failed").otherwise("success"))
    return gaps.failures(rows.withColumnRenamed("props", "error"), "event_id", "error")


# Crop history and county statistics -------------------------------------------------------------


@query("j19_crop_names", """
SELECT h.crop_code, coalesce(c.crop_name, 'Unknown (' || h.crop_code || ')') AS crop_name, coalesce(c.crop_category, 'Other') AS crop_category, count(*) AS n
FROM crop_history h LEFT JOIN crops c USING (crop_code) GROUP BY ALL""", "crop_history crops")
def j19(spark, sf):
    named = name_crops(table(spark, sf, "crop_history"))
    return named.groupBy("crop_code", "crop_name", "crop_category").agg(F.count(F.lit(1)).alias("n"))


@query("a04_history_overall", """
SELECT count(DISTINCT parcel_id) AS parcels, count(*) AS total_records, count(*) FILTER (WHERE query_success) AS successful,
  count(*) FILTER (WHERE NOT query_success) AS failed, min(crop_year) AS earliest_year, max(crop_year) AS latest_year,
  round(count(*) FILTER (WHERE query_success) / count(*) * 100, 6) AS success_rate FROM crop_history""", "crop_history")
def a04(spark, sf):
    return crops.history_overall(table(spark, sf, "crop_history")).withColumn("success_rate", F.round("success_rate", 6))


def _by(key):
    return f"""SELECT {key}, count(DISTINCT parcel_id) AS parcels, count(*) AS total_queries, count(*) FILTER (WHERE query_success) AS successful,
      round(count(*) FILTER (WHERE query_success) / count(*) * 100, 6) AS success_rate FROM crop_history GROUP BY 1"""


@query("a04_history_by_year", _by("crop_year"), "crop_history")
def a04_year(spark, sf):
    return crops.history_by(table(spark, sf, "crop_history"), "crop_year").withColumn("success_rate", F.round("success_rate", 6))


@query("a04_history_by_state", _by("state_code"), "crop_history")
def a04_state(spark, sf):
    return crops.history_by(table(spark, sf, "crop_history"), "state_code").withColumn("success_rate", F.round("success_rate", 6))


@query("a04_top_categories", """
SELECT coalesce(crop_category, 'Other') AS crop_category, count(*) AS occurrences, count(DISTINCT parcel_id) AS parcels
FROM crop_history LEFT JOIN crops USING (crop_code) WHERE query_success GROUP BY 1 ORDER BY occurrences DESC, crop_category LIMIT 10""",
       "crop_history crops")
def a04_top(spark, sf):
    return crops.top_categories(table(spark, sf, "crop_history"))


VALUE = """CASE WHEN upper(trim(value_text)) IN ('(D)', '(NA)', '(Z)', '(X)', '(S)', '(L)', '(H)') THEN NULL
  ELSE TRY_CAST(replace(replace(trim(value_text), ',', ''), '$', '') AS DOUBLE) END"""


@query("f09_statistic_values", f"SELECT value_text, {VALUE} AS value_numeric, count(*) AS n FROM county_stats GROUP BY ALL", "county_stats")
def f09(spark, sf):
    return crops.parse_statistics(table(spark, sf, "county_stats")).groupBy("value_text", "value_numeric").agg(F.count(F.lit(1)).alias("n"))


@query("a05_statistics_overall", f"""
SELECT count(*) AS total_records, count(DISTINCT state_code || '-' || county_name) AS counties, count(DISTINCT commodity_desc) AS commodities,
  count({VALUE}) AS numeric_values, min(year) AS earliest_year, max(year) AS latest_year FROM county_stats""", "county_stats")
def a05(spark, sf):
    return crops.statistics_overall(crops.parse_statistics(table(spark, sf, "county_stats")))


@query("a05_statistics_by_state", f"""
SELECT state_code, count(DISTINCT county_name) AS counties, count(*) AS records, count({VALUE}) AS numeric_values FROM county_stats GROUP BY 1""",
       "county_stats")
def a05_state(spark, sf):
    return crops.statistics_by_state(crops.parse_statistics(table(spark, sf, "county_stats")))


@query("a05_top_commodities", f"""
SELECT commodity_desc, count(*) AS records, count(DISTINCT (state_code, county_name)) AS counties, round(avg({VALUE}), 6) AS avg_value
FROM county_stats GROUP BY 1 ORDER BY records DESC, commodity_desc LIMIT 20""", "county_stats")
def a05_top(spark, sf):
    out = crops.top_commodities(crops.parse_statistics(table(spark, sf, "county_stats")))
    return out.withColumn("avg_value", F.round("avg_value", 6))


HEADLINE = f"""
 usable AS (SELECT *, {VALUE} AS v, commodity_desc = 'CATTLE' AND short_desc = 'CATTLE, INCL CALVES - INVENTORY' AS pref FROM county_stats
   WHERE {VALUE} IS NOT NULL AND contains(unit_desc, CASE WHEN commodity_desc = 'CATTLE' THEN 'HEAD' ELSE 'ACRE' END)),
 series AS (SELECT county_name, commodity_desc, short_desc, bool_or(pref) AS pref, max(year) AS latest, count(*) AS n FROM usable GROUP BY 1, 2, 3),
 chosen AS (SELECT county_name, commodity_desc, short_desc FROM series
   QUALIFY row_number() OVER (PARTITION BY county_name, commodity_desc ORDER BY pref DESC, latest DESC, n DESC, short_desc) = 1),
 headline AS (SELECT u.*, row_number() OVER (PARTITION BY county_name, commodity_desc ORDER BY year DESC, source_desc DESC, v DESC, unit_desc DESC) AS r
   FROM usable u JOIN chosen USING (county_name, commodity_desc, short_desc) QUALIFY r <= 3)"""


@query("w04_headline_series", f"""WITH {HEADLINE} SELECT county_name, commodity_desc, short_desc, year, v AS value_numeric, unit_desc, CAST(r AS BIGINT) AS period_rank FROM headline""",
       "county_stats")
def w04(spark, sf):
    out = crops.headline_series(table(spark, sf, "county_stats"), ["county_name"])
    return out.select(
        "county_name", "commodity_desc", "short_desc", "year", "value_numeric", "unit_desc",
        F.col("period_rank").cast("bigint").alias("period_rank"),
    )


@query("a13_yields_document", f"""WITH {HEADLINE} SELECT county_name, count(DISTINCT commodity_desc) AS commodities,
  max(CASE WHEN commodity_desc = 'CORN' AND r = 1 THEN v END) AS corn_latest, max(CASE WHEN commodity_desc = 'CATTLE' THEN short_desc END) AS cattle_series,
  count(CASE WHEN commodity_desc = 'HAY' THEN 1 END) AS hay_periods FROM headline GROUP BY 1""", "county_stats")
def a13(spark, sf):
    docs = crops.yields_document(crops.headline_series(table(spark, sf, "county_stats"), ["county_name"]), ["county_name"])
    y = F.col("yields")
    return docs.select(
        "county_name", F.size(y).cast("bigint").alias("commodities"),
        F.try_element_at(y, F.lit("CORN"))["latest"]["value"].alias("corn_latest"),
        F.try_element_at(y, F.lit("CATTLE"))["series"].alias("cattle_series"),
        F.coalesce(F.size(F.try_element_at(y, F.lit("HAY"))["periods"]), F.lit(0)).cast("bigint").alias("hay_periods"),
    )


COVERAGE = f"""
 by_state AS (SELECT state_code, count(*) AS parcel_count, count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL) AS with_coordinates,
   avg(acres) AS avg_acres, min(acres) AS min_acres, max(acres) AS max_acres, min(latitude) AS min_lat, max(latitude) AS max_lat,
   min(longitude) AS min_lon, max(longitude) AS max_lon,
   CASE WHEN state_code IN ({quoted(FULL_COVERAGE_STATES)}) THEN 'full' WHEN state_code IN ('AK', 'HI') THEN 'limited' ELSE 'none' END AS coverage
   FROM parcels GROUP BY 1)"""


@query("a11_coverage_by_state", f"WITH {COVERAGE} SELECT * REPLACE (round(avg_acres, 6) AS avg_acres) FROM by_state", "parcels")
def a11(spark, sf):
    return crops.coverage_by_state(table(spark, sf, "parcels")).withColumn("avg_acres", F.round("avg_acres", 6))


TOTALS = f"""{COVERAGE}, totals AS (SELECT CAST(sum(parcel_count) AS BIGINT) AS total_parcels, CAST(sum(with_coordinates) AS BIGINT) AS parcels_with_coords,
   CAST(sum(CASE WHEN coverage = 'full' THEN with_coordinates ELSE 0 END) AS BIGINT) AS eligible_parcels,
   CAST(sum(CASE WHEN coverage <> 'full' THEN with_coordinates ELSE 0 END) AS BIGINT) AS alternative_parcels FROM by_state)"""


@query("a11_coverage_totals", f"WITH {TOTALS} SELECT * FROM totals", "parcels")
def a11_totals(spark, sf):
    return crops.coverage_totals(crops.coverage_by_state(table(spark, sf, "parcels")))


@query("r11_coverage_score", f"""WITH {COVERAGE}, scored AS (SELECT state_code, CASE coverage WHEN 'full' THEN 40 WHEN 'limited' THEN 10 ELSE 0 END
   + CASE WHEN state_code IN ({quoted(MAJOR_FARM_STATES)}) THEN 30 WHEN state_code IN ({quoted(MIXED_FARM_STATES)}) THEN 20 ELSE 0 END
   + CASE WHEN avg_acres > 100 THEN 20 WHEN avg_acres > 10 THEN 10 ELSE 0 END
   + CASE WHEN max_lat BETWEEN 25 AND 49 AND min_lon BETWEEN -125 AND -66 THEN 10 ELSE 0 END AS overall_score FROM by_state)
 SELECT state_code, overall_score, CASE WHEN overall_score >= 70 THEN 'high' WHEN overall_score >= 40 THEN 'moderate' ELSE 'low' END AS advice FROM scored""",
       "parcels")
def r11(spark, sf):
    return crops.likelihood(crops.coverage_by_state(table(spark, sf, "parcels"))).select("state_code", "overall_score", "advice")


@query("r12_source_strategy", f"""WITH {TOTALS} SELECT round(eligible_parcels / parcels_with_coords, 6) AS eligible_share,
  CASE WHEN eligible_parcels / parcels_with_coords > 0.8 THEN 'CDL_FOCUSED' WHEN eligible_parcels / parcels_with_coords > 0.4 THEN 'HYBRID_APPROACH'
    ELSE 'ALTERNATIVE_FOCUSED' END AS primary_strategy FROM totals""", "parcels")
def r12(spark, sf):
    totals = crops.coverage_totals(crops.coverage_by_state(table(spark, sf, "parcels")))
    return crops.source_strategy(totals).select(F.round("eligible_share", 6).alias("eligible_share"), "primary_strategy")


# Stations ---------------------------------------------------------------------------------------


@query("p26_station_filter", """
SELECT station_id, b.st AS search_state, latitude, longitude FROM stations s, (VALUES {}) AS b(st, a, z, w, e)
WHERE max_year >= 2021 AND data_coverage > 0.2 AND latitude BETWEEN a AND z AND longitude BETWEEN w AND e""".format(
    ", ".join(f"('{s}', {a}, {z}, {w}, {e})" for s, a, z, w, e in STATION_BOXES)), "stations")
def p26(spark, sf):
    out = climate.usable_stations(table(spark, sf, "stations"), min_year=2021, min_coverage=0.2)
    return out.select("station_id", "search_state", "latitude", "longitude")


@query("j17_station_coverage", """
SELECT count(*) AS total_stations, count(c.station_id) AS with_climate_data, count(c.station_id) / count(*) AS collection_rate
FROM stations s LEFT JOIN (SELECT DISTINCT station_id FROM station_climate) c USING (station_id)""", "stations station_climate")
def j17(spark, sf):
    return climate.station_coverage(table(spark, sf, "stations"), table(spark, sf, "station_climate"))
