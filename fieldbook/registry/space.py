"""Spatial, soil, climate assignment and water-rights queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldbook.functions import geo
from fieldbook.operators import climate, soil, spatial, topography, water
from fieldbook.registry import query
from fieldbook.registry.tables import base, spread, table

MILES = geo.EARTH_MILES


def hav(lat1, lon1, lat2, lon2):
    return (
        f"(2 * {MILES!r} * asin(sqrt(least(1.0, pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))))"
    )


TWO_POINTS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (25000 + l_partkey * 7919 % 24000) / 1000e0 AS lat1, (l_partkey * 104729 % 59000 - 125000) / 1000e0 AS lon1,
  CASE WHEN l_linenumber = 7 THEN (25000 + l_partkey * 7919 % 24000) / 1000e0 ELSE (25000 + l_suppkey * 6661 % 24000) / 1000e0 END AS lat2,
  CASE WHEN l_linenumber = 7 THEN (l_partkey * 104729 % 59000 - 125000) / 1000e0 ELSE (l_suppkey * 92821 % 59000 - 125000) / 1000e0 END AS lon2,
  l_extendedprice AS e1, l_quantity AS e2 FROM {lineitem}"""


def _two_points(spark, sf):
    return spark.sql(TWO_POINTS, lineitem=base(spark, sf, "lineitem"))


ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("g08_distance", f"""SELECT {ID}, round(CASE WHEN lat1 = lat2 AND lon1 = lon2 THEN 0.0 ELSE 6371000.0 * acos(least(1.0, greatest(-1.0,
  cos(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2) - radians(lon1)) + sin(radians(lat1)) * sin(radians(lat2))))) END, 1) AS metres
FROM ({TWO_POINTS.format(lineitem="lineitem")})""")
def g08(spark, sf):
    d = geo.great_circle_metres(*[F.col(c) for c in ("lat1", "lon1", "lat2", "lon2")])
    return _two_points(spark, sf).select(*ID.split(", "), F.round(d, 1).alias("metres"))


@query("g09_slope", f"""SELECT {ID}, round(CASE WHEN lat1 = lat2 AND lon1 = lon2 THEN 0.0 ELSE degrees(atan2(abs(e2 - e1),
  sqrt(pow(111319.5 * (lat2 - lat1), 2) + pow(111319.5 * cos(radians(lat1)) * (lon2 - lon1), 2)))) END, 7) AS slope
FROM ({TWO_POINTS.format(lineitem="lineitem")})""")
def g09(spark, sf):
    s = geo.slope_degrees(*[F.col(c) for c in ("lat1", "lon1", "e1", "lat2", "lon2", "e2")])
    return _two_points(spark, sf).select(*ID.split(", "), F.round(s, 7).alias("slope"))


@query("ud01_sql_functions", f"""SELECT {ID}, round(CASE WHEN lat1 = lat2 AND lon1 = lon2 THEN 0.0 ELSE degrees(atan2(abs(e2 - e1),
  sqrt(pow(111319.5 * (lat2 - lat1), 2) + pow(111319.5 * cos(radians(lat1)) * (lon2 - lon1), 2)))) END, 7) AS slope,
  round(CASE WHEN lat1 = lat2 AND lon1 = lon2 THEN 0.0 ELSE 6371000.0 * acos(least(1.0, greatest(-1.0,
  cos(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2) - radians(lon1)) + sin(radians(lat1)) * sin(radians(lat2))))) END, 1) AS metres
FROM ({TWO_POINTS.format(lineitem="lineitem")})""")
def ud01(spark, sf):
    from fieldbook.functions.sql_functions import register_geo_functions

    register_geo_functions(spark)
    points = _two_points(spark, sf)
    return spark.sql(
        f"SELECT {ID}, round(slope_between(lat1, lon1, e1, lat2, lon2, e2), 7) AS slope, round(metres_between(lat1, lon1, lat2, lon2), 1) AS metres FROM {{points}}",
        points=points,
    )


# Nearest station --------------------------------------------------------------------------------

NEAREST = f""" assigned AS (SELECT p.parcel_id, p.state_code, arg_min(s.station_id, ({hav('p.latitude', 'p.longitude', 's.latitude', 's.longitude')}, s.station_id)) AS station_id,
  min({hav('p.latitude', 'p.longitude', 's.latitude', 's.longitude')}) AS d FROM parcels p, stations s WHERE p.latitude IS NOT NULL GROUP BY 1, 2),
 climate AS (SELECT station_id, arg_max(precipitation, data_year) AS precipitation, max(data_year) AS data_year FROM station_climate GROUP BY 1)"""


def _assigned(spark, sf):
    near = spatial.nearest(table(spark, sf, "parcels"), table(spark, sf, "stations"), "parcel_id", "station_id")
    return near.join(climate.latest_climate(table(spark, sf, "station_climate")), "station_id", "left")


@query("j10_nearest_station", f"""WITH {NEAREST} SELECT parcel_id, station_id, round(d, 4) AS distance_miles, precipitation, data_year
FROM assigned LEFT JOIN climate USING (station_id)""", "parcels stations station_climate")
def j10(spark, sf):
    return _assigned(spark, sf).select(
        "parcel_id", "station_id", F.round("distance_miles", 4).alias("distance_miles"), "precipitation", "data_year"
    )


A03 = """count(*) AS total_parcels, count(station_id) AS with_assignments, count(precipitation) AS with_climate_data, count(DISTINCT station_id) AS unique_stations,
  count(station_id) / count(*) AS assignment_rate, count(precipitation) / count(*) AS coverage_rate FROM (SELECT * FROM assigned LEFT JOIN climate USING (station_id))"""


@query("a03_climate_coverage", f"WITH {NEAREST} SELECT {A03}", "parcels stations station_climate")
def a03(spark, sf):
    return climate.assignment_coverage(table(spark, sf, "parcels"), _assigned(spark, sf))


@query("a03_climate_coverage_by_state", f"WITH {NEAREST} SELECT state_code, {A03} GROUP BY 1", "parcels stations station_climate")
def a03_state(spark, sf):
    return climate.assignment_coverage(table(spark, sf, "parcels"), _assigned(spark, sf), by_state=True)


# Radius joins -----------------------------------------------------------------------------------

RIGHTS = """ rights AS (SELECT station_id AS right_id, latitude, longitude, station_name AS structure_name,
  CASE WHEN k % 9 = 8 THEN NULL ELSE '19' || (10 + k % 80) || '-05-31' END AS appropriation_date,
  CASE k % 4 WHEN 0 THEN 'GROUNDWATER' WHEN 1 THEN 'SURFACE' WHEN 2 THEN 'RESERVOIR' ELSE NULL END AS water_source FROM stations)"""
RADIUS = 60


def _rights(spark, sf):
    k = F.col("k")
    return table(spark, sf, "stations").select(
        F.col("station_id").alias("right_id"), "latitude", "longitude", F.col("station_name").alias("structure_name"),
        F.when(k % 9 != 8, F.concat(F.lit("19"), (F.lit(10) + k % 80).cast("string"), F.lit("-05-31"))).alias("appropriation_date"),
        F.when(k % 4 == 0, "GROUNDWATER").when(k % 4 == 1, "SURFACE").when(k % 4 == 2, "RESERVOIR").alias("water_source"),
    )


NEAR = f"""{RIGHTS}, near AS (SELECT p.parcel_id, r.*, {hav('p.latitude', 'p.longitude', 'r.latitude', 'r.longitude')} AS d FROM parcels p, rights r
  WHERE p.latitude IS NOT NULL AND {hav('p.latitude', 'p.longitude', 'r.latitude', 'r.longitude')} <= {RADIUS})"""


@query("j11_radius_rights", f"WITH {NEAR} SELECT parcel_id, right_id, round(d, 4) AS distance_miles FROM near", "parcels stations")
def j11(spark, sf):
    pairs = spatial.radius_pairs(table(spark, sf, "parcels"), _rights(spark, sf), "parcel_id", RADIUS)
    return pairs.select("parcel_id", F.col("r_right_id").alias("right_id"), F.round("distance_miles", 4).alias("distance_miles"))


def _found(spark, sf):
    rights, places = water.ranked(_rights(spark, sf))
    pairs = spatial.radius_pairs(table(spark, sf, "parcels"), rights, "parcel_id", RADIUS)
    return pairs.select("parcel_id", *[F.col(f"r_{c}").alias(c) for c in ("right_id", "seniority", "water_source")]), places


WATER = f"""{NEAR}, summary AS (SELECT parcel_id, count(*) AS rights_count, min(appropriation_date) AS most_senior_priority_date,
  arg_min(structure_name, (appropriation_date, structure_name)) FILTER (WHERE appropriation_date IS NOT NULL) AS most_senior_structure,
  coalesce(string_agg(DISTINCT water_source, ',' ORDER BY water_source), '') AS water_sources FROM near GROUP BY 1)"""


@query("a12_water_summary", f"WITH {WATER} SELECT * FROM summary", "parcels stations")
def a12(spark, sf):
    found, places = _found(spark, sf)
    out = water.summarise(found, places=places)
    return out.withColumn("water_sources", F.array_join("water_sources", ","))


@query("r13_water_gate", f"""WITH {WATER}, gated AS (SELECT CASE WHEN state_code NOT IN ('CO', 'TX', 'NM', 'KS') THEN 'state_not_supported'
  WHEN latitude IS NULL OR longitude IS NULL THEN 'no_coordinates' WHEN s.rights_count IS NULL THEN 'no_rights_found' ELSE 'ok' END AS reason
  FROM parcels p LEFT JOIN summary s USING (parcel_id)) SELECT reason, reason = 'ok' AS available, count(*) AS parcels FROM gated GROUP BY ALL""",
       "parcels stations")
def r13(spark, sf):
    found, places = _found(spark, sf)
    out = water.status(table(spark, sf, "parcels"), found, ["CO", "TX", "NM", "KS"], places)
    return out.groupBy("reason", "available").agg(F.count(F.lit(1)).alias("parcels"))


POINTS = """ points AS (SELECT parcel_id, latitude, longitude, acres, acres * 13 AS elevation_ft FROM parcels WHERE latitude IS NOT NULL),
 ranges AS (SELECT a.parcel_id, a.acres, min(b.elevation_ft) AS nearby_min, max(b.elevation_ft) AS nearby_max, CAST(count(*) AS BIGINT) AS nearby_count FROM points a
  JOIN points b ON b.latitude BETWEEN a.latitude - 0.5 AND a.latitude + 0.5 AND sqrt(pow(a.latitude - b.latitude, 2) + pow(a.longitude - b.longitude, 2)) * 69 <= 30 GROUP BY 1, 2)"""


def _ranges(spark, sf):
    points = table(spark, sf, "parcels").withColumn("elevation_ft", F.col("acres") * 13)
    return spatial.nearby_range(points, "elevation_ft", 30)


@query("j12_radius_elevation", f"WITH {POINTS} SELECT parcel_id, nearby_min, nearby_max, nearby_count FROM ranges", "parcels")
def j12(spark, sf):
    return _ranges(spark, sf).select("parcel_id", "nearby_min", "nearby_max", "nearby_count")


@query("g10_terrain", f"""WITH {POINTS}, slopes AS (SELECT parcel_id, nearby_max - nearby_min AS span,
   CASE WHEN acres > 0 THEN least(100.0, (nearby_max - nearby_min) / sqrt(acres * 43560) * 100) ELSE 0 END AS slope FROM ranges)
 SELECT parcel_id, span AS elevation_variance_ft, round(slope, 2) AS slope_percent, CASE WHEN slope < 2 THEN 'flat_terrain' WHEN slope < 8 THEN 'gently_sloping'
   WHEN slope < 15 THEN 'moderately_sloping' WHEN slope < 25 THEN 'steep_terrain' ELSE 'very_steep_terrain' END AS terrain_analysis FROM slopes""", "parcels")
def g10(spark, sf):
    out = _ranges(spark, sf)
    return out.withColumns(topography.terrain_columns(F.col("nearby_min"), F.col("nearby_max"), F.col("acres"))).select(
        "parcel_id", "elevation_variance_ft", "slope_percent", "terrain_analysis"
    )


# Raster -----------------------------------------------------------------------------------------

RASTER = """ raster AS (SELECT p_partkey // 118 AS r, p_partkey % 118 AS c, CASE WHEN p_partkey % 29 = 0 THEN -9999 ELSE p_retailprice END AS elevation FROM part)"""
GRID = dict(origin=(-125.0, 49.0), step=0.5, shape=(48, 118), nodata=-9999.0)


def _raster(spark, sf):
    k = F.col("p_partkey")
    return base(spark, sf, "part").select(
        F.floor(k / 118).alias("row"), (k % 118).alias("col"),
        F.when(k % 29 == 0, -9999.0).otherwise(F.col("p_retailprice")).alias("elevation"),
    )


@query("j13_raster_lookup", f"""WITH {RASTER} SELECT parcel_id, elevation FROM parcels LEFT JOIN raster ON r = floor((49.0 - latitude) / 0.5e0)
  AND c = floor((longitude + 125.0) / 0.5e0) AND elevation <> -9999 AND r BETWEEN 0 AND 47 AND c BETWEEN 0 AND 117""", "parcels")
def j13(spark, sf):
    out = spatial.raster_lookup(table(spark, sf, "parcels"), _raster(spark, sf), **GRID)
    return out.select("parcel_id", "elevation")


@query("g11_raster_terrain", f"""WITH {RASTER}, samples AS (SELECT parcel_id, acres, latitude + dy * CASE WHEN acres > 0 THEN sqrt(acres) * 0.0001e0 ELSE 0.001e0 END AS lat,
   longitude + dx * CASE WHEN acres > 0 THEN sqrt(acres) * 0.0001e0 ELSE 0.001e0 END AS lon
   FROM parcels, (VALUES (-1), (0), (1)) AS a(dy), (VALUES (-1), (0), (1)) AS b(dx) WHERE latitude IS NOT NULL)
 SELECT parcel_id, min(elevation) AS min_elevation_ft, max(elevation) AS max_elevation_ft, count(elevation) AS sample_points FROM samples LEFT JOIN raster
   ON r = floor((49.0 - lat) / 0.5e0) AND c = floor((lon + 125.0) / 0.5e0) AND elevation <> -9999 AND r BETWEEN 0 AND 47 AND c BETWEEN 0 AND 117 GROUP BY 1""", "parcels")
def g11(spark, sf):
    located = table(spark, sf, "parcels").where("latitude IS NOT NULL")
    return spatial.raster_terrain(located, "parcel_id", _raster(spark, sf), **GRID).drop("acres")


@query("g12_bounding_box", """SELECT state_code, min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon, max(longitude) AS max_lon
FROM parcels GROUP BY 1""", "parcels")
def g12(spark, sf):
    return spatial.bounding_box(table(spark, sf, "parcels").groupBy("state_code"))


@query("j14_coordinate_join", """SELECT p.parcel_id, s.parcel_id AS result_id FROM parcels p JOIN parcels s
  ON p.latitude = s.latitude AND p.longitude = s.longitude""", "parcels")
def j14(spark, sf):
    p = table(spark, sf, "parcels")
    results = p.select(F.col("parcel_id").alias("result_id"), "latitude", "longitude")
    return spatial.coordinate_join(p.select("parcel_id", "latitude", "longitude"), results).select("parcel_id", "result_id")


@query("g15_elevation_profile", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sequence, round(sum(segment) OVER (PARTITION BY l_orderkey ORDER BY sequence), 1) AS distance_m FROM (
  SELECT *, row_number() OVER w AS sequence, coalesce(CASE WHEN lat1 = lag(lat1) OVER w AND lon1 = lag(lon1) OVER w THEN 0.0 ELSE 6371000.0 * acos(least(1.0, greatest(-1.0,
    cos(radians(lag(lat1) OVER w)) * cos(radians(lat1)) * cos(radians(lon1) - radians(lag(lon1) OVER w)) + sin(radians(lag(lat1) OVER w)) * sin(radians(lat1))))) END, 0) AS segment
  FROM ({}) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, e1, e2))""".format(TWO_POINTS.format(lineitem="lineitem")))
def g15(spark, sf):
    points = _two_points(spark, sf).select(
        *ID.split(", "), F.col("lat1").alias("latitude"), F.col("lon1").alias("longitude"), "e1", "e2"
    )
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "e1", "e2")]
    out = spatial.elevation_profile(points, "l_orderkey", order)
    return out.select(*ID.split(", "), "sequence", F.round("distance_m", 1).alias("distance_m"))


# Polygons and soil ------------------------------------------------------------------------------

SQUARES = """ p AS (SELECT parcel_id, latitude AS y, longitude AS x, 0.05e0 + (k % 3) * 0.05e0 AS h, state_code FROM parcels WHERE latitude IS NOT NULL),
 u AS (SELECT p_partkey AS mukey, (25000 + p_partkey * 7907 % 24000) / 1000e0 AS y, (p_partkey * 104723 % 59000 - 125000) / 1000e0 AS x, 0.4e0 + (p_partkey % 4) * 0.1e0 AS h FROM part),
 met AS (SELECT p.parcel_id, u.mukey, p.x AS px, p.y AS py, p.h AS ph, u.x AS ux, u.y AS uy, u.h AS uh,
   greatest(p.x - p.h, u.x - u.h) AS x0, least(p.x + p.h, u.x + u.h) AS x1, greatest(p.y - p.h, u.y - u.h) AS y0, least(p.y + p.h, u.y + u.h) AS y1
   FROM p JOIN u ON p.x - p.h < u.x + u.h AND u.x - u.h < p.x + p.h AND p.y - p.h < u.y + u.h AND u.y - u.h < p.y + p.h),
 merc AS (SELECT *, ln(tan(pi() / 4 + radians(y0) / 2)) AS m0, ln(tan(pi() / 4 + radians(y1) / 2)) AS m1,
   ln(tan(pi() / 4 + radians(py - ph) / 2)) AS p0, ln(tan(pi() / 4 + radians(py + ph) / 2)) AS p1,
   ln(tan(pi() / 4 + radians(uy - uh) / 2)) AS u0, ln(tan(pi() / 4 + radians(uy + uh) / 2)) AS u1 FROM met),
 overlap AS (SELECT parcel_id, mukey, (x1 - x0) * (y1 - y0) / (4 * ph * ph) AS overlap_ratio,
   6378137.0 * 6378137.0 * radians(x1 - x0) * (m1 - m0) / 4047 AS intersection_acres, 6378137.0 * 6378137.0 * radians(2 * ph) * (p1 - p0) / 4047 AS parcel_acres,
   round(radians(x1 - x0) * (m1 - m0) / (radians(2 * ph) * (p1 - p0)) * 100, 6) AS coverage_percent,
   6378137.0 * sqrt(pow(radians(px - ux), 2) + pow((p0 + p1) / 2 - (u0 + u1) / 2, 2)) * 0.000621371 AS distance_miles FROM merc)"""


def _parcel_squares(spark, sf):
    p = spread(table(spark, sf, "parcels")).where("latitude IS NOT NULL")
    half = F.lit(0.05) + (F.col("k") % 3) * F.lit(0.05)
    return p.withColumn("wkt", geo.square_wkt(F.col("longitude"), F.col("latitude"), half))


def _units(spark, sf):
    k = F.col("p_partkey")
    units = spread(base(spark, sf, "part")).select(
        k.alias("mukey"), ((F.lit(25000) + k * 7907 % 24000) / 1000).alias("latitude"),
        ((k * 104723 % 59000 - 125000) / 1000).alias("longitude"), (F.lit(0.4) + (k % 4) * F.lit(0.1)).alias("half"),
    )
    return units.select("mukey", geo.square_wkt(F.col("longitude"), F.col("latitude"), F.col("half")).alias("wkt"))


def _metrics(spark, sf):
    pairs = spatial.overlap_pairs(_parcel_squares(spark, sf), _units(spark, sf), "parcel_id", "mukey", 0.5)
    return pairs


@query("j06_soil_overlap", f"""WITH {SQUARES} SELECT parcel_id, mukey, round(overlap_ratio + 1e-9, 5) AS overlap_ratio, round(intersection_acres, 2) AS intersection_acres,
  coverage_percent, round(distance_miles, 3) AS distance_miles FROM overlap""", "parcels")
def j06(spark, sf):
    return _metrics(spark, sf).select(
        "parcel_id", "mukey", F.round(F.col("overlap_ratio") + 1e-9, 5).alias("overlap_ratio"),
        F.round("intersection_acres", 2).alias("intersection_acres"), F.round("coverage_percent", 6).alias("coverage_percent"),
        F.round("distance_miles", 3).alias("distance_miles"),
    )


@query("j07_top_soils", f"""WITH {SQUARES}, ranked AS (SELECT parcel_id, mukey, overlap_ratio, row_number() OVER (PARTITION BY parcel_id ORDER BY round(overlap_ratio, 9) DESC, mukey) AS r FROM overlap)
 SELECT parcel_id, max(CASE WHEN r = 1 THEN mukey END) AS primary_mukey, round(max(CASE WHEN r = 1 THEN overlap_ratio END) + 1e-8, 5) AS primary_overlap,
   string_agg(mukey, ',' ORDER BY r) AS mukeys FROM ranked WHERE r <= 5 GROUP BY 1""", "parcels")
def j07(spark, sf):
    metrics = _metrics(spark, sf).withColumn("overlap_ratio", F.round("overlap_ratio", 9))
    out = spatial.top_units(metrics, "parcel_id", "mukey")
    return out.select(
        "parcel_id", "primary_mukey", F.round(F.col("primary_overlap") + 1e-8, 5).alias("primary_overlap"),
        F.array_join(F.transform("units", lambda u: u["mukey"].cast("string")), ",").alias("mukeys"),
    )


@query("g01_wkt_rings", f"""WITH {SQUARES} SELECT parcel_id, round(4 * h * h, 9) AS area, round(x, 6) AS cx, round(y, 6) AS cy, CAST(5 AS BIGINT) AS points FROM p""", "parcels")
def g01(spark, sf):
    ring = geo.ring_from_wkt(F.col("wkt"))
    out = _parcel_squares(spark, sf).withColumn("ring", ring).withColumn("c", geo.ring_centroid(F.col("ring")))
    return out.select(
        "parcel_id", F.round(geo.ring_area(F.col("ring")), 9).alias("area"), F.round("c.x", 6).alias("cx"),
        F.round("c.y", 6).alias("cy"), F.size("ring").cast("bigint").alias("points"),
    )


@query("g02_geojson_to_wkt", f"WITH {SQUARES} SELECT parcel_id, CASE WHEN h > 0.12 THEN NULL ELSE true END AS same FROM p", "parcels")
def g02(spark, sf):
    squares = _parcel_squares(spark, sf).withColumn("ring", geo.ring_from_wkt(F.col("wkt")))
    kind = F.when(F.col("k") % 3 == 2, "MultiPoint").otherwise("Polygon").alias("type")
    points = F.transform("ring", lambda p: F.array(p["x"], p["y"]))
    text = F.to_json(F.struct(kind, F.array(points).alias("coordinates")))
    back = squares.withColumn("back", geo.ring_to_wkt(geo.ring_from_geojson(text)))
    return back.select("parcel_id", (F.col("back") == F.col("wkt")).alias("same"))


@query("g03_mercator", f"""WITH {SQUARES} SELECT parcel_id, round(radians(x - h) * 6378137.0, 2) AS mx, round(ln(tan(pi() / 4 + radians(y - h) / 2)) * 6378137.0, 2) AS my FROM p""", "parcels")
def g03(spark, sf):
    out = _parcel_squares(spark, sf).withColumn("m", geo.mercator(geo.ring_from_wkt(F.col("wkt"))))
    first = F.col("m")[0]
    return out.select("parcel_id", F.round(first["x"], 2).alias("mx"), F.round(first["y"], 2).alias("my"))


def _soil_tables(spark, sf):
    part = base(spark, sf, "part")
    k = F.col("p_partkey")
    # Rows whose reference is empty join with nothing; every row of the tables is read.
    mapunits = part.select(F.when(k % 7 != 0, k).alias("mukey"), F.col("p_name").alias("muname"))
    li = base(spark, sf, "lineitem")
    lk = F.col("l_partkey")
    components = part.select(
        F.when(k % 5 != 0, k).alias("mukey"), (k * 10).alias("cokey"), F.col("p_brand").alias("compname"),
        (F.col("p_size") * 2).cast("bigint").alias("comppct_r"), F.when(k % 3 == 0, "Yes").otherwise("No").alias("majcompflag"),
        (k % 24).cast("double").alias("slope_r"), F.when(k % 4 != 0, F.col("p_type")).alias("hydgrp"),
    )
    horizons = li.select(
        (lk * 10).alias("cokey"), (F.col("l_quantity")).alias("hzdept_r"), (F.col("l_quantity") + 20).alias("hzdepb_r"),
        F.when(F.col("l_discount") > 0, F.col("l_discount") * 50).alias("om_r"), (F.lit(5.0) + F.col("l_tax") * 40).alias("ph1to1h2o_r"),
        F.col("l_quantity").alias("cec7_r"), F.lit(None).cast("double").alias("awc_r"), F.col("l_quantity").alias("sandtotal_r"),
        (F.lit(100.0) - F.col("l_quantity")).alias("silttotal_r"), F.col("l_quantity").alias("claytotal_r"),
        F.lit(None).cast("double").alias("pbray1_r"),
    )
    return mapunits, components, horizons


SOIL = f"""{SQUARES},
 comp AS (SELECT o.*, coalesce(CASE WHEN k.p_partkey % 7 <> 0 THEN k.p_name END, 'Unknown') AS map_unit_name, k.p_partkey * 10 AS cokey, k.p_brand AS soil_series, k.p_size * 2 AS pct,
   k.p_partkey % 3 = 0 AS major, k.p_partkey % 24 AS slope, coalesce(CASE WHEN k.p_partkey % 4 <> 0 THEN k.p_type END, 'Unknown') AS hydrologic_group
   FROM overlap o JOIN part k ON CASE WHEN k.p_partkey % 5 <> 0 THEN k.p_partkey END = o.mukey WHERE k.p_partkey % 3 = 0 OR k.p_size * 2 >= 15),
 scored AS (SELECT *, CASE WHEN coverage_percent >= 75 AND pct >= 75 THEN 0.95 WHEN coverage_percent >= 50 AND pct >= 50 THEN 0.85 WHEN coverage_percent >= 25 AND pct >= 25 THEN 0.75
     WHEN coverage_percent >= 10 AND pct >= 15 THEN 0.65 ELSE 0.5 END AS confidence_score,
   CASE WHEN coverage_percent >= 75 AND major THEN 'Excellent' WHEN coverage_percent >= 50 AND major THEN 'Good' WHEN coverage_percent >= 25 OR major THEN 'Fair' ELSE 'Poor' END AS match_quality FROM comp),
 hor AS (SELECT l_partkey * 10 AS cokey, l_quantity AS q, CASE WHEN l_discount > 0 THEN l_discount * 50 END AS om, 5.0 + l_tax * 40 AS ph FROM lineitem),
 prof AS (SELECT s.*, coalesce(h.om, 2.0) AS om, coalesce(h.ph, 6.5) AS ph, coalesce(h.q, 10.0) AS cec, coalesce(h.q, 40.0) AS sand, coalesce(100 - h.q, 40.0) AS silt, coalesce(h.q, 20.0) AS clay
   FROM scored s LEFT JOIN hor h ON h.cokey = s.cokey WHERE h.q <= 30 OR h.q IS NULL)"""


@query("g14_soil_profile", f"""WITH {SOIL} SELECT parcel_id, mukey, map_unit_name, soil_series, hydrologic_group, CAST(confidence_score AS DOUBLE) AS confidence_score, match_quality,
  round(om, 4) AS organic_matter_pct, round(ph, 4) AS ph_level, cec AS cation_exchange_capacity,
  CASE WHEN clay >= 40 THEN 'Clay' WHEN sand >= 70 THEN 'Sandy' WHEN silt >= 50 THEN 'Silty' ELSE 'Loam' END AS soil_type,
  CASE WHEN om >= 3.0 AND ph BETWEEN 6.0 AND 7.0 THEN 'High' WHEN om >= 2.0 AND ph BETWEEN 5.5 AND 7.5 THEN 'Medium' ELSE 'Low' END AS fertility_class,
  CASE WHEN slope <= 6 AND ph BETWEEN 6.0 AND 7.5 THEN 'Class I-II - Excellent' WHEN slope <= 12 AND ph BETWEEN 5.5 AND 8.0 THEN 'Class III - Good'
    WHEN slope <= 18 THEN 'Class IV - Fair' ELSE 'Class V+ - Limited' END AS agricultural_capability,
  round(CASE WHEN cec >= 15 THEN cec * 8 ELSE cec * 6 END, 4) AS potassium_ppm, round(CASE WHEN om >= 3.0 THEN om * 20 ELSE om * 15 END, 4) AS nitrogen_ppm FROM prof""", "parcels")
def g14(spark, sf):
    out = soil.soil_profile(_parcel_squares(spark, sf), _units(spark, sf), *_soil_tables(spark, sf), cell_size=0.5)
    r4 = ("organic_matter_pct", "ph_level", "potassium_ppm", "nitrogen_ppm")
    return out.select(
        "parcel_id", "mukey", "map_unit_name", "soil_series", "hydrologic_group", "confidence_score", "match_quality",
        *[F.round(c, 4).alias(c) for c in r4], "cation_exchange_capacity", "soil_type", "fertility_class", "agricultural_capability",
    )


@query("j08_components", f"""WITH {SOIL} SELECT parcel_id, mukey, map_unit_name, soil_series, CAST(pct AS BIGINT) AS component_percentage, match_quality FROM scored""", "parcels")
def j08(spark, sf):
    mapunits, components, _ = _soil_tables(spark, sf)
    metrics = _metrics(spark, sf).withColumn("coverage_percent", F.round("coverage_percent", 6))
    out = soil.attach_components(metrics, mapunits, components)
    return out.select("parcel_id", "mukey", "map_unit_name", "soil_series", "component_percentage", "match_quality")


@query("j09_surface_horizons", """
SELECT p_partkey * 10 AS cokey, coalesce(q + 20, 30.0) AS sampling_depth_cm, round(coalesce(om, 2.0), 4) AS organic_matter_pct FROM part
LEFT JOIN (SELECT l_partkey, l_quantity AS q, CASE WHEN l_discount > 0 THEN l_discount * 50 END AS om FROM lineitem) h ON h.l_partkey = p_partkey
WHERE q <= 30 OR q IS NULL""")
def j09(spark, sf):
    _, components, horizons = _soil_tables(spark, sf)
    out = soil.attach_horizons(components.withColumn("slope_percent", F.col("slope_r")), horizons)
    return out.select("cokey", "sampling_depth_cm", F.round("organic_matter_pct", 4).alias("organic_matter_pct"))


@query("t04_soil_order", f"""WITH {SOIL} SELECT parcel_id, mukey, round(coverage_percent, 3) AS coverage_percent, CAST(pct AS BIGINT) AS component_percentage FROM scored
ORDER BY round(coverage_percent, 3) DESC, component_percentage DESC, parcel_id, mukey""", "parcels")
def t04(spark, sf):
    mapunits, components, _ = _soil_tables(spark, sf)
    out = soil.attach_components(_metrics(spark, sf), mapunits, components).select(
        "parcel_id", "mukey", F.round("coverage_percent", 3).alias("coverage_percent"), "component_percentage"
    )
    return out.orderBy(F.desc("coverage_percent"), F.desc("component_percentage"), "parcel_id", "mukey")


@query("g13_soil_classes", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN q >= 40 THEN 'Clay' WHEN 90 - q >= 70 THEN 'Sandy' WHEN q * 2 >= 50 THEN 'Silty' ELSE 'Loam' END AS soil_type,
  CASE WHEN om >= 3.0 AND ph BETWEEN 6.0 AND 7.0 THEN 'High' WHEN om >= 2.0 AND ph BETWEEN 5.5 AND 7.5 THEN 'Medium' ELSE 'Low' END AS fertility_class,
  CASE WHEN sl <= 6 AND ph BETWEEN 6.0 AND 7.5 THEN 'Class I-II - Excellent' WHEN sl <= 12 AND ph BETWEEN 5.5 AND 8.0 THEN 'Class III - Good'
    WHEN sl <= 18 THEN 'Class IV - Fair' ELSE 'Class V+ - Limited' END AS agricultural_capability
FROM (SELECT *, l_quantity AS q, l_quantity / 10 AS om, 5 + l_linenumber / 2e0 AS ph, l_suppkey % 24 AS sl FROM lineitem)""")
def g13(spark, sf):
    q = F.col("l_quantity")
    cols = soil.lab_classes(q / 10, F.lit(5) + F.col("l_linenumber") / 2, q, F.lit(90) - q, q * 2, q, F.col("l_suppkey") % 24)
    names = ("soil_type", "fertility_class", "agricultural_capability")
    return base(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *[cols[n].alias(n) for n in names])
