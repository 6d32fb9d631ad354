import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain_clip
from fieldbook.functions import geo
from fieldbook.operators import quadtree, spatial, topography
from fieldbook.session import cut_lineage


def scatter(spark, n, seed, hot=True):
    """Points over the globe; a third of them in one small place, one copied many times."""
    rng = np.random.default_rng(seed)
    lat, lon = rng.uniform(-89, 89, n), rng.uniform(-180, 180, n)
    if hot:
        lat[: n // 3], lon[: n // 3] = 30 + rng.normal(0, 0.02, n // 3), -97 + rng.normal(0, 0.02, n // 3)
        lat[: n // 10], lon[: n // 10] = 30.0, -97.0
    return spark.createDataFrame([(int(i), float(a), float(b)) for i, (a, b) in enumerate(zip(lat, lon))], "id long, latitude double, longitude double")


def haversine(lat1, lon1, lat2, lon2):
    a, b = np.radians(lat1), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * geo.EARTH_MILES * np.arcsin(np.sqrt(np.minimum(1, h)))


def pair_distances(a, b):
    return haversine(a.latitude.values[:, None], a.longitude.values[:, None], b.latitude.values[None, :], b.longitude.values[None, :])


@pytest.mark.parametrize("seed,stations", [(1, 1), (2, 60), (3, 400)])
def test_nearest_matches_brute_force(spark, seed, stations):
    left, right = scatter(spark, 400, seed), scatter(spark, stations, seed + 10).withColumnRenamed("id", "sid")
    got = {r["id"]: r for r in spatial.nearest(left, right, "id", "sid").collect()}
    a, b = left.toPandas(), right.toPandas()
    d = pair_distances(a, b)
    assert len(got) == len(a)
    for i, row in enumerate(a.itertuples()):
        assert got[row.id]["distance_miles"] == pytest.approx(d[i].min(), abs=1e-6)
        assert d[i][got[row.id]["sid"]] == pytest.approx(d[i].min(), abs=1e-6)


def test_equidistant_stations_go_to_the_lower_id(spark):
    left = spark.createDataFrame([("p", 0.0, 0.0)], "id string, latitude double, longitude double")
    right = spark.createDataFrame([("s2", 0.0, 1.0), ("s1", 0.0, -1.0)], "sid string, latitude double, longitude double")
    assert spatial.nearest(left, right, "id", "sid").first()["sid"] == "s1"


def test_a_city_is_cut_into_small_leaves(spark):
    """A million points within a tenth of a degree: no leaf is crowded, and a sample of them has the true neighbours."""
    draw = lambda seed: [(30 + F.rand(seed) * 0.1).alias("latitude"), (-97 + F.rand(seed + 1) * 0.1).alias("longitude")]
    left = cut_lineage(spark.range(50_000).select("id", *draw(1)).union(spark.range(7).selectExpr("-id - 1", "id * 10D", "id * -20D")))
    right = cut_lineage(spark.range(1_000_000).select(F.col("id").alias("sid"), *draw(3)))
    for side, size in ((left, quadtree.ASKING), (right, quadtree.FOUND)):
        counts = quadtree.leaves(side, size).groupBy("level", "y", "x").count().agg(F.max("count").alias("most"), F.count("*").alias("n")).first()
        assert counts["most"] < 4 * size and counts["n"] > side.count() / size / 4
    got = spatial.nearest(left, right, "id", "sid").where("id % 499 = 0 OR id < 0").toPandas().set_index("id")
    a, b = left.where("id % 499 = 0 OR id < 0").toPandas(), right.toPandas()
    d = pair_distances(a, b)
    assert len(got) == len(a)
    assert np.allclose(got.loc[a.id, "distance_miles"], d.min(axis=1), atol=1e-6)


@pytest.mark.parametrize("miles", [0.25, 40, 900])
def test_radius_pairs_match_brute_force(spark, miles):
    left = scatter(spark, 250, 5).union(spark.createDataFrame([(900, 0.0, 179.999), (901, 89.9, 10.0)], "id long, latitude double, longitude double"))
    right = scatter(spark, 200, 6).union(spark.createDataFrame([(900, 0.0, -179.999), (901, 89.9, -170.0)], "id long, latitude double, longitude double"))
    got = {(r["id"], r["r_id"]) for r in spatial.radius_pairs(left, right, "id", miles, per_task=20).collect()}
    a, b = left.toPandas(), right.toPandas()
    i, j = np.nonzero(pair_distances(a, b) <= miles)
    assert got == {(a.id[x], b.id[y]) for x, y in zip(i, j)}


@pytest.mark.parametrize("crowded", [0, 10, 100000])
def test_nearby_range_is_exact_on_every_path(spark, crowded):
    rng = np.random.default_rng(3)
    lat = np.round(30 + rng.normal(0, 0.006, 500), 5)
    lon = np.round(-97 + rng.normal(0, 0.006, 500), 5)
    lat[:150], lon[:150] = 30.0, -97.0
    points = spark.createDataFrame([(int(i), float(a), float(b), float(i % 83)) for i, (a, b) in enumerate(zip(lat, lon))], "id long, latitude double, longitude double, e double")
    got = {r["id"]: r for r in spatial.nearby_range(points, "e", 0.5, crowded=crowded, parts=4, per_task=40).collect()}
    e = np.arange(500) % 83
    for i in range(500):
        near = np.sqrt((lat[i] - lat) ** 2 + (lon[i] - lon) ** 2) * 69 <= 0.5
        r = got[i]
        assert (r["nearby_min"], r["nearby_max"], r["nearby_count"]) == (e[near].min(), e[near].max(), near.sum())


def area(spark, subject, other):
    row = spark.createDataFrame([(subject, other)], "a string, b string").select(geo.overlap(geo.ring_facts(F.col("a"))["edges"], geo.ring_facts(F.col("b"))["edges"]).alias("o")).first()
    return row["o"]["area"]


SQUARE = "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0))"


@pytest.mark.parametrize("other,expected", [
    (SQUARE, 16), ("POLYGON((2 0, 6 0, 6 4, 2 4, 2 0))", 8), ("POLYGON((2 2, 2 6, 6 6, 6 2, 2 2))", 4),
    ("POLYGON((4 4, 8 4, 8 8, 4 8, 4 4))", 0), ("POLYGON((0 0, 4 0, 0 4, 0 0))", 8), ("POLYGON((10 10, 11 10, 11 11, 10 10))", 0),
    ("POLYGON((0 0, 4 0, 4 1, 1 1, 1 3, 4 3, 4 4, 0 4, 0 0))", 10), ("POINT(1 1)", 0), (None, 0),
])
def test_overlap_areas(spark, other, expected):
    assert area(spark, SQUARE, other) == pytest.approx(expected)
    assert area(spark, other, SQUARE) == pytest.approx(expected)


def test_two_bent_polygons(spark):
    bent = "POLYGON((0 0, 4 0, 4 1, 1 1, 1 3, 4 3, 4 4, 0 4, 0 0))"
    turned = "POLYGON((0 0, 1 0, 1 3, 3 3, 3 0, 4 0, 4 4, 0 4, 0 0))"
    # By unit squares: rows 0 and 3 and column 0 against columns 0 and 3 and row 3.
    assert area(spark, bent, turned) == pytest.approx(8)


def test_overlap_pairs_once_per_pair(spark):
    a = spark.createDataFrame([("p", "POLYGON((0 0, 3 0, 3 3, 0 3, 0 0))")], "pid string, wkt string")
    b = spark.createDataFrame([(1, "POLYGON((-1 -1, 5 -1, 5 5, -1 5, -1 -1))"), (2, "POLYGON((3 3, 4 3, 4 4, 3 4, 3 3))"), (3, "broken")], "mid int, wkt string")
    rows = spatial.overlap_pairs(a, b, "pid", "mid", 0.5, per_task=3).collect()
    assert [(r["mid"], round(r["overlap_ratio"], 9)) for r in rows] == [(1, 1.0)]


def test_wkt_and_geojson(spark):
    df = spark.createDataFrame([(SQUARE, '{"type":"Point","coordinates":[1,2]}'), ("POLYGON((0 0, x 1))", "nope")], "w string, g string")
    rows = df.select(geo.ring_area(geo.ring_from_wkt(F.col("w"))).alias("a"), geo.ring_from_geojson(F.col("g")).alias("g")).collect()
    assert [r["a"] for r in rows] == [16.0, None] and [r["g"] for r in rows] == [None, None]


def test_distance_and_slope_of_equal_points(spark):
    z = F.lit(10.0)
    row = spark.range(1).select(geo.great_circle_metres(z, z, z, z).alias("d"), geo.slope_degrees(z, z, z, z, z, F.lit(99.0)).alias("s")).first()
    assert (row["d"], row["s"]) == (0.0, 0.0)


@pytest.mark.parametrize("slope,name", [(1.99, "flat_terrain"), (2, "gently_sloping"), (8, "moderately_sloping"), (15, "steep_terrain"), (25, "very_steep_terrain")])
def test_terrain_classes(spark, slope, name):
    assert spark.range(1).select(topography.terrain_class(F.lit(float(slope))).alias("c")).first()["c"] == name


def test_slope_is_capped(spark):
    cols = topography.terrain_columns(F.lit(0.0), F.lit(1000.0), F.lit(1.0))
    assert spark.range(1).select(cols["slope_percent"].alias("s")).first()["s"] == 100
    assert math.isclose(1000 / math.sqrt(43560) * 100, 479.1, abs_tol=0.1)


HOLED = "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))"
TWO = "MULTIPOLYGON Z (((0 0 9, 1 0 9, 1 1 9, 0 1 9, 0 0 9)), ((2 2 9, 4 2 9, 4 4 9, 2 4 9), (3 3 9, 3.5 3 9, 3.5 3.5 9)))"


@pytest.mark.parametrize("a,b,expected", [(HOLED, HOLED, 12), (HOLED, "POLYGON((0 0, 2 0, 2 2, 0 2))", 3), (TWO, TWO, 4.875), (TWO, HOLED, 3.875), (TWO, "POINT(1 1)", 0)])
def test_holes_and_multipolygons(spark, a, b, expected):
    assert area(spark, a, b) == pytest.approx(expected)
    assert area(spark, b, a) == pytest.approx(expected)


def test_holes_count_in_facts(spark):
    got = spark.createDataFrame([(HOLED,), (TWO,)], "w string").select(geo.ring_facts(F.col("w")).alias("f")).collect()
    assert [round(r["f"]["area"], 9) for r in got] == [12, 4.875]


def test_random_simple_rings():
    """Every simple ring, concave or not, on a coarse and a fine grid, has its whole area in common with a box around it."""
    random.seed(11)
    tried, pairs = 0, []
    cross = lambda o, p, q: (p[0] - o[0]) * (q[1] - o[1]) - (p[1] - o[1]) * (q[0] - o[0])
    meet = lambda a, b, c, d: cross(a, b, c) * cross(a, b, d) <= 0 and cross(c, d, a) * cross(c, d, b) <= 0
    box = (1, ((-9.0, -9.0), (9.0, -9.0), (9.0, 9.0), (-9.0, 9.0)))
    for grid in [1.0, 0.1] * 1500:
        k = random.randint(4, 9)
        turns = sorted(random.uniform(0, 2 * math.pi) for _ in range(k))
        ring = tuple((round(random.uniform(1, 7) * math.cos(t) / grid) * grid, round(random.uniform(1, 7) * math.sin(t) / grid) * grid) for t in turns)
        if len(set(ring)) < k or any(
            meet(ring[i], ring[(i + 1) % k], ring[j], ring[(j + 1) % k]) for i in range(k) for j in range(i + 2, k) if (j + 1) % k != i
        ):
            continue
        tried += 1
        own, want = (1, ring), abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1]))) / 2
        for a, b in ((own, box), (box, own), (own, own)):
            pairs.append((a, b, want))
    assert tried > 1000
    shared = batch_areas([((a,), (b,)) for a, b, _ in pairs], 5000)
    assert np.allclose(shared, [want for *_, want in pairs], atol=1e-9)


def batch_areas(pairs, at_once=10**6):
    """Areas that shapes (tuples of signed rings) have in common, all in one batch."""
    sides = [[np.array(geo._directed_edges(shape)).reshape(-1, 4) for shape in column] for column in zip(*pairs)]
    counts = [np.array([len(x) for x in column]) for column in sides]
    return geo.common_areas(np.concatenate(sides[0]), counts[0], np.concatenate(sides[1]), counts[1], at_once)


def test_batch_equals_clipping():
    """Random stars with holes, many pairs at once, against clipping ring by ring."""
    random.seed(5)

    def star(x, y, size):
        corners = random.randint(5, 12)
        turns = [(i + random.uniform(0, 0.9)) * 2 * math.pi / corners for i in range(corners)]  # goes round the centre
        return tuple((x + size * random.uniform(0.5, 1) * math.cos(t), y + size * random.uniform(0.5, 1) * math.sin(t)) for t in turns)

    def shape():
        x, y = random.uniform(-1, 1), random.uniform(-1, 1)
        hole = ((-1, tuple((x + 0.1 * math.cos(t), y + 0.1 * math.sin(t)) for t in (0, 2, 4))),) if random.random() < 0.6 else ()
        return ((1, star(x, y, 2.0)), *hole, *(((1, star(x + 5, y, 0.5)),) if random.random() < 0.3 else ()))

    pairs = [(shape(), shape()) for _ in range(600)]
    want = [sum(plain_clip.common(a, b)[0] for a in x for b in y) for x, y in pairs]
    for at_once in (1, 37, 10**6):
        assert np.allclose(batch_areas(pairs, at_once), want, atol=1e-9)


def test_one_python_pass_per_side(spark):
    a = spark.createDataFrame([("p", SQUARE)], "pid string, wkt string")
    plan = a.select(geo.ring_facts(F.col("wkt")).alias("p")).crossJoin(a.select(geo.ring_facts(F.col("wkt")).alias("u"))).select(geo.overlap(F.col("p.edges"), F.col("u.edges")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 3  # a pass for each side, one for the pairs


def test_geometry_text(spark):
    rows = [
        ('{"type": "Polygon", "coordinates": [[[0,0],[2,0],[2,2]],[[1,0.5],[1.5,0.5],[1.5,1]]]}', "POLYGON((0.0 0.0, 2.0 0.0, 2.0 2.0), (1.0 0.5, 1.5 0.5, 1.5 1.0))"),
        ('{"type": "MultiPolygon", "coordinates": [[[[0,0,7],[2,0,7],[2,2,7]]],[[[5,5],[6,5],[6,6]]]]}', "MULTIPOLYGON(((0.0 0.0, 2.0 0.0, 2.0 2.0)), ((5.0 5.0, 6.0 5.0, 6.0 6.0)))"),
        ('{"type": "MultiPoint", "coordinates": [[0,0],[2,0],[2,2]]}', None),
        ('{"type": "Polygon", "coordinates": [[[0,0],[2,0]]]}', None),
        ("{}", None),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "g string, w string")
    assert [r["o"] for r in df.select(geo.geometry_to_wkt(F.col("g")).alias("o")).collect()] == [w for _, w in rows]


def test_crowded_cells_are_split(spark):
    """A cell crowded on the right side spreads over salts, no row is shuffled on its bare cell, and pairs appear once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.range(3).select(F.col("id").alias("l"), F.lit(1).alias("c"))
    right = spark.range(1000).select(F.col("id").alias("r"), F.lit(1).alias("c"))
    joined = spatial.salted_cells(left, right, ["c"], F.col("l"), 100)
    assert joined.count() == joined.distinct().count() == 3000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_l" in line and "_r" in line for line in dealt) >= 2
