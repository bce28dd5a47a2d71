import json
import random

import pytest
from pyspark.sql import functions as F
from rows import plan_of, write

from skyledger.operators import geo
from skyledger.sources.regions import parse_features, read_features, region_table


def feature(code, geometry, **names):
    return {"type": "Feature", "properties": {"Code": code, "NAME": f"Region {code}"} | names, "geometry": geometry}


def polygon(*rings):
    return {"type": "Polygon", "coordinates": [[*r, r[0]] for r in rings]}


def box(x0, y0, x1, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1]]


FEATURES = [
    feature("L", polygon([[0, 0], [6, 0], [6, 3], [3, 3], [3, 6], [0, 6]])),
    feature("H", polygon(box(10, 0, 20, 10), box(13, 3, 17, 7))),
    feature("M", {"type": "MultiPolygon", "coordinates": [[[*box(-9, -9, -5, -5), [-9, -9]]], [[*box(-3, -3, -1, -1), [-3, -3]]]]}),
    feature("N", {"type": "GeometryCollection", "geometries": [polygon(box(20, 0, 24, 4)), {"type": "Point", "coordinates": [1, 2]}]}),
    feature("T", polygon([[30.5, 0.25], [37.25, 5.5], [31.125, 9.75]])),
]


@pytest.fixture(scope="module")
def regions(spark):
    texts = spark.createDataFrame([(json.dumps(f), i) for i, f in enumerate(FEATURES)], "value string, ord int")
    return region_table(parse_features(texts)).cache()


def points(spark, pairs):
    return spark.createDataFrame([(f"p{i}", x, y) for i, (x, y) in enumerate(pairs)],
                                 "flight_id string, longitude double, latitude double")


def place(spark, regions, pairs, degrees=1.0, **kw):
    out = geo.assign_regions(points(spark, pairs), geo.region_cells(regions, degrees), degrees, **kw)
    got = {r.flight_id: r.geo_region for r in out.collect()}
    return [got[f"p{i}"] for i in range(len(pairs))]


def test_inside_outside_edges_corners_holes(spark, regions):
    cases = {
        (1.0, 1.0): "L", (5.0, 5.0): None, (3.0, 4.5): "L", (6.0, 3.0): "L", (3.0, 3.0): "L", (1.5, 5.999): "L",
        (15.0, 5.0): None, (13.0, 5.0): "H", (17.0, 7.0): "H", (12.0, 5.0): "H", (10.0, 10.0): "H",
        (-7.0, -7.0): "M", (-4.0, -4.0): None, (-2.0, -2.0): "M", (-1.0, -1.0): "M",
        (0.0, 0.0): None, (None, 1.0): None, (1.0, None): None, (100.0, 80.0): None,
        (22.0, 2.0): "N", (33.0, 5.0): "T", (30.5, 0.25): "T",
    }
    assert place(spark, regions, list(cases)) == list(cases.values())


def test_shared_border_goes_to_the_nearest_centroid(spark, regions):
    # x = 20 belongs to H (centre 15, 5) and N (centre 22, 2).
    assert place(spark, regions, [(20.0, 2.0), (20.0, 9.0)]) == ["N", "H"]


@pytest.mark.parametrize("degrees", [0.5, 1.0, 7.0])
def test_random_points_equal_brute_force(spark, regions, degrees):
    rng = random.Random(7)
    pairs = [(rng.uniform(-10, 40), rng.uniform(-10, 12)) for _ in range(600)]
    pairs += [(float(rng.randint(-10, 25)), float(rng.randint(-10, 12))) for _ in range(300)]
    rows = {r.code: r.edges for r in regions.collect()}

    def inside(edges, x, y):
        odd = False
        for e in edges:
            cross = (e.x2 - e.x1) * (y - e.y1) == (e.y2 - e.y1) * (x - e.x1)
            if cross and min(e.x1, e.x2) <= x <= max(e.x1, e.x2) and min(e.y1, e.y2) <= y <= max(e.y1, e.y2):
                return True
            if (e.y1 > y) != (e.y2 > y) and x < (e.x2 - e.x1) * (y - e.y1) / (e.y2 - e.y1) + e.x1:
                odd = not odd
        return odd

    got = place(spark, regions, pairs, degrees)
    for (x, y), code in zip(pairs, got):
        hits = {c for c, edges in rows.items() if inside(edges, x, y)} if (x, y) != (0, 0) else set()
        assert (code in hits) if hits else code is None, (x, y)


def test_cells_join_by_hash_or_sort_with_equal_results(spark, regions):
    cells = geo.region_cells(regions)
    df = points(spark, [(1.0, 1.0), (None, None), (15.0, 1.0)])
    small = sorted(map(str, geo.assign_regions(df, cells).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = geo.assign_regions(df, cells)
        assert "SortMergeJoin" in plan_of(large) and "NestedLoop" not in plan_of(large)
        assert small == sorted(map(str, large.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nearest_of_two_tiny_regions(spark):
    shapes = [feature("A", polygon(box(0, 0, 0.001, 0.001))), feature("B", polygon(box(0.0005, 0, 0.0011, 0.001)))]
    regions = region_table(parse_features(spark.createDataFrame([(json.dumps(s), i) for i, s in enumerate(shapes)], "value string, ord bigint")))
    out = geo.assign_regions(points(spark, [(0.0006, 0.0005), (0.0009, 0.0005)]), geo.region_cells(regions))
    assert sorted((r.longitude, r.geo_region, r.geo_matches) for r in out.collect()) == [(0.0006, "A", 2), (0.0009, "B", 2)]


def test_region_files(spark, tmp_path):
    path = write(tmp_path, "r.geojson", json.dumps({"type": "FeatureCollection", "features": FEATURES[:2] + [
        feature("L", polygon(box(0, 0, 2, 2)), NAME="later")]}))
    table = {r.code: r for r in region_table(read_features(spark, path)).collect()}
    assert set(table) == {"L", "H"}
    assert (table["L"].name, table["L"].max_x, table["L"].centroid_x) == ("later", 2.0, 1.0)
    assert (table["H"].centroid_x, table["H"].centroid_y, len(table["H"].edges)) == (15.0, 5.0, 8)


@pytest.mark.parametrize("geometry", [None, {"type": "Point", "coordinates": [1, 2]}])
def test_region_without_polygon_is_an_error(spark, geometry):
    texts = spark.createDataFrame([(json.dumps(feature("X", geometry)), 0)], "value string, ord int")
    with pytest.raises(Exception, match="no polygon"):
        region_table(parse_features(texts)).collect()


def test_region_without_code_is_an_error(spark):
    f = {"type": "Feature", "properties": {"name": "x"}, "geometry": polygon(box(0, 0, 1, 1))}
    texts = spark.createDataFrame([(json.dumps(f), 0)], "value string, ord int")
    with pytest.raises(Exception, match="code"):
        region_table(parse_features(texts)).collect()


def test_geometry_rules(spark):
    open_ring = {"type": "Polygon", "coordinates": [box(0, 0, 1, 1)]}
    short = {"type": "Polygon", "coordinates": [[[0, 0], [200, 0], [0, 0]]]}
    items = [feature("A", open_ring), feature("B", short), feature("", polygon(box(0, 0, 1, 1))),
             feature("D", polygon(box(0, 0, 1, 1))), feature("D", polygon(box(0, 0, 1, 1))), feature("E", None)]
    texts = spark.createDataFrame([(json.dumps(f), i) for i, f in enumerate(items)], "value string, ord int")
    got = sorted((r.code, r.problems) for r in geo.region_geometry_check(parse_features(texts)).collect())
    assert got == [("", "code_missing"), ("A", "ring_open"), ("B", "ring_short,out_of_range"),
                   ("D", "code_repeated"), ("D", "code_repeated"), ("E", "no_polygon")]


def test_ratio_audit_and_lookup(spark, regions):
    df = points(spark, [(1.0, 1.0), (15.0, 5.0), (0.0, 0.0), (12.0, 5.0)]).withColumn("start_time_utc", F.lit("2024-01-01").cast("timestamp_ntz"))
    out = geo.assign_regions(df, geo.region_cells(regions))
    assert geo.geocoded_ratio(out).first().asDict() == {"flights": 4, "geocoded": 2, "geocoded_ratio": 0.5, "alert": True}
    stored = geo.flights_geo(out, "v").withColumn("region_code", F.coalesce("region_code", F.lit("L")))
    audit = {r.region_code: (r.stored, r.intersected) for r in geo.audit_locations(stored, geo.region_cells(regions)).collect()}
    assert audit == {"L": (2, 1), "H": (1, 1)}
    named = geo.with_region_names(spark.createDataFrame([("L",), ("?",), (None,)], "region_code string"), regions)
    assert {(r.region_code, r.directory_name) for r in named.collect()} == {("L", "Region L"), ("?", None), (None, None)}
