"""The nearest shape of each layer against all pairs, and polygons of several rings."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import shapes as geometry
from plumbline.operators import nearest, spatial

from .test_maps import metres

SCHEMA = "layer string, id string, type string, rings array<array<struct<x:double,y:double>>>"


def inside(rings, y, x):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            odd ^= (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return odd


def best(y, x, members, sphere):
    """(distance, key) of the nearest shape, by every edge of every one."""
    out, c = [], math.cos(math.radians(y)) if sphere else 1.0
    for key, kind, rings in members:
        if kind in ("Polygon", "MultiPolygon") and inside(rings, y, x):
            out.append((0.0, 0.0, key))
        for ring in rings:
            for (px, py), (qx, qy) in zip(ring, ring[1:]) if len(ring) > 1 else [(ring[0], ring[0])]:
                dx, dy, ax, ay = (qx - px) * c, qy - py, (px - x) * c, py - y
                t = max(0.0, min(1.0, -(ax * dx + ay * dy) / (dx * dx + dy * dy))) if dx * dx + dy * dy else 0.0
                fx, fy = px + t * (qx - px), py + t * (qy - py)
                out.append((0.0 if sphere else (fx - x) ** 2 + (fy - y) ** 2, metres(y, x, fy, fx), key))
    return min(out)[1:]


def square(x, y, s):
    x, y = float(x), float(y)
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]


@pytest.fixture(scope="module")
def world():
    r = random.Random(8)
    walk = lambda x, y, n, s: [(x := x + r.uniform(-s, s), y := y + r.uniform(-s, s)) for _ in range(n)]
    out = [("road", f"r{k:03}", "LineString", [walk(r.gauss(0, 2), r.gauss(10, 2), r.randrange(2, 9), 10 ** r.uniform(-4, 0))]) for k in range(150)]
    out += [("spot", f"s{k:03}", "Point", [[(r.gauss(1, 0.001), r.gauss(11, 0.001))]]) for k in range(400)]  # a crowd
    out += [("spot", "far", "Point", [[(60.0, 50.0)]]), ("spot", "same2", "Point", [[(-5.0, 5.0)]]), ("spot", "same1", "Point", [[(-5.0, 5.0)]])]
    out += [("park", f"p{k:02}", "Polygon", [square(x, y, s), square(x + s / 4, y + s / 4, s / 2)]) for k in range(30) for x, y, s in [(r.gauss(0, 3), r.gauss(10, 3), 10 ** r.uniform(-2, 0.5))]]
    out += [("sea", "m", "MultiPolygon", [square(-3, 8, 1), square(-2.8, 8.2, 0.5), square(4, 12, 2)])]
    points = [(k, r.gauss(10, 2), r.gauss(0, 2)) for k in range(150)] + [(900, -60.0, 120.0), (901, 89.0, 0.0), (902, 5.0, -5.0), (903, 8.5, -2.5), (904, 13.0, 5.0), (905, None, 1.0)]
    return out, points


@pytest.mark.parametrize("sphere", [False, True])
@pytest.mark.parametrize("crowd", [nearest.CROWD, 2, 10**9])
def test_nearest_of_each_layer(spark, world, monkeypatch, sphere, crowd):
    monkeypatch.setattr(nearest, "CROWD", crowd)
    members, points = world
    shapes = spark.createDataFrame([(a, b, c, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for a, b, c, rings in members] + [("none", "n", "LineString", [])], SCHEMA)
    got = {(r.k, r.layer): (r.distance_m, r.id) for r in nearest.nearest_shapes(spark.createDataFrame(points, "k int, lat double, lng double"), shapes, "k", sphere=sphere).collect()}
    expected = {(k, layer): best(y, x, [m[1:] for m in members if m[0] == layer], sphere) for k, y, x in points if y is not None for layer in ("road", "spot", "park", "sea")}
    assert got.keys() == expected.keys()
    for key, (m, shape) in expected.items():
        assert got[key][0] == pytest.approx(m, rel=1e-9, abs=1e-6), (key, got[key], m, shape)
    assert got[902, "spot"] == (0.0, "same1") and got[904, "sea"][0] == 0 and got[903, "sea"][0] > 0  # 903 is in the hole


def test_no_shapes_and_no_points(spark):
    shapes, points = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, 0.0, 0.0)], "k int, lat double, lng double")
    assert nearest.nearest_shapes(points, shapes, "k").count() == 0
    one = spark.createDataFrame([("a", "x", "Point", [[{"x": 1.0, "y": 1.0}]])], SCHEMA)
    assert nearest.nearest_shapes(points.limit(0), one, "k").count() == 0 and nearest.nearest_shapes(points, one, "k").first().id == "x"


def test_holes_and_parts(spark):
    rings = [square(0, 0, 10), square(2, 2, 6), square(4, 4, 2), square(20, 0, 1)]
    one = spark.createDataFrame([("a", "x", "MultiPolygon", [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings])], SCHEMA)
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 5.0, 5.0), (4, 0.5, 20.5), (5, 0.5, 15.0)], "k int, lat double, lng double")
    assert sorted(r.k for r in spatial.point_in_polygon(points, one, "k", "id").collect()) == [1, 3, 4]
    near = {r.k: round(r.distance_m) for r in spatial.shape_distances(points, one, 120_000.0, "k", "id").collect()}
    assert near == {1: 0, 2: 111043, 3: 0, 4: 0} or (near.keys() == {1, 2, 3, 4} and near[2] > 100_000)
    boxes = spark.createDataFrame([(1, 2.5, 3.0, 2.5, 3.0), (2, 1.5, 3.0, 2.5, 3.0), (3, 4.5, 5.0, 4.5, 5.0), (4, 0.0, 0.4, 19.0, 20.5)], "b int, lat_min double, lat_max double, lng_min double, lng_max double")
    assert sorted(r.b for r in spatial.box_meets_polygon(boxes, one, "b", "id").collect()) == [2, 3, 4]


def test_geojson_round_trip(spark):
    texts = [
        {"type": "Point", "coordinates": [1.0, 2.0]}, {"type": "LineString", "coordinates": [[1.0, 2.0], [3.0, 4.0]]}, {"type": "Polygon", "coordinates": [[list(p) for p in square(0.0, 0.0, 4.0)], [list(p) for p in square(1.0, 1.0, 1.0)]]},
        {"type": "MultiPolygon", "coordinates": [[[list(p) for p in square(0.0, 0.0, 4.0)]], [[list(p) for p in square(9.0, 1.0, 1.0)]]]},
    ]
    rows = spark.createDataFrame([(k, json.dumps(t)) for k, t in enumerate(texts)] + [(9, "none"), (10, None)], "k int, t string").select("k", geometry.shape_of_geojson(F.col("t")).alias("s"))
    back = {r.k: r.t and json.loads(r.t) for r in rows.select("k", geometry.geojson_of_shape(F.col("s.type"), F.col("s.rings")).alias("t")).collect() if r.k < 9}
    assert back == dict(enumerate(texts)) and rows.where("k >= 9 and s is not null").count() == 0
    box = rows.where("k = 3").select(geometry.bounds(F.col("s.rings")).alias("b")).first().b
    assert tuple(box) == (0.0, 0.0, 10.0, 4.0)


def test_neighbours_of_a_crowd_take_a_radius_that_fits(spark):
    """A first radius that holds the whole crowd gives way to one of few points; copies of a place and a far query are served as well."""
    rng = random.Random(5)
    points = [(i, -25 + rng.random() / 50, -57 + rng.random() / 50) for i in range(2000)] + [(2000 + i, -25.01, -56.99) for i in range(50)]
    frame = spark.createDataFrame(points, "p int, r_lat double, r_lng double").persist()
    assert spatial._first_reach(frame, ("r_lat", "r_lng"), 4, 50_000.0) < 500
    queries = [*((i, y, x) for i, y, x in points[::25]), (9999, -24.0, -57.0)]
    got = {}
    for r in spatial.knn_join(spark.createDataFrame(queries, "q int, lat double, lng double"), frame, 4, 50_000.0, "q", "p", skip_self=True).collect():
        got.setdefault(r.q, []).append((r["rank"], r.p))

    def metres(a, b):
        (y, x), (v, u) = map(lambda t: tuple(map(math.radians, t)), (a, b))
        return 2 * 6_371_000 * math.asin(math.sqrt(math.sin((v - y) / 2) ** 2 + math.cos(y) * math.cos(v) * math.sin((u - x) / 2) ** 2))

    for q, y, x in queries:
        want = sorted((round(metres((y, x), p[1:]), 6), p[0]) for p in points if p[0] != q)[:4]
        assert sorted(got[q]) == [(k, p) for k, (_, p) in enumerate(want, 1)]


def test_nearest_named_forms_no_pairs_within_its_reach(spark, monkeypatch):
    """The nearest named shape is found by a descent, not among all that lie within the reach, which grow with both tables."""
    from plumbline.plans import radius

    monkeypatch.setattr(spatial, "line_distances", lambda *_, **__: pytest.fail("pairs within the reach"))
    shape = lambda k, name, y, x: (k, name, "k", "Point", [[{"x": x, "y": y}]])
    rows = [shape(1, None, 0.0, 0.0), shape(2, "b", 0.0, 0.01), shape(3, "a", 0.0, 0.02), shape(4, "", 5.0, 5.0), shape(5, "c", 9.0, 9.0)]
    shapes = spark.createDataFrame(rows, "shape int, name string, kind string, type string, rings array<array<struct<x:double,y:double>>>")
    points = spark.createDataFrame([(1, 0.0, -0.001), (2, 5.0, 5.0), (3, 8.9, 9.0), (4, None, 1.0)], "id int, lat double, lng double")
    got = {r.id: (r.name, round(r.distance_m)) for r in radius.nearest_named(points, shapes, named_m=2000.0, label="none").collect()}
    assert got == {1: ("b", 1223), 2: ("none (k)", 0), 3: ("c", 11119)}


@pytest.mark.parametrize("edged, splits", [(4, 4), (0, 2), (1000, 0)])
def test_first_polygons(spark, monkeypatch, edged, splits):
    """Of polygons that lie over each other the first by key, however cells are split."""
    monkeypatch.setattr(spatial, "EDGED", edged)
    monkeypatch.setattr(spatial, "SPLITS", splits)
    rng = random.Random(3)
    polygons = [("ab"[k % 2], k * 37 % 60, [[{"x": rng.random() * 2, "y": rng.random() * 2} for _ in range(3)]]) for k in range(60)]
    points = [(k, rng.random() * 2, rng.random() * 2) for k in range(300)]
    shapes = spark.createDataFrame(polygons, "layer string, id int, rings array<array<struct<x:double,y:double>>>")
    got = {(r.k, r.layer): r.id for r in spatial.first_polygons(spark.createDataFrame(points, "k int, lat double, lng double"), shapes, "k", "layer", "id").collect()}
    want = {}
    for k, y, x in points:
        for layer, i, rings in polygons:
            ring = [(p["x"], p["y"]) for p in rings[0]]
            if inside([[*ring, ring[0]]], y, x):
                want[k, layer] = min(i, want.get((k, layer), i))
    assert got == want and len(want) > 100


@pytest.mark.parametrize("bends, crowd", [(1, 32), (4, 2)])
def test_lines_around_as_listed_pairs(spark, monkeypatch, bends, crowd):
    """Counts, nearest and farthest without listing pairs: lines of one segment and of several, at the equator, at 60 degrees and where parallels are too short for bounds."""
    r = random.Random(9)
    spots = [(0.0, 20.0, 150), (60.0, -30.0, 150), (80.0, 40.0, 60)]
    points = [(k, y + r.gauss(0, 0.05), x + r.gauss(0, 0.05)) for k, (y, x) in enumerate((y, x) for y, x, n in spots for _ in range(n))] + [(901, 0.0, 20.0), (902, 0.0, 20.0), (903, None, 20.0), (904, -40.0, 20.0)]
    lines = [(k, [(x + r.gauss(0, 0.1) + j * r.uniform(-0.03, 0.03), y + r.gauss(0, 0.05) + j * r.uniform(-0.03, 0.03)) for j in range(bends + 1)] if k % 10 else [(x, y)]) for k, (y, x) in enumerate((y, x) for y, x, _ in spots for _ in range(60))] + [(999, [])]
    p = spark.createDataFrame(points, "id int, lat double, lng double")
    s = spark.createDataFrame(lines, "road int, path array<struct<x:double,y:double>>")
    expected = spatial.line_distances(p, s, 10_000.0, "id", "road").groupBy("id").agg(F.count("*").alias("n"), F.min("distance_m").alias("least_m"), F.max("distance_m").alias("most_m"))
    expected = {x.id: (x.n, x.least_m, x.most_m) for x in expected.collect()}
    monkeypatch.setattr(spatial, "CELL_POINTS", crowd)
    monkeypatch.setattr(spatial, "line_distances", lambda *_, **__: pytest.fail("all pairs within the reach"))
    got = spatial.lines_around(p, s, 10_000.0, "id", "road").collect()
    assert {x.id: (x.n, x.least_m, x.most_m) for x in got} == expected and len(got) == len(expected) and max(n for n, *_ in expected.values()) > 20


def test_line_pairs_are_spread_and_compared_once(spark, monkeypatch):
    """Points of one small file stand in several tasks, and the distance isn't repeated in a filter before the aggregate."""
    monkeypatch.setattr(spatial, "TASK_PLACES", 50)
    points = spark.range(200, numPartitions=1).selectExpr("id", "id / 100 lat", "id / 70 lng")
    lines = points.selectExpr("id road", "array(struct(lng x, lat y), struct(lng + 0.01 x, lat y)) path")
    got = spatial.line_distances(points, lines, 5000.0, "id", "road")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and plan.count("ATAN2") <= 1, plan
