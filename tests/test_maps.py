"""Portals, cards, map layers, grids and tables against brute force on small inputs."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import merge, spatial
from plumbline.plans import grid, model
from plumbline.sources import cards, osm, pages, portals, tables
from plumbline.streaming import steps


def metres(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6_371_000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


@pytest.fixture(scope="module")
def globe():
    """Points in the middle, at 70 degrees, at the poles and on both sides of the date line."""
    r = random.Random(3)
    spots = [(0, 0), (70, 10), (-70, 179.99), (89.99, 0), (-89.995, 90), (10, -180), (10, 180), (45, 179.995)]
    return [(k, max(-90.0, min(90.0, y + r.uniform(-0.02, 0.02))), (x + r.uniform(-0.02, 0.02) + 180) % 360 - 180) for k, (y, x) in enumerate(spots * 12)]


@pytest.mark.parametrize("reach, side", [(1000.0, "left"), (3000.0, "right"), (500_000.0, "left")])
def test_radius_join_anywhere(spark, globe, reach, side):
    left = spark.createDataFrame([*globe, (900, None, 1.0)], "id int, lat double, lng double")
    right = left.selectExpr("id r_id", "lat r_lat", "lng r_lng")
    got = {(r.id, r.r_id) for r in spatial.radius_join(left, right, reach, explode=side).collect()}
    assert got == {(a[0], b[0]) for a in globe for b in globe if metres(*a[1:], *b[1:]) <= reach}
    sums = spatial.radius_sums(left.unionAll(left), right, {"near": (F.lit(1), reach / 2), "all": (F.col("r_id"), reach)}).collect()
    assert len(sums) == 2 * (len(globe) + 1)  # repeated rows have the same sums each
    for r in sums:
        own = [(b[0], metres(r.lat, r.lng, *b[1:])) for b in globe] if r.lat is not None else []
        assert r.near == sum(m <= reach / 2 for _, m in own) and r["all"] == sum(k for k, m in own if m <= reach)


@pytest.mark.parametrize("direct, leaf", [(1e9, 64), (0, 64), (0, 2)])
def test_radius_sums_by_pairs_and_by_cells(spark, globe, monkeypatch, direct, leaf):
    monkeypatch.setattr(spatial, "DIRECT", direct)
    monkeypatch.setattr(spatial, "LEAF_POINTS", leaf)
    r = random.Random(5)
    dense = [(1000 + k, 5 + r.gauss(0, 0.01), 5 + r.gauss(0, 0.01)) for k in range(600)] + [(2000 + k, 5.0, 5.0) for k in range(50)] + [*globe]
    left = [*globe, *dense[::20], (900, None, 1.0)]
    got = spatial.radius_sums(spark.createDataFrame(left, "id int, lat double, lng double"), spark.createDataFrame(dense, "v int, r_lat double, r_lng double"), {"a": (F.lit(1), 300.0), "b": (F.col("v"), 900.0), "c": (F.col("v"), 2500.0)}).collect()
    assert len(got) == len(left)
    for x in got:
        own = [(v, metres(x.lat, x.lng, y, z)) for v, y, z in dense] if x.lat is not None else []
        assert (x.a, x.b, x.c) == (sum(m <= 300 for _, m in own), sum(v for v, m in own if m <= 900), sum(v for v, m in own if m <= 2500)), x


@pytest.mark.parametrize("rows", [200_000, 40])
def test_radius_sums_sweep_crowded_tiles(spark, globe, monkeypatch, rows):
    """A crowd is neither paired nor descended: totals and edges only, a tile's rows in bounded shares; values that are no finite numbers or decimals have the same sums."""
    r = random.Random(8)
    monkeypatch.setattr(spatial, "TILE_ROWS", rows)
    dense = [(float(k % 7), y + r.gauss(0, 0.004), x + r.gauss(0, 0.004)) for y, x in ((5, 5), (70, 179.999), (-89.995, 0)) for k in range(300)]
    dense = [(v, max(-90.0, y), (x + 180) % 360 - 180) for v, y, x in dense] + [(math.inf, 5.0, 5.0), (None, 5.0, 5.001), (0.1, 5.001, 5.0)]
    left = [*globe, *((2000 + k, y, x) for k, (_, y, x) in enumerate(dense[::9])), (900, None, 1.0), (901, math.nan, 1.0)]
    places, points = spark.createDataFrame(left, "id int, lat double, lng double"), spark.createDataFrame(dense, "v double, r_lat double, r_lng double")
    exact = spatial.radius_sums(places, points, {"n": (F.lit(1).cast("decimal(9,0)"), 400.0)}).collect()
    monkeypatch.setattr(spatial, "_descended", lambda *_: pytest.fail("cells of each circle's edge"))
    got = spatial.radius_sums(places, points, {"n": (F.lit(1), 400.0), "v": (F.col("v"), 2000.0)})
    assert [t for _, t in got.dtypes] == ["int", "double", "double", "bigint", "double"]
    for x in got.collect():
        own = [(v, metres(x.lat, x.lng, y, z)) for v, y, z in dense] if x.lat is not None and not math.isnan(x.lat) else []
        assert x.n == sum(m <= 400 for _, m in own) and x.v == pytest.approx(sum(v for v, m in own if m <= 2000 and v is not None), rel=1e-12, abs=0), x
    assert sorted((x.id, int(x.n)) for x in exact) == sorted((x.id, x.n) for x in got.collect())


def test_knn_is_complete_however_far(spark, globe):
    points = spark.createDataFrame(globe, "p int, r_lat double, r_lng double")
    queries = spark.createDataFrame([(1, 0.0, 100.0), (2, 10.0, -179.99)], "q int, lat double, lng double")
    for k in (3, 500):
        got = {}
        for r in spatial.knn_join(queries, points, k, 2000.0, "q", "p").collect():
            got.setdefault(r.q, []).append((r["rank"], r.p))
        for q, at in ((1, (0.0, 100.0)), (2, (10.0, -179.99))):
            expected = [p for _, p in sorted((metres(*at, *b[1:]), b[0]) for b in globe)][:k]
            assert [p for _, p in sorted(got[q])] == expected


def test_polygons_and_boxes(spark):
    r = random.Random(4)
    rings = [(k, [(x + s * math.cos(a), y + s * math.sin(a)) for a in (0, 1.1, 2.3, 3.9, 5.0)]) for k in range(40) for x, y, s in [(r.uniform(-3, 3), r.uniform(-3, 3), 10 ** r.uniform(-3, 0.5))]] + [(99, [])]
    points = [(k, r.uniform(-3, 3), r.uniform(-3, 3)) for k in range(300)]

    def inside(ring, y, x):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            odd ^= (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
        return odd

    shapes = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in ring]) for k, ring in rings], "s int, ring array<struct<x:double,y:double>>")
    got = {(p.k, p.s) for p in spatial.point_in_polygon(spark.createDataFrame(points, "k int, lat double, lng double"), shapes, "k", "s").collect()}
    assert got == {(k, s) for k, y, x in points for s, ring in rings if inside(ring, y, x)}
    boxes = [(k, y, y + h, x, x + w) for k, y, x in points[:60] for h, w in [(10 ** r.uniform(-3, 0.3), 10 ** r.uniform(-3, 0.3))]]

    def crosses(p, q, a, b):
        side = lambda u, v, w: (v[0] - u[0]) * (w[1] - u[1]) - (v[1] - u[1]) * (w[0] - u[0])
        return side(p, q, a) * side(p, q, b) < 0 and side(a, b, p) * side(a, b, q) < 0

    def meets(ring, y0, y1, x0, x1):
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
        edges = list(zip(corners, corners[1:] + corners[:1]))
        return any(x0 <= x <= x1 and y0 <= y <= y1 for x, y in ring) or any(inside(ring, y, x) for x, y in corners) or any(crosses(p, q, a, b) for p, q in zip(ring, ring[1:] + ring[:1]) for a, b in edges)

    closed = shapes.where("size(ring) > 0").withColumn("ring", F.expr("concat(ring, slice(ring, 1, 1))"))
    got = {(b.b, b.s) for b in spatial.box_meets_polygon(spark.createDataFrame(boxes, "b int, lat_min double, lat_max double, lng_min double, lng_max double"), closed, "b", "s").collect()}
    assert got == {(k, s) for k, *box in boxes for s, ring in rings if meets(ring, *box)}


def test_shapes_hold_points_at_no_distance(spark):
    square = [{"x": float(x), "y": float(y)} for x, y in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]
    shapes = spark.createDataFrame([("a", "Polygon", square), ("l", "LineString", square[:2]), ("p", "Point", square[:1]), ("none", "LineString", [])], "s string, type string, path array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, -0.001, 0.5), (3, 0.0, -0.002)], "k int, lat double, lng double")
    got = {(r.k, r.s): round(r.distance_m) for r in spatial.shape_distances(points, shapes, 1000.0, "k", "s").collect()}
    assert got == {(1, "a"): 0, (2, "a"): 111, (2, "l"): 111, (3, "a"): 222, (3, "l"): 222, (3, "p"): 222}


PAGE = """<body><div role="feed"><div class="x Nv2PK"><div><a class="hfpxzc" href="/maps/place/A/@-25.5,-57.5,17z/data=!4m7!1s0x1" aria-label="Bar A"></a></div>
<div><span class="ZkP5Je" aria-label="4,7 estrellas">4,7</span><span>(1.234)</span></div><div>₲ 1 · 2</div><div>Café · x · Calle 5 Cierra a las 5</div></div>
<a href="/maps/place/A2" aria-label="Bar A"></a><div class="Nv2PK"><a href="https://e.x/maps/place/B/" aria-label="Hotel B"></a><p>no</p><span>Hotel B Posada</span></div>
<a href="/maps/place/C" aria-label="Loose"></a><a href="/other" aria-label="No"></a></div><a href="/maps/place/D" aria-label="Outside"></a>"""


def test_result_cards(spark):
    rows = spark.createDataFrame([(1, PAGE), (2, None), (3, "<div role=feed>")], "page_id int, html string")
    got = [tuple(r) for r in cards.result_cards(rows).orderBy("pos").collect()]
    assert got == [
        (1, 0, "Bar A", -25.5, -57.5, "Café", "Calle 5", "https://www.google.com/maps/place/A/@-25.5,-57.5,17z/data=!4m7!1s0x1", "!4m7!1s0x1", 4.7, 1234),
        (1, 1, "Hotel B", 0.0, 0.0, "Posada", "", "https://e.x/maps/place/B/", "B", None, None),
        (1, 2, "Loose", 0.0, 0.0, "", "", "https://www.google.com/maps/place/C", "C", None, None),
    ]
    rates = {r.page_id: tuple(r)[1:] for r in cards.extraction_rates(rows, cards.result_cards(rows)).collect()}
    assert rates == {1: (1, 3, 2, 1, 67.0), 2: (0, 0, 0, 0, 0.0), 3: (0, 0, 0, 0, 0.0)}


def test_segments_end_where_pages_repeat(spark):
    page = lambda *ids: "x propiedades: " + json.dumps([{"id": i, "m2T": "2", "unidadDeMedida": "ha", "estado": "a]\\"} for i in ids])
    rows = [(0, 1, page(1, 2)), (0, 2, page(3)), (0, 3, page(3)), (0, 4, page(9)), (1, 1, page(2, 4)), (1, 2, page(1, 4)), (1, 3, page(8)), (2, 1, "nothing"), (2, 2, page(7)), (3, 1, page(5))]
    got = portals.segment_records(spark.createDataFrame(rows, "segment int, page int, html string"), "s")
    assert sorted(r.id_externo for r in got.collect()) == ["1", "2", "3", "4", "5"]
    one = portals.unified_b(got).where("id_externo = '1'").first()
    assert one.superficie_m2 == 20_000 and one.departamento == "a]\\" and one.url is None


def read_in_order(pages):
    """The ids that a loop over segments and pages keeps; pages: {(segment, page): ids}."""
    kept, ended, before, now = [], False, None, None
    for (segment, _), ids in sorted(pages.items()):
        if segment != now:
            now, ended, before = segment, False, None
        if ended or not ids or ids == before:
            ended = True
            continue
        new = [i for i in dict.fromkeys(ids) if i not in kept]
        kept += new
        before, ended = ids, not new
    return kept


def test_pages_behind_an_end_count_for_nothing(spark):
    html = lambda ids: "x propiedades: " + json.dumps([{"id": i} for i in ids])
    cases = [{(0, 1): ["a", "b"], (0, 2): ["b", "a"], (0, 3): ["z", "y"], (1, 1): ["z", "y"], (1, 2): ["q"]}]
    r = random.Random(6)
    for _ in range(4):
        cases.append({(s, p): [r.choice("abcdefghijklmnop") for _ in range(r.choice([0, 1, 2, 2, 3, 3]))] for s in range(9) for p in range(8)})
    # A chain: each segment's second page is new only if the one before it ended early.
    cases.append({(s, p): ids for s in range(12) for p, ids in enumerate([[f"x{s}"], [f"x{s}"] if s == 0 else [f"c{s - 1}"], [f"c{s}"]])})
    assert read_in_order(cases[0]) == ["a", "b", "z", "y", "q"]
    for pages in cases:
        rows = spark.createDataFrame([(s, p, html(ids)) for (s, p), ids in pages.items()], "segment int, page int, html string")
        assert sorted(x.id_externo for x in portals.segment_records(rows).collect()) == sorted(read_in_order(pages))


def test_brackets_in_strings():
    assert pages.bracketed('a m: x["b]\\"]", [1]] c', "m:") == '["b]\\"]", [1]]'
    assert pages.bracketed("m: [1, [2]", "m:") is None and pages.bracketed("none", "m:") is None and pages.bracketed(None, "m:") is None


def test_osm_geometries(spark, tmp_path):
    nodes = spark.createDataFrame([(k, float(k % 3), float(k // 3), {}) for k in range(9)], "id long, lon double, lat double, tags map<string,string>")
    ways = spark.createDataFrame([(1, {"highway": "primary", "leisure": "park"}, [0, 1, 4]), (2, {"leisure": "park"}, [0, 1, 4, 0]), (3, {"natural": "water"}, [0, 1, 77]), (4, {"shop": "x"}, [0, 1])], "id long, tags map<string,string>, nodes array<long>")
    relations = spark.createDataFrame([(1, {"place": "city"}, [("w", "outer", 3), ("w", "outer", 1), ("n", "outer", 2), ("w", "inner", 2)])], "id long, tags map<string,string>, members array<struct<type:string,role:string,ref:long>>")
    got = osm.layers(nodes, ways, relations)
    rows = {k: [(r.element, r.id, r.type, len(r.path)) for r in v.collect()] for k, v in got.items()}
    assert rows == {"vias": [("way", 1, "LineString", 3)], "parques": [("way", 2, "Polygon", 4)], "agua": [], "equipamiento": [], "limites": [("relation", 1, "Polygon", 3)]}
    osm.save_layers(got, f"{tmp_path}/layers")
    again = osm.load_layers(spark, f"{tmp_path}/layers")
    assert {k: [(r.element, r.id, r.type, len(r.path)) for r in v.collect()] for k, v in again.items()} == rows and again["vias"].first().highway == "primary"
    shape = json.loads(got["parques"].select(osm.geojson(F.col("type"), F.col("path")).alias("g")).first().g)
    assert shape == {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}


def test_grids(spark):
    cell = spark.createDataFrame([(0.0, 1.0, 0.0, 1.0)], "lat_min double, lat_max double, lng_min double, lng_max double")
    assert grid.expand_to_depth(cell, 3).count() == 64
    ring = spark.createDataFrame([("b", [{"x": x, "y": y} for x, y in ((0.1, 0.1), (0.2, 0.1), (0.2, 0.2), (0.1, 0.1))])], "boundary string, ring array<struct<x:double,y:double>>")
    assert grid.expand_to_depth(cell, 2, ring).count() == 1
    named = cell.select(grid.cell_key().alias("k"))
    assert tuple(named.select(grid.cell_of_key(F.col("k")).alias("c")).select("c.lat_min", "c.lat_max").first()) == (0.0, 1.0) and named.select(grid.cell_of_key(F.lit("x")).alias("c")).first().c is None
    assert cell.select(grid.cell_key().alias("k")).first().k == '{"lat_max":1.0,"lat_min":0.0,"lng_max":1.0,"lng_min":0.0}'


def test_tables(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.0, 2.0, None), ("b", 3.0, 4.0, "ü")], "name string, lat double, lng double, category string")
    tables.export_json(rows, f"{tmp_path}/j")
    whole = "".join(p.read_text() for p in sorted((tmp_path / "j").glob("part-*")))
    assert sorted(json.loads(whole), key=lambda x: x["name"]) == [{"name": "a", "lat": 1.0, "lng": 2.0, "category": None}, {"name": "b", "lat": 3.0, "lng": 4.0, "category": "ü"}]
    tables.export_json(rows.limit(0), f"{tmp_path}/e")
    assert json.loads("".join(p.read_text() for p in sorted((tmp_path / "e").glob("part-*")))) == []
    tables.export_csv(rows.coalesce(1), f"{tmp_path}/c")
    assert next((tmp_path / "c").glob("part-*")).read_bytes().startswith(b"\xef\xbb\xbfname")
    tables.publish(spark.range(3), f"{tmp_path}/t")
    tables.publish(spark.read.parquet(f"{tmp_path}/t").selectExpr("id + 10 id"), f"{tmp_path}/t")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [10, 11, 12] and [p.name for p in tmp_path.glob("t*")] == ["t"]
    with pytest.raises(FileNotFoundError):
        tables.union_existing(spark, [f"{tmp_path}/none"])
    assert tables.union_existing(spark, [f"{tmp_path}/none"], "a int").count() == 0
    (tmp_path / "b.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 0]]]}}, {"geometry": {"type": "MultiPolygon", "coordinates": [[[[5, 5], [6, 5], [5, 5]]], [[[7, 7], [8, 7], [7, 7]]]]}}]}))
    assert {r.boundary: (len(r.ring), r.ring[0].x) for r in tables.boundary_geojson(spark, f"{tmp_path}/b.json").collect()} == {"0-0": (3, 0.0), "1-0": (3, 5.0), "1-1": (3, 7.0)}
    tasks = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, "c", 0, 0, 0.5)], "lat_min double, lat_max double, lng_min double, lng_max double, category string, depth int, retry_count int, priority double")
    tables.export_tasks(tasks, f"{tmp_path}/tasks")
    assert tables.task_lines(spark, f"{tmp_path}/tasks").select("grid_cell.lat_max", "category", "priority").first() == (2.0, "c", 0.5)


@pytest.mark.parametrize("n, k", [(10, 3), (3, 7), (100, 7), (0, 2)])
def test_shards(spark, n, k):
    rows = spark.range(n).repartition(5)
    assert {r.id: r.shard for r in tables.shards(rows, ["id"], k).collect()} == {i: i % k for i in range(n)}
    sizes = [n // k + (i < n % k) for i in range(k)]
    expected = dict(enumerate(s for s, size in enumerate(sizes) for _ in range(size)))
    assert {r.id: r.shard for r in tables.shards(rows, ["id"], k, contiguous=True).collect()} == expected


def test_texts(spark):
    def one(f, *values):
        return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(f(F.col("x"))).collect()]

    assert one(text.unaccented, "  ÇÅñandú Ễ ", None, "é") == ["canandu e", "", "e"]
    assert one(text.norm, " Ñandú  Ç ") == ["nandu ç"]
    assert one(text.rating_category, "Bar 4.5 Café ", "x NO HAY opiniones Hotel", "4,5(12) Café", None) == ["Café", "Hotel", None, None]
    assert one(text.place_id, "a/b/", "a/b?x#y", "a/@1", "x/data=!1?z", None) == ["b", "b?x#y", None, "!1?z", None]
    assert [r.lat for r in spark.createDataFrame([("/@1.5,2.5,17z",), ("/@1.5,2.5",)], "x string").select(text.coordinates(F.col("x")).alias("c")).select("c.lat").collect()] == [1.5, None]
    assert [r[0].a for r in spark.createDataFrame([('{"a": 1}',), ("bad",), (None,)], "x string").select(text.tolerant_json(F.col("x"), "a int")).collect()] == [1, None, None]


def test_stream_into_the_stored_table(spark, tmp_path):
    """Three runs of one query, each a restart from the checkpoint; a batch that failed half-way is repeated."""
    raw = "seq long, name string, lat string, lng string, category string, source_url string"
    batches = [
        [(1, "A", "1", "1", "x", "https://e/a1"), (2, "a", "1", "1", "x", None), (3, " ", "1", "1", None, None)], [(4, "B", "1", "1", "x", "https://e/b1"), (5, "C", None, None, "x", "/@2.5,3.5,17z")],
        [(6, "Other", "5", "5", "new", "https://e/b1"), (7, "A", "1", "1", "later", None), (8, "D", "9", "9", "x", "https://e/d1"), (9, "E", "9", "9", "y", "https://e/d1")],
    ]
    empty = spark.createDataFrame([], "id long, name string, lat double, lng double, category string, source_url string, google_place_id string")
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, raw).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        if k == 2:  # what a run that was killed while it wrote would leave
            (tmp_path / "out" / f"changes={k}").mkdir()
            (tmp_path / "out" / f"changes={k}" / "part-0.parquet").write_bytes(b"half")
        stream = spark.readStream.schema(raw).parquet(f"{tmp_path}/in/*")
        steps.storage_batches(steps.normalise_stream(stream), f"{tmp_path}/out", f"{tmp_path}/check", empty, gather=2).awaitTermination()
        got = {r.name: (r.id, r.category, r.source_url) for r in steps.stored_rows(spark, f"{tmp_path}/out", empty).collect()}
        assert got.keys() == [{"A"}, {"A", "B", "C"}, {"A", "B", "C", "D"}][k]
    assert got["B"] == (2, "new", "https://e/b1") and got["A"][:2] == (1, "later") and got["D"] == (4, "y", "https://e/d1")
    assert (tmp_path / "out" / "whole=1").exists() and len(list((tmp_path / "out" / "changes=2").glob("*.parquet"))) >= 1


def test_drain_in_order(spark, tmp_path):
    raw = "seq long, name string, lat string, lng string, category string, source_url string, search_category string"
    spark.createDataFrame([(1, "A", "1", "1", "Bar x", "https://e/a1", "bar"), (2, "B", "2", "2", " ", "https://e/b1", "bar"), (3, "C", "3", "3", "Bar x", "https://e/p9", "bar")], raw).write.parquet(f"{tmp_path}/in")
    columns = "id long, name string, lat double, lng double, category string, search_category string, source_url string, google_place_id string"
    empty = spark.createDataFrame([], columns)
    tables.publish(spark.createDataFrame([(5, "old", 0.0, 0.0, "x", "y", "https://e/p9", None)], columns), f"{tmp_path}/table")
    mappings = spark.createDataFrame([("bar", "t", "food")], "raw_norm string, type string, category string")
    q = steps.storage_batches(steps.normalise_stream(spark.readStream.schema(raw).parquet(f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/check", empty)
    counts = steps.drain(q, f"{tmp_path}/out", empty, mappings, f"{tmp_path}/table", f"{tmp_path}/json")
    assert counts == {"inserted": 1, "updated": 0}
    whole = json.loads("".join(p.read_text() for p in sorted((tmp_path / "json").glob("part-*"))))
    assert sorted(r["name"] for r in whole) == ["A", "old"]  # B has no category, C's link is known


def test_stream_ledger_resumes(spark, tmp_path):
    """The state after each restart is that of all events so far."""
    schema = "seq long, task string, status string, results_count long"
    r = random.Random(2)
    events = [(k, f"t{r.randrange(9)}", r.choice(["pending", "in_progress", "completed", "failed"]), r.randrange(50)) for k in range(90)]
    for k in range(3):
        spark.createDataFrame(events[30 * k : 30 * k + 30], schema).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        steps.ledger(stream, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
        expected = merge.task_state(spark.createDataFrame(events[: 30 * k + 30], schema))
        state = steps.ledger_state(spark, f"{tmp_path}/out")
        assert sorted(map(tuple, state.collect())) == sorted(map(tuple, expected.collect()))
    tasks = spark.createDataFrame([(f"t{k}",) for k in range(12)], "task string")
    done = {r.task for r in state.collect() if r.status == "completed"}
    assert {r.task for r in steps.unfinished(tasks, state).collect()} == {f"t{k}" for k in range(12)} - done


def test_quarantine_and_known(spark):
    rows = spark.createDataFrame([(1, "a", 1.0, 1.0), (2, "", 1.0, 1.0), (3, "c", None, 1.0), (4, "d", 1.0, 200.0)], "id int, name string, lat double, lng double")
    good, bad = merge.quarantine(rows, {"even": F.col("id") % 2 == 0})
    assert [r.id for r in good.collect()] == [1] and {r.id: r.reason for r in bad.collect()} == {2: "no name", 3: "no latitude", 4: "longitude out of range"}


def test_model_bundle_and_neighbours(spark, tmp_path):
    rows = spark.range(120).selectExpr("id", "cast(id % 12 as double) * 0.01 lat", "cast(id % 10 as double) * 0.01 lng", "cast(id % 7 as double) a", "100 + 10 * (id % 12) as price", "cast(id % 3 as int) fold").persist()
    got = model.cross_validate(rows, "price", ("a",), folds=3, trees=5, neighbours_m=2000.0)
    assert got.first().mae < model.baseline(rows, "price").first().mae
    assert model.winner({"none": model.baseline(rows, "price"), "forest": got}) == "forest"
    fitted = model.train_price_model(rows, "price", ("a",), trees=5)
    model.save_bundle(fitted, f"{tmp_path}/m", ("a",), "forest", 120, got, rows, "price")
    again, about, near = model.load_bundle(spark, f"{tmp_path}/m")
    assert about.features == ["a"] and about.n_train == 120 and near.count() == 120
    assert model.predict_price(again, rows, ("a",)).count() == 120
