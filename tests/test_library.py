"""Hand-computed cases of the library's own operators, and its queries against their SQL."""

import glob
import math
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from plumbline.functions import geo, text
from plumbline.operators import curate, dedup, gap, listings, merge, normalize, spatial
from plumbline.plans import grid, model
from plumbline.queries import ORACLES, QUERIES
from plumbline.sources import pages, tables

SF = "/root/testdata/sf0.001"


def distance(a, o, b, p):
    x = math.sin(math.radians(b - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(b)) * math.sin(math.radians(p - o) / 2) ** 2
    return 2 * 6371000 * math.atan2(math.sqrt(x), math.sqrt(1 - x))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def shown(rows):
    one = lambda v: f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(tuple(one(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert shown(got.select(columns).collect()) == shown(expected)


def test_radius_join_is_exhaustive(spark):
    pts = [(i, -25 + (i * 7919 % 1000) / 20000, -57 + (i * 104729 % 1000) / 20000) for i in range(300)]
    df = spark.createDataFrame(pts, "id int, lat double, lng double")
    for side in ("left", "right"):
        got = spatial.radius_join(df, df.selectExpr("id r", "lat r_lat", "lng r_lng"), 700.0, explode=side)
        assert {(r.id, r.r) for r in got.collect()} == {(a[0], b[0]) for a in pts for b in pts if distance(*a[1:], *b[1:]) <= 700}


def test_greedy_proximity_chain(spark):
    step = 40 / geo.DEGREE_M  # 40 m apart: A absorbs B, C is a seed of its own
    rows = [(1, "a", -25.0, -57.0), (2, "longer", -25.0 + step, -57.0), (3, "c", -25.0 + 2 * step, -57.0)]
    df = spark.createDataFrame(rows, "id int, name string, lat double, lng double")
    assert {(r.id, r.seed) for r in dedup.proximity_clusters(df, 50.0).collect()} == {(1, 1), (2, 1), (3, 3)}
    assert {r.name for r in dedup.dedup_proximity(df, 50.0).collect()} == {"longer", "c"}


def test_greedy_proximity_equals_the_loop(spark):
    pts = [(i, -25 + (i * 7919 % 997) / 9000, -57 + (i * 104729 % 991) / 9000) for i in range(250)]
    seeds, own = [], {}
    for i, a, o in pts:
        near = [s for s in seeds if distance(a, o, *pts[s][1:]) < 900]
        own[i] = near[0] if near else i
        seeds += [] if near else [i]
    got = dedup.proximity_clusters(spark.createDataFrame(pts, "id int, lat double, lng double"), 900.0)
    assert {r.id: r.seed for r in got.collect()} == own


def test_knn_grows_its_radius(spark):
    pts = [(i, -25 + (i * 7919 % 1000) / 500, -57 + (i * 104729 % 1000) / 500) for i in range(80)]
    q = spark.createDataFrame(pts[:20], "id int, lat double, lng double")
    p = spark.createDataFrame(pts, "p int, r_lat double, r_lng double")
    got = spatial.knn_join(q, p, 3, 500.0, "id", "p", skip_self=True)
    expected = {(a[0], b, k + 1) for a in pts[:20] for k, (_, b) in enumerate(sorted((distance(*a[1:], *b[1:]), b[0]) for b in pts if b[0] != a[0])[:3])}
    assert {(r.id, r.p, r["rank"]) for r in got.collect()} == expected


def test_text_goldens(spark):
    one = lambda f, *v: spark.createDataFrame([v], ", ".join(f"c{k} string" for k in range(len(v)))).select(f(*(F.col(f"c{k}") for k in range(len(v)))).alias("x")).first().x
    assert one(text.clean_name, '  "Foo  Bar" ') == "Foo Bar"
    assert one(text.norm, "  Ñandú   ÁREA ") == "nandu area" and one(text.norm, "   ") is None
    assert one(text.norm_alnum, "Café 24!") == "caf24"
    assert tuple(one(text.coordinates, "x/@-25.1,-57.2,17z!3d1.5!4d2.5")) == (-25.1, -57.2) and tuple(one(text.coordinates, "x!3d-25.1!4d-57.2")) == (-25.1, -57.2) and tuple(one(text.coordinates, "none")) == (None, None)
    assert one(text.place_id, "a/b/data=xyz") == "xyz" and one(text.place_id, "https://h/p/tail/") == "tail" and one(text.place_id, "https://h/@1,2") is None
    parts = (("rest", "Food"), ("bar", "Drinks"))
    assert one(lambda c: text.category_by_part(c, parts), "Restobar") == "Food" and one(lambda c: text.category_by_part(c, parts), None) == "sin categoria" and one(lambda c: text.category_by_part(c, parts), " ") == "Sin categoria"
    assert one(text.distinct_join, "a", " ", "b", "a") == "a, b"


def test_zoom_thresholds_are_strict(spark):
    areas = [(500.0, 12), (500.1, 10), (100.0, 14), (25.0, 15), (5.0, 16), (1.0, 17), (0.25, 18), (0.06, 19), (0.015, 20)]
    got = spark.createDataFrame(areas, "a double, z int").select("z", geo.zoom_level("a").alias("got")).collect()
    assert all(r.z == r.got for r in got)


def test_listing_goldens(spark):
    rows = [(i, 1.0, 2.0, 100.0, "usd", 50.0) for i in range(10)] + [(20 + i, 3.0, 4.0, 7300.0, "PYG", 50.0) for i in range(9)] + [(40, 0.0, 0.0, 5.0, "EUR", 50.0), (41, 5.0, 6.0, 0.0, "USD", 50.0), (42, 5.0, 6.0, 9.0, "EUR", 29.9), (43, 5.0, 6.0, 9.0, "EUR", 30.0)]
    df = spark.createDataFrame(rows, "id int, lat double, lng double, precio double, moneda string, superficie_m2 double")
    assert {r.id for r in listings.clean_listings(df).collect()} == {*range(20, 29), 43}
    rates = spark.createDataFrame([("2024-01-01", 7000.0), ("2024-01-02", 7300.0)], "fecha string, pyg_por_usd double")
    usd = {r.id: r.precio_usd for r in listings.dollarize(df, rates).collect()}
    assert usd[0] == 100.0 and usd[20] == 1.0 and usd[40] is None and usd[41] is None
    kept = listings.trim_outliers(spark.range(1, 102).selectExpr("cast(id as double) v"), "v")
    assert kept.agg(F.min("v"), F.max("v")).first() == (2.0, 100.0)


def test_merge_goldens(spark):
    schema = "id int, name string, lat double, lng double, category string, google_place_id string, source_url string"
    near, far = -25 + 100 / geo.DEGREE_M, -25 + 101 / geo.DEGREE_M
    stored = spark.createDataFrame([(1, "A", -25.0, -57.0, "x", "p1", None), (2, "B", -25.0, -57.0, "y", None, "u2"), (3, "C", -25.0, -57.0, "z", None, None)], schema)
    incoming = spark.createDataFrame([(1, "other", 10.0, 10.0, None, "p1", "u9"), (2, "B2", 11.0, 11.0, "q", None, "u2"), (3, "c", near - 1e-9, -57.0, "w", "p3", None), (4, "c", far, -57.0, "n", None, None)], schema.replace("id int", "seq int"))
    got = {r.id: r for r in merge.upsert(stored, incoming).collect()}
    assert (got[1].name, got[1].category, got[1].source_url, got[1].google_place_id) == ("A", None, "u9", "p1")
    assert got[2].category == "q" and got[3].google_place_id == "p3" and got[4].name == "c" and len(got) == 4
    by_name = merge.match_tiers(stored, incoming, metres=None)
    assert {(r.seq, r.id) for r in by_name.collect()} == {(1, 1), (2, 2), (3, 3), (4, 3)}


def test_polygons(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    rings = spark.createDataFrame([("r", [{"x": x, "y": y} for x, y in ring])], "p string, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 1.0)], "id int, lat double, lng double")
    assert [tuple(r) for r in spatial.point_in_polygon(points, rings, "id", "p").collect()] == [(1, "r")]
    boxes = spark.createDataFrame([(1, -1.0, 1.0, -1.0, 1.0), (2, 1.0, 2.0, 1.0, 2.0), (3, 5.0, 6.0, 5.0, 6.0), (4, 1.0, 2.0, -1.0, 5.0)], "b int, lat_min double, lat_max double, lng_min double, lng_max double")
    assert {r.b for r in spatial.box_meets_polygon(boxes, rings, "b", "p").collect()} == {1, 2, 4}


def test_overflow_splits_to_the_depth_and_keeps_all_points(spark):
    cells = spark.createDataFrame([(0.0, 8.0, 0.0, 8.0)], "lat_min double, lat_max double, lng_min double, lng_max double")
    points = spark.createDataFrame([(0.1, 0.1)] * 5 + [(7.0, 7.0)], "lat double, lng double")
    got = grid.split_overflow(cells, points, 2, cap=5).collect()
    assert sum(r.n for r in got) == 6 and max(r.depth for r in got) == 2 and len(got) == 7


def test_sources(spark, tmp_path):
    page = 'x var list = [{"a": "]", "b": [1, 2]}, {"a": "q\\"]"}]; y'
    df = spark.createDataFrame([(1, page), (2, None), (3, "none")], "id int, html string")
    got = {r.id: r.x for r in df.select("id", pages.script_array(F.col("html"), "list =", "a string").alias("x")).collect()}
    assert [r.a for r in got[1]] == ["]", 'q"]'] and got[2] is None and got[3] is None
    wiki = spark.createDataFrame([("| [[A (x)|Asunción (city)]]\n| colspan [[B]]\n| [[asunción]]\n| [[C]]",)], "text string")
    assert [r.name for r in pages.wiki_districts(wiki).orderBy("pos").collect()] == ["Asunción", "C"]
    (tmp_path / "p.csv").write_text("longitude,latitude,pop\n-57.1,-25.1,3.5\n-57.2,-25.2,0\n")
    assert [tuple(r) for r in tables.population_csv(spark, f"{tmp_path}/p.csv").collect()] == [(3.5, -25.1, -57.1)]
    tables.publish(spark.range(3), f"{tmp_path}/t")
    assert tables.union_existing(spark, [f"{tmp_path}/t", f"{tmp_path}/none"]).count() == 3


def test_normalize(spark):
    raw = spark.createDataFrame([("A", "1.5", "2.5", "autoshop", "u"), (" ", "1", "2", "c", "u"), ("B", None, "2", None, "x/@-25.5,-57.5,17z"), ("C", "x", "y", "c", "none")], "name string, lat string, lng string, category string, source_url string")
    got = {r.name: (r.lat, r.lng, r.category) for r in normalize.normalize(raw).collect()}
    assert got == {"A": (1.5, 2.5, "autoshop"), "B": (-25.5, -57.5, "sin categoria")}


def test_gap_order(spark):
    stored = spark.createDataFrame([("Cafe Uno", -25.0, -57.0)], "name string, lat double, lng double")
    m = 1 / geo.DEGREE_M
    report = spark.createDataFrame([(1, "Other", -25.0 + 20 * m, -57.0), (2, "cafe uno!", -25.0 + 60 * m, -57.0), (3, "CAFE UNO", -20.0, -50.0), (4, "Nope", -25.0 + 60 * m, -57.0)], "id int, name string, lat double, lng double")
    assert {r.id: r.found for r in gap.classify_gap(report, stored).collect()} == {1: "near", 2: "near_name", 3: "name", 4: "missing"}


def test_curation_tiers(spark):
    maps = spark.createDataFrame([("cafe", "t", "food"), ("hardware store", "t", "tools"), ("store", "t", "shops"), ("store of the very long name", "t", "long")], "raw_norm string, type string, category string")
    rows = spark.createDataFrame(
        [(1, "X", "Café Abierto 24 horas", "z"), (2, "X", "Bar 4.5 Café", "store"), (3, "X", None, "Cafe"), (4, "My Hardware Store", None, "z"), (5, "Restored", None, None), (6, "x no hay opiniones", "y No hay opiniones Store cerrado", "cafe"), (7, "A Störe of the very long name!", "4.5 none", "z"), (8, "X", "Abierto Cafe", "z")],
        "id int, name string, category string, search_category string",
    )
    got = {r.id: (r.raw_category, r.business_category, r.category_source, r.category_confidence) for r in curate.curate(rows, maps).collect()}
    assert got == {
        1: (None, "food", "categoria_original", 0.85), 2: ("Café", "food", "google_categoria", 0.9), 3: (None, "food", "search_category", 0.6), 4: (None, "tools", "nombre", 0.5), 5: (None, None, None, None), 6: ("Store cerrado", "shops", "google_categoria", 0.9),
        7: ("none", "long", "nombre", 0.5), 8: (None, None, None, None),
    }


def test_price_model(spark):
    rows = spark.range(300).selectExpr("id", "cast(id % 17 as double) a", "if(id % 11 = 0, null, cast(id % 5 as double)) b", "100 + 10 * (id % 17) as price", "cast(id % 3 as int) fold")
    fitted = model.train_price_model(rows, "price", ("a", "b"), trees=10)
    assert model.predict_price(fitted, rows, ("a", "b")).where("predicted >= 0").count() == 300
    got = model.cross_validate(rows, "price", ("a", "b"), folds=3, trees=10).first()
    assert got.r2 > 0.8
    assert model.permutation_importance(fitted, rows, "price", ("a", "b"))[0][0] == "a"


def test_greedy_proximity_anywhere_and_dense(spark):
    r = random.Random(12)
    spots = [(0, 0), (70, 10), (-70, 179.999), (89.999, 0), (-89.9995, 90), (10, 180), (45, 179.9995)]
    pts = [(k, max(-90.0, min(90.0, y + r.uniform(-0.01, 0.01))), (x + r.uniform(-0.01, 0.01) + 180) % 360 - 180) for k, (y, x) in enumerate(spots * 25)]
    pts += [(1000 + k, 5.0, 5.0 + 1e-7 * k) for k in range(300)]  # one dense spot
    r.shuffle(pts)
    seeds, own = [], {}
    for i, a, o in sorted(pts):
        near = [s for s, b, p in seeds if distance(a, o, b, p) < 400]
        own[i] = near[0] if near else i
        seeds += [] if near else [(i, a, o)]
    df = spark.createDataFrame([*pts, (5000, None, 1.0)], "id int, lat double, lng double")
    assert {x.id: x.seed for x in dedup.proximity_clusters(df, 400.0).collect()} == {**own, 5000: 5000}
    assert dedup.proximity_clusters(df.limit(0), 400.0).count() == 0


def test_deduplicate_by_name_then_place(spark):
    step = 40 / geo.DEGREE_M
    rows = [(1, "Bar", -25.0, -57.0), (2, " bar ", 10.0, 10.0), (3, "Longer bar", -25.0 + step, -57.0), (4, "c", 30.0, 30.0)]
    df = spark.createDataFrame(rows, "id int, name string, lat double, lng double")
    assert sorted(x.id for x in dedup.deduplicate(df).collect()) == [2, 3, 4]


def test_script_arrays_are_read_by_few_pages_at_once(spark):
    """Whole pages don't reach Python in Arrow batches, which count rows and not bytes."""
    df = spark.createDataFrame([(1, 'list = ["a", "]"];'), (2, None)], "id int, html string")
    got = df.select("id", pages.script_array(F.col("html"), "list =", "a string").alias("x"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_records_of_repeated_ids_and_pages_come_once(spark):
    """First records are settled by their places: repeated within a page, on later pages and on a page that stands twice."""
    from plumbline.sources import portals

    html = lambda *ids: "propiedades: [" + ",".join('{"id": "%s"}' % i for i in ids) + "]"
    rows = [(0, 1, html("a", "b", "a")), (0, 2, html("b", "c")), (0, 3, html("c")), (1, 1, html("c", "d")), (1, 1, html("c", "d"))]
    got = portals.segment_records(spark.createDataFrame(rows, "segment int, page int, html string"))
    assert sorted(r.id_externo for r in got.collect()) == ["a", "b", "c", "d"]
