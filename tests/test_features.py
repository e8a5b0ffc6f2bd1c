"""Folds, features, models, boundaries, tasks and stored tables on small inputs."""

import json
import math
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from plumbline.functions import geo, shapes, text
from plumbline.operators import curate, listings, merge, order
from plumbline.plans import features, grid, model, radius
from plumbline.sources import cards, tables


def test_balanced_folds(spark):
    r = random.Random(1)
    rows = [(f"b{k}",) for k in range(40) for _ in range(r.randrange(1, 60))]
    got = {x.block: (x.n, x.fold) for x in model.balanced_folds(spark.createDataFrame(rows, "block string"), 4).collect()}
    sizes = sorted({b: sum(x == (b,) for x in rows) for (b,) in rows}.items(), key=lambda x: (-x[1], x[0]))
    load, expected = [0] * 4, {}
    for block, n in sizes:
        fold = load.index(min(load))
        load[fold] += n
        expected[block] = (n, fold)
    assert got == expected and max(load) - min(load) < 10
    assert model.balanced_folds(spark.createDataFrame([], "block string")).count() == 0


@pytest.fixture(scope="module")
def market(spark):
    """Listings, cells with people, businesses and features of cells around one place."""
    r = random.Random(3)
    spot = lambda: (-25 + r.uniform(0, 0.2), -57 + r.uniform(0, 0.2))
    rows = [(k, *spot(), r.uniform(1000, 9000), float(r.randrange(30, 500)), r.choice(["comercial", "habitacional", None])) for k in range(300)]
    rows += [(1000 + k, -25.0, -57.0, 5000.0, 100.0, None) for k in range(12)] + [(2000, -25.1, -57.1, None, 100.0, None), (2001, -25.1, -57.1, 5000.0, 10.0, None)]  # an office, no price, too small
    some = spark.createDataFrame(rows, "id int, lat double, lng double, precio_usd double, superficie_m2 double, uso string").withColumn("precio", F.coalesce("precio_usd", F.lit(1.0)))
    cells = spark.createDataFrame([(k, *spot(), 10.0) for k in range(500)], "id int, lat double, lng double, population double")
    business = spark.createDataFrame([(k, *spot(), k % 5 > 0) for k in range(300)], "id int, lat double, lng double, is_active boolean")
    reps = features.cell_representatives(cells)
    layers = {n: spark.createDataFrame([(k, "Point", [dict(zip("yx", spot()))]) for k in range(20)], "id int, type string, path array<struct<x:double,y:double>>") for n in ("dist_via_principal_m", "dist_parque_m", "dist_agua_m", "dist_hospital_m", "dist_universidad_m")}
    return model.model_features(features.listing_features(some, cells, business, features.cell_features(reps, layers), (-25.0, -57.0))).persist()


def test_listing_features(market):
    rows = market.collect()
    assert set(model.FEATURES) <= set(market.columns) and 285 <= len(rows) <= 298 and all(x.id < 1000 for x in rows)
    for x in rows:
        assert x.log_superficie == pytest.approx(math.log1p(x.superficie_m2)) and x.uso_comercial == {"comercial": 1.0, "habitacional": 0.0}.get(x.uso)
        assert x.pop_500m <= x.pop_1km <= x.pop_2km and x.biz_500m <= x.biz_1km <= x.biz_2km and x.dist_asuncion_km >= 0


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_models_on_all_features(market, kind):
    rows = model.with_folds(market, 3)
    assert {x.fold for x in rows.select("fold").distinct().collect()} <= {0, 1, 2}
    every = (*model.FEATURES, *model.NEIGHBOUR_FEATURES)
    full = model.with_neighbours(rows, rows, "usd_m2", 2000.0, skip_self=True)
    fitted = model.train_price_model(full, "usd_m2", every, kind=kind, trees=8)
    seen = model.predict_price(fitted, full, every).select(F.col("usd_m2").alias("y"), F.col("predicted").alias("p"))
    assert seen.where("p < 0").count() == 0 and model.regression_metrics(seen).first().mae < model.baseline(rows, "usd_m2").first().mae
    importance = model.permutation_importance(fitted, full, "usd_m2", every, repeats=1, columns=("log_superficie", "cerca_agua")) if kind == "forest" else []
    assert [c for c, _ in importance][:1] in ([], ["log_superficie"])


def test_scalars(spark):
    one = spark.createDataFrame([(-25.0, "Ñandú  ", "ñandu")], "lat double, a string, b string")
    got = one.select(geo.km_to_degrees_lat(111.32).alias("y"), geo.km_to_degrees_lng(111.32, "lat").alias("x"), geo.box_area_km2(F.lit(0.0), F.lit(0.01), F.lit(5.0), F.lit(5.02)).alias("area"), text.same_name(F.col("a"), F.col("b")).alias("same"), text.same_name(F.col("a"), F.lit("")).alias("none")).first()
    assert got.y == pytest.approx(1) and got.x == pytest.approx(1 / math.cos(math.radians(25))) and got.area == pytest.approx(0.01 * 0.02 * 111.32**2, rel=1e-6) and got.same and not got.none
    url = one.select(text.maps_url(F.lit(-25.1), F.lit(-57.2), F.lit(15), F.lit("bar & café")).alias("u")).first().u
    assert url == "https://www.google.com/maps/search/bar%20%26%20caf%C3%A9/@-25.100000,-57.200000,15z"


def test_cells_of_points(spark):
    box = (-25.5, -25.0, -57.5, -57.0)
    cells = {(c.row, c.col): c for c in grid.grid_cells(spark, *box, 7.0).collect()}
    r = random.Random(4)
    points = [(k, r.uniform(-25.6, -24.9), r.uniform(-57.6, -56.9)) for k in range(300)] + [(900, -25.0, -57.0), (901, -25.5, -57.5)]
    got = spark.createDataFrame(points, "id int, lat double, lng double").withColumn("c", grid.cell_of_point(F.col("lat"), F.col("lng"), *box, 7.0)).collect()
    for x in got:
        inside = box[0] <= x.lat <= box[1] and box[2] <= x.lng <= box[3]
        assert (x.c is not None) == inside
        if inside:
            c = cells[x.c.row, x.c.col]
            assert c.lat_min <= x.lat <= c.lat_max and c.lng_min <= x.lng <= c.lng_max and x.c.lat_max == pytest.approx(c.lat_max) and x.c.lng_min == pytest.approx(c.lng_min)


def test_tasks_in_order(spark):
    cells = spark.createDataFrame([(2.0, 0.0, 1.0, 0.0, 1.0), (1.0, 5.0, 6.0, 0.0, 1.0)], "priority double, lat_min double, lat_max double, lng_min double, lng_max double")
    got = order.numbered(grid.tasks(cells, ["b", "a"]), ["priority", "lat_min", "lng_min", "category_pos"])
    assert [(x.priority, x.category) for x in sorted(got.collect(), key=lambda x: x._i)] == [(1.0, "b"), (1.0, "a"), (2.0, "b"), (2.0, "a")]
    states = spark.createDataFrame([("c2", "x", "completed"), ("c1", "y", "completed"), ("c1", "y", "completed"), ("c0", "z", "failed")], "cell string, category string, status string")
    assert [tuple(x) for x in grid.finished_tasks(states).collect()] == [("c1", "y"), ("c2", "x")] and grid.finished_tasks(states, 1).count() == 1
    near = {(x.row, x.col) for x in grid.circle_grid(spark, -25.0, -57.0, 10.0, 3.0).collect()}
    many = grid.circle_grids(spark.createDataFrame([(7, -25.0, -57.0), (8, 10.0, 0.0)], "id int, lat double, lng double"), 10.0, 3.0).collect()
    assert {(x.row, x.col) for x in many if x.id == 7} == near and len({x.id for x in many}) == 2


def test_largest_polygon_of_a_name(spark):
    ring = lambda s, o=0.0: [{"x": x * s + o, "y": y * s + o} for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))]
    rows = [(1, "Areguá", "8", "Polygon", [ring(2.0)]), (2, "AREGUA", "9", "Polygon", [ring(3.0), ring(2.9, 0.05)]), (3, "aregua", "8", "Point", [ring(9.0)[:1]]), (4, "Luque", "8", "MultiPolygon", [ring(1.0)]), (5, None, "8", "Polygon", [ring(9.0)])]
    some = spark.createDataFrame(rows, "id int, name string, admin_level string, type string, rings array<array<struct<x:double,y:double>>>")
    assert {x.id: round(x.area, 6) for x in radius.largest_named(some).collect()} == {1: 4.0, 4: 1.0}
    assert [x.id for x in radius.largest_named(some, "areguá", "9").collect()] == [2] and radius.largest_named(some, "none").count() == 0
    assert some.where("id = 2").select(shapes.area(F.col("rings")).alias("a")).first().a == pytest.approx(9 - 2.9**2)


def test_flush_ignores_conflicts_and_counts(spark):
    schema = "id long, name string, lat double, lng double, category string, search_category string, google_place_id string, source_url string, is_active boolean"
    rows = [(1, "n1", 0.0, 0.0, "bar", "bar", "p1", "u1", True), (2, "n2", 0.0, 0.0, "bar", "bar", "p1", "u2", True), (3, "n3", 0.0, 0.0, "bar", "bar", "p3", "u2", True), (4, "n4", 0.0, 0.0, "??", "??", "p9", "u9", True), (5, "n5", 0.0, 0.0, "Sin categoria", "bar", "p5", "u5", True), (6, "n6", 0.0, 0.0, "bar", "bar", "p6", "u6", False), (7, "n1", 0.0, 0.0, "zz", "bar", None, None, True)]
    stored = spark.createDataFrame([(10, "old", "p9", None, None)], "id long, name string, google_place_id string, source_url string, business_category string").withColumn("lat", F.lit(0.0)).withColumn("lng", F.lit(0.0))
    counters = Observation()
    table, sources = merge.flush(spark.createDataFrame(rows, schema), spark.createDataFrame([("bar", "t", "food")], "raw_norm string, type string, category string"), stored, counters=counters)
    # 2 conflicts by place id with 1; so 3 is free to take u2; 4 conflicts with the stored row; 7 has no keys
    assert sorted((x.id, x.name, x.google_place_id, x.source_url, x.business_category) for x in table.collect()) == [(10, "old", "p9", None, None), (11, "n1", "p1", "u1", "food"), (12, "n3", "p3", "u2", "food"), (13, "n1", None, None, "food")]
    assert counters.get == {"inserted": 3, "updated": 0}
    assert {x.category_source: x.n for x in sources.collect()} == {"categoria_original": 3, "search_category": 1, merge.UNCLASSIFIED: 1}


def test_stored_by_key(spark):
    stored = spark.createDataFrame([(1, "2020", "2020", "a"), (2, "2020", "2021", "b")], "k int, first string, last string, v string")
    incoming = spark.createDataFrame([(2, "2022", "2022", "c"), (3, "2022", "2022", "d")], "k int, first string, last string, v string")
    assert sorted(map(tuple, merge.keyed_upsert(stored, incoming, ["k"], "first", "last").collect())) == [(1, "2020", "2020", "a"), (2, "2020", "2022", "c"), (3, "2022", "2022", "d")]
    assert [x.k for x in merge.only_new(stored, incoming, ["k"]).collect()] == [3]
    assert sorted(map(tuple, merge.latest(stored.unionAll(incoming), ["k"], ["last"]).select("k", "v").collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_reports(spark, tmp_path):
    page = lambda *names: "<div role=feed>" + "".join(f'<div class="Nv2PK"><a class="hfpxzc" href="/maps/place/{n}" aria-label="{n}"></a><div>{k} · x</div></div>' for n, k in names) + "</div>"
    pages = spark.createDataFrame([(1, page(("a", "Bar"), ("b", "Hotel"))), (2, page(("c", "9")))], "page_id int, html string")
    got = {x.page_id: (x.overall, x.total_cards, x.unique_results) for x in cards.extraction_report(pages, cards.result_cards(pages)).collect()}
    assert got == {1: (False, 2, 2), 2: (False, 1, 1), None: (True, 3, 3)}
    (tmp_path / "d.json").write_text(json.dumps([{"name": "Luque", "lat": -25.2, "lng": -57.4}]))
    assert tables.districts_json(spark, f"{tmp_path}/d.json").first().name == "Luque"
    assert tables.records(spark.createDataFrame([(1, "a", 2.0)], "id int, name string, lat double")).columns == list(tables.RECORD)
    prices = listings.price_summary(spark.createDataFrame([("a", 10.0, "USD", "venta"), ("a", 30.0, "PYG", "venta"), ("a", None, "EUR", "x")], "fuente string, precio_usd double, moneda string, operacion string")).first()
    assert (prices.n, prices.n_usd, prices.mean, prices.mean_in_usd, prices.mean_of_sales) == (3, 2, 20.0, 10.0, 20.0)


def test_longest_keyword_of_a_name(spark):
    keys = spark.createDataFrame([("casa blanca",), ("blanca azul grande",), ("bar",), ("hotel",), ("motel",), ("l'hotel d'or",), (None,)], "key string")
    names = spark.createDataFrame([("casa blanca azul grande",), ("un hotel motel",), ("hotelito",), ("bar",), ("el l'hotel d'or.",), ("",), ("hotel-casa",)], "name string")
    assert {x.name: x.key for x in curate.keywords_of(names, keys).collect()} == {"casa blanca azul grande": "blanca azul grande", "un hotel motel": "hotel", "el l'hotel d'or.": "l'hotel d'or", "hotel-casa": "hotel"}
    assert curate.keywords_of(names, keys.limit(0)).count() == 0
