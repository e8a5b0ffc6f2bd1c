"""What the steps of listing_features write stays within bounds, and what they return is whole."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import nearest, spatial


def test_covered_polygons_are_written_for_few_cells(spark, monkeypatch):
    """Wide polygons over each other: where an earlier one covers a cell, later ones are not written for it."""
    r, written = random.Random(5), []
    ring = lambda x, y, w: [[{"x": x, "y": y}, {"x": x + w, "y": y + 0.1}, {"x": x + w, "y": y + w}, {"x": x, "y": y + w}]]
    rows = [("a", k, "Polygon", ring(r.uniform(0, 0.5), r.uniform(0, 0.5), r.uniform(1.0, 2.0))) for k in range(400)]
    shapes = spark.createDataFrame(rows, "layer string, id int, type string, rings array<array<struct<x:double,y:double>>>")
    places = [(k, r.uniform(-0.2, 2.5), r.uniform(-0.2, 2.5)) for k in range(300)]
    monkeypatch.setattr(spatial, "cut", lambda df, cut=spatial.cut: written.append((got := cut(df)).count()) or got)
    got = {x.k: x.id for x in spatial.first_polygons(spark.createDataFrame(places, "k int, lat double, lng double"), shapes, "k", "layer", "id").collect()}

    def inside(corners, x, y):
        ends = zip(corners, [*corners[1:], corners[0]])
        return sum((p["y"] > y) != (q["y"] > y) and x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"] for p, q in ends) % 2 == 1

    assert got == {k: first for k, y, x in places if (first := next((i for _, i, _, (corners,) in rows if inside(corners, x, y)), None)) is not None}
    assert max(written) <= 10 * len(rows), max(written)


@pytest.mark.parametrize("sphere", [False, True])
def test_crowded_edges_stand_in_few_leaves(spark, sphere):
    """Long edges across each other are written for a few leaves each, and all of them are compared."""
    r = random.Random(6)
    rows = [("a", k, "LineString", [{"x": r.uniform(0, 2), "y": r.uniform(0, 2)} for _ in range(2)]) for k in range(1200)]
    shapes = spark.createDataFrame(rows, "layer string, id int, type string, path array<struct<x:double,y:double>>")
    tree = nearest.Tree(shapes, "layer", "id")
    assert tree.placed().count() <= (2 * nearest.PIECES + 1) * tree.n
    points = [(k, r.uniform(0, 2), r.uniform(0, 2)) for k in range(60)]
    got = {x.k: (x.id, x.distance_m) for x in nearest.nearest_shapes(spark.createDataFrame(points, "k int, lat double, lng double"), shapes, "k", sphere=sphere).collect()}
    for k, y, x in points:

        def off(row):
            (p, q), s = row[3], math.cos(math.radians(y)) if sphere else 1.0
            dx, dy = (q["x"] - p["x"]) * s, q["y"] - p["y"]
            t = min(max(-((p["x"] - x) * s * dx + (p["y"] - y) * dy) / (dx * dx + dy * dy), 0.0), 1.0)
            fx, fy = p["x"] + t * (q["x"] - p["x"]), p["y"] + t * (q["y"] - p["y"])
            a = math.sin(math.radians(fy - y) / 2) ** 2 + math.cos(math.radians(y)) * math.cos(math.radians(fy)) * math.sin(math.radians(fx - x) / 2) ** 2
            return (a if sphere else (fx - x) ** 2 + (fy - y) ** 2), row[1], 2 * 6_371_000.0 * math.asin(math.sqrt(a))

        best = min(map(off, rows))
        assert got[k][0] == best[1] and got[k][1] == pytest.approx(best[2], abs=1e-6)


@pytest.mark.parametrize("spread", [0.002, 2.0])
def test_values_of_several_kinds_in_one_pass(spark, spread):
    """Thin and dense points, of which each has one of two values; a place's points may be repeated."""
    r = random.Random(7)
    spot = lambda: (-25 + r.uniform(0, spread), -57 + r.uniform(0, spread))
    rows = [(k, *spot(), float(k % 7), None) for k in range(900)] + [(k, *spot(), None, 1) for k in range(500)]
    rows += [(k, -25.0, -57.0, 3.0, None) for k in range(50)] + [(k, -25.0, -57.0, None, None) for k in range(5)]
    places = [(k, *spot()) for k in range(40)] + [(40, -25.0, -57.0), (41, None, -57.0)]
    people, one = F.col("people"), F.col("one")
    sums = {f"{name}_{m}": (value, float(m)) for name, value in (("p", people), ("b", one)) for m in (60, 150)}
    points = spark.createDataFrame(rows, "id int, r_lat double, r_lng double, people double, one long")
    got = spatial.radius_sums(spark.createDataFrame(places, "k int, lat double, lng double"), points, sums)
    assert dict(got.dtypes) | {} == {"k": "int", "lat": "double", "lng": "double", "p_60": "double", "p_150": "double", "b_60": "bigint", "b_150": "bigint"}

    def metres(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6_371_000.0 * math.asin(math.sqrt(h))

    near = lambda y, x, m, i: 0 if y is None else sum(row[i] or 0 for row in rows if metres(y, x, row[1], row[2]) <= m)
    assert {x.k: tuple(x)[3:] for x in got.collect()} == {k: tuple(near(y, x, m, i) for i in (3, 4) for m in (60, 150)) for k, y, x in places}
