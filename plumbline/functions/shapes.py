"""Geometries as columns: struct(type, rings), where ``rings`` is an array of paths, each an array of struct(x, y).

A Point has one path of one place, a LineString one path, a Polygon its outer ring and its holes, a MultiPolygon the rings of all its polygons; the
even-odd rule over all rings tells what is inside.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How deep the coordinates of each type are nested.
DEPTHS = {"Point": 1, "LineString": 2, "MultiPoint": 2, "Polygon": 3, "MultiLineString": 3, "MultiPolygon": 4}


def _places(path: Column) -> Column:
    return F.transform(path, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))


def shape_of_geojson(text: Column) -> Column:
    """The geometry of a GeoJSON text; null if it is none. Heights are dropped."""
    j = F.from_json(text, "type string, coordinates string")
    kind = j["type"]
    nested = lambda depth: F.from_json(j["coordinates"], "array<" * depth + "double" + ">" * depth)
    places = lambda paths: F.transform(paths, _places)
    rings = (
        F.when(kind == "Point", F.array(_places(F.array(nested(1)))))
        .when(kind == "LineString", F.array(_places(nested(2))))
        .when(kind == "MultiPoint", F.transform(nested(2), lambda p: _places(F.array(p))))
        .when(kind.isin("Polygon", "MultiLineString"), places(nested(3)))
        .when(kind == "MultiPolygon", places(F.flatten(nested(4))))
    )
    return F.when(rings.isNotNull(), F.struct(kind.alias("type"), rings.alias("rings")))


def geojson_of_shape(kind: Column, rings: Column) -> Column:
    """The GeoJSON text of a Point, LineString, Polygon (first ring outside, others holes) or MultiPolygon (each ring a polygon; those within others as holes of the ring before)."""
    pairs = F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    text = lambda coordinates: F.to_json(F.struct(kind.alias("type"), coordinates.alias("coordinates")))
    return F.when(kind == "Point", text(pairs[0][0])).when(kind == "LineString", text(pairs[0])).when(kind == "MultiPolygon", text(F.transform(pairs, lambda r: F.array(r)))).otherwise(text(pairs))


def bounds(rings: Column) -> Column:
    """struct(x0, y0, x1, y1) around all paths."""
    axis = lambda f: F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p[f])))
    return F.struct(F.array_min(axis("x")).alias("x0"), F.array_min(axis("y")).alias("y0"), F.array_max(axis("x")).alias("x1"), F.array_max(axis("y")).alias("y1"))


def area(rings: Column) -> Column:
    """Area in squared degrees of a polygon or multipolygon: rings add up, those at an odd depth within others are holes and count off."""

    def own(ring: Column) -> Column:
        twice = F.aggregate(F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]), F.lit(0.0), lambda a, v: a + v)
        return F.abs(twice) / 2

    def holds(ring: Column, p: Column) -> Column:
        ends = F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), lambda a, b: F.struct(a["x"].alias("x"), a["y"].alias("y"), (b["x"] - a["x"]).alias("dx"), (b["y"] - a["y"]).alias("dy")))
        crossed = F.filter(ends, lambda e: (e["dy"] != 0) & ((e["y"] > p["y"]) != (e["y"] + e["dy"] > p["y"])) & (p["x"] < e["dx"] * (p["y"] - e["y"]) / e["dy"] + e["x"]))
        return F.size(crossed) % 2 == 1

    signed = F.transform(rings, lambda ring, k: own(ring) * F.when(F.size(F.filter(rings, lambda other, j: (j != k) & holds(other, ring[0]))) % 2 == 1, -1.0).otherwise(1.0))
    return F.aggregate(signed, F.lit(0.0), lambda a, v: a + v)
