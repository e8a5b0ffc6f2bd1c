"""Map layers out of decoded nodes, ways and relations.

nodes: id, lon, lat, tags (map); ways: id, tags, nodes (array of ids); relations: id, tags, members (array of struct(type, role, ref)).
Layers are tables (kind of element, id, name, the layer's tags, type and ``path``: an array of struct(x, y)), where type is
Point, LineString or Polygon; a missing tag is an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checkpoints import cut
from .tables import publish

#: Tag values that put an element into a layer (fixed values).
HIGHWAY = ("motorway", "trunk", "primary", "secondary", "tertiary")
AMENITY = ("hospital", "university", "bus_station", "police", "marketplace")
LEISURE = ("park", "garden", "pitch", "playground")
LANDUSE = ("recreation_ground",)
NATURAL = ("water",)
WATERWAY = ("river", "riverbank")
ADMIN_LEVELS = ("8", "9")
PLACE = ("suburb", "neighbourhood", "city", "town")

#: Degrees within which the ends of a ring are one point.
CLOSE = 1e-9


def tag(name: str) -> Column:
    return F.coalesce(F.col("tags")[name], F.lit(""))


def closed(path: Column) -> Column:
    a, b = F.element_at(path, 1), F.element_at(path, -1)
    return (F.size(path) >= 3) & (F.abs(a["x"] - b["x"]) < CLOSE) & (F.abs(a["y"] - b["y"]) < CLOSE)


def way_paths(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ways that have a layer's tag, with ``path`` and ``whole`` (all nodes are known); a path ends at its first unknown node."""
    wanted = tag("highway").isin(*HIGHWAY) | tag("amenity").isin(*AMENITY) | tag("leisure").isin(*LEISURE) | tag("landuse").isin(*LANDUSE) | tag("natural").isin(*NATURAL) | tag("waterway").isin(*WATERWAY) | tag("place").isin(*PLACE) | tag("admin_level").isin(*ADMIN_LEVELS)
    some = ways.where(wanted)
    at = nodes.select(F.col("id").alias("node"), F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")).alias("p"))
    stops = some.select("id", F.posexplode("nodes").alias("pos", "node")).join(at, "node", "left")
    paths = stops.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "p"))).alias("s"), F.min(F.when(F.col("p").isNull(), F.col("pos"))).alias("lost"))
    found = F.filter("s", lambda x: F.col("lost").isNull() | (x["pos"] < F.col("lost")))
    paths = paths.select("id", F.transform(found, lambda x: x["p"]).alias("path"), F.col("lost").isNull().alias("whole"))
    return some.join(paths, "id").where(F.size("path") > 0)


def _polygon(path: Column) -> Column:
    return F.when(closed(path), path).otherwise(F.concat(path, F.slice(path, 1, 1)))


def relation_ring(relations: DataFrame, paths: DataFrame) -> DataFrame:
    """(id, ring): the paths of a relation's outer ways one after another in the order of its members, closed; none for relations without any."""
    kept = paths.where(tag("admin_level").isin(*ADMIN_LEVELS) | tag("place").isin(*PLACE) | tag("leisure").isin(*LEISURE) | tag("natural").isin(*NATURAL) | tag("waterway").isin(*WATERWAY))
    # A way on the road layer belongs to no other.
    kept = kept.where(~tag("highway").isin(*HIGHWAY)).select(F.col("id").alias("ref"), "path")
    members = relations.select("id", F.posexplode("members").alias("pos", "m")).where((F.col("m.type") == "w") & (F.col("m.role") == "outer")).select("id", "pos", F.col("m.ref").alias("ref"))
    outer = members.join(kept, "ref").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "path"))).alias("s"))
    ring = F.flatten(F.transform("s", lambda x: x["path"]))
    return outer.select("id", _polygon(ring).alias("ring"))


def layers(nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> dict[str, DataFrame]:
    """The five layers: vias, parques, agua, equipamiento, limites. The ways' paths, which all of them need, are assembled once and kept."""
    paths = cut(way_paths(ways, nodes))
    point = lambda df, x, y: df.withColumn("type", F.lit("Point")).withColumn("path", F.array(F.struct(x.alias("x"), y.alias("y"))))
    rings = cut(relations.join(relation_ring(relations, paths), "id")).withColumnRenamed("ring", "path").withColumn("type", F.lit("Polygon"))
    out = lambda df, element, tags: df.select(F.lit(element).alias("element"), "id", tag("name").alias("name"), *(t.alias(n) for n, t in tags.items()), "type", "path")
    road = tag("highway").isin(*HIGHWAY)
    vias = out(paths.where(road & F.col("whole") & (F.size("path") > 1)).withColumn("type", F.lit("LineString")), "way", {"highway": tag("highway")})
    other = paths.where(~road)
    mean = lambda c: F.aggregate(F.transform("path", lambda p: p[c]), F.lit(0.0), lambda a, v: a + v) / F.size("path")
    amenity = {"amenity": tag("amenity")}
    centres = point(other.where(tag("amenity").isin(*AMENITY)).withColumn("_x", mean("x")).withColumn("_y", mean("y")).drop("path"), F.col("_x"), F.col("_y"))
    equipment = out(point(nodes.where(tag("amenity").isin(*AMENITY)), F.col("lon"), F.col("lat")), "node", amenity).unionByName(out(centres, "way", amenity))
    # A polygon needs three points; a path that isn't closed is closed then.
    area = other.where((F.col("whole") & closed(F.col("path"))) | (F.size("path") >= 3)).withColumn("path", _polygon(F.col("path"))).withColumn("type", F.lit("Polygon"))
    leisure = {"leisure": F.when(tag("leisure") != "", tag("leisure")).otherwise("recreation_ground")}
    parks = out(area.where(tag("leisure").isin(*LEISURE) | tag("landuse").isin(*LANDUSE)), "way", leisure).unionByName(out(rings.where(tag("leisure").isin(*LEISURE)), "relation", leisure))
    wet, water_tags = tag("natural").isin(*NATURAL) | tag("waterway").isin(*WATERWAY), {"natural": tag("natural"), "waterway": tag("waterway")}
    shores = other.where(wet & F.col("whole") & (F.size("path") > 1)).withColumn("type", F.when(closed(F.col("path")), "Polygon").otherwise("LineString"))
    water = out(shores, "way", water_tags).unionByName(out(rings.where(wet), "relation", water_tags))
    bound = {"admin_level": tag("admin_level"), "place": tag("place")}
    limits = out(point(nodes.where(tag("place").isin(*PLACE)), F.col("lon"), F.col("lat")), "node", bound)
    limits = limits.unionByName(out(area.where(tag("place").isin(*PLACE) & closed(F.col("path"))), "way", bound)).unionByName(out(rings.where(tag("admin_level").isin(*ADMIN_LEVELS) | tag("place").isin(*PLACE)), "relation", bound))
    return {"vias": vias, "parques": parks, "agua": water, "equipamiento": equipment, "limites": limits}


#: What all layers' tables have, and the tags that only some have.
SHAPE, TAGS = ("element", "id", "name", "type", "path"), ("highway", "leisure", "natural", "waterway", "amenity", "admin_level", "place")


def save_layers(some: dict[str, DataFrame], path: str) -> None:
    """Keeps the layers as one table, a folder for each, which replaces the one before; later runs read it and assemble nothing."""
    every = None
    for name, layer in some.items():
        part = layer.select(*SHAPE, *(F.col(t) if t in layer.columns else F.lit(None).cast("string").alias(t) for t in TAGS), F.lit(name).alias("layer"))
        every = part if every is None else every.unionByName(part)
    publish(every, path, "layer")


def load_layers(spark: SparkSession, path: str, names: tuple[str, ...] = ("vias", "parques", "agua", "equipamiento", "limites")) -> dict[str, DataFrame]:
    """The kept layers; only the folders of those that are used are read."""
    kept = spark.read.parquet(path)
    return {name: kept.where(F.col("layer") == name).drop("layer") for name in names}


def geojson(kind: Column, path: Column) -> Column:
    """The geometry as GeoJSON text."""
    pairs = F.transform(path, lambda p: F.array(p["x"], p["y"]))
    shape = lambda coordinates: F.to_json(F.struct(kind.alias("type"), coordinates.alias("coordinates")))
    return F.when(kind == "Point", shape(F.get(pairs, 0))).when(kind == "Polygon", shape(F.array(pairs))).otherwise(shape(pairs))
