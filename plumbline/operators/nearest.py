"""The nearest point, line or polygon of each layer, at any distance, by a tree of grid cells.

The shapes' edges, long ones in pieces, fall into square cells by their middles; a cell keeps the box around its edges and one place on them, and cells gather into
cells of four times the size up to a handful at the top. All points descend together, one join a step: a cell whose box is farther than
the least distance to such a place that a point has seen can't hold its nearest edge and is pruned, the others give way to the cells within.
So a point meets the few cells around its nearest shape, wherever that is, and no reach has to be guessed. In the last cells points and edges are compared by arrays,
which leave the nearest ones; these are measured exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import haversine_m
from .checkpoints import cut
from .lookup import MOST_ROWS, small
from .spatial import first_polygons, parts_of

#: Cells of 2 ** level degrees: the finest and the coarsest; a step of the descent; edges in a leaf, as an edge sees it on average.
FINEST, COARSEST, STEP, CROWD = -20, 10, 2, 256
#: Pieces that an edge is cut into, on average, at the first choice of a leaf; at most twice as many where cells are crowded, as each is written.
PIECES = 8
#: Points of a leaf that are compared with its edges in one task; points and edges of a task; pairs of them at a time.
LEAF_PLACES, TASK_ROWS, CHUNK = 50_000, 200_000, 32_000
#: Types that have an inside.
AREAS = ("Polygon", "MultiPolygon")


def edges_of(shapes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, px, py, qx, qy): a row for each edge; a path of one point is an edge without length."""
    path = F.col("_path")
    ends = F.when(F.size(path) == 1, F.array(F.struct(path[0].alias("p"), path[0].alias("q")))).otherwise(F.arrays_zip(F.slice(path, F.lit(1), F.size(path) - 1).alias("p"), F.slice(path, F.lit(2), F.size(path) - 1).alias("q")))
    each = shapes.select(*keys, F.explode(parts_of(shapes)).alias("_path")).where(F.size("_path") > 0).select(*keys, F.explode(ends).alias("e"))
    return each.select(*keys, F.col("e.p.x").alias("px"), F.col("e.p.y").alias("py"), F.col("e.q.x").alias("qx"), F.col("e.q.y").alias("qy")).dropna(subset=["px", "py", "qx", "qy"])


class Tree:
    """Cells of each level over the edges of all layers. Edges longer than a leaf stand in it by pieces, so that boxes stay tight."""

    def __init__(self, shapes: DataFrame, layer: str, key: str):
        # Equal edges of a layer are one, so no cell is crowded by copies.
        held = edges_of(shapes.withColumn("_area", F.col("type").isin(*AREAS)), [layer, key, "_area"])
        same = held.groupBy(F.col(layer).alias("layer"), "px", "py", "qx", "qy").agg(F.min(key).alias("key"), F.max("_area").alias("area"))
        self.edges = cut(same)
        wide, high = (lambda f, g: F.max(F.greatest(f, g)) - F.min(F.least(f, g))), F.greatest(F.abs(F.col("qx") - F.col("px")), F.abs(F.col("qy") - F.col("py")))
        spread = self.edges.agg(F.count("*").alias("n"), F.count_distinct("layer").alias("layers"), F.greatest(wide("px", "qx"), wide("py", "qy")).alias("extent"), F.sum(high).alias("length"), F.max("area").alias("areas")).first()
        self.areas = bool(spread.areas)
        self.n, self.layers, self.extent, self.length = spread.n, spread.layers, spread.extent or 0.0, spread.length or 0.0
        at_least = [max(self.extent, 1e-6) / math.sqrt(max(self.n / 8, 1)), self.length / (PIECES * max(self.n, 1)), 2.0**FINEST]
        self.leaf = min(math.ceil(math.log2(max(at_least))), COARSEST)
        while True:
            self.leaves, crowd = self._leaves()
            finer = self.leaf - STEP
            if crowd <= CROWD or finer < FINEST or self.length / 2.0**finer > 2 * PIECES * self.n:
                break
            self.leaf = finer
        self.top = self.leaf
        while self.extent >= 2.0**self.top and self.top < COARSEST:
            self.top += STEP

    def pieces(self) -> DataFrame:
        """The edges with the ends (ax, ay, bx, by) and the cell of each of their pieces."""
        dx, dy = F.col("qx") - F.col("px"), F.col("qy") - F.col("py")
        each = self.edges.withColumn("n", self._parts()).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        along = lambda p, d, k: F.col(p) + d * (k / F.col("n"))
        each = each.select(*self.edges.columns, *(along(p, d, F.col("i") + k).alias(name) for name, p, d, k in (("ax", "px", dx, 0), ("ay", "py", dy, 0), ("bx", "px", dx, 1), ("by", "py", dy, 1))))
        cell = lambda a, b: F.floor((F.col(a) + F.col(b)) / 2 / 2.0**self.leaf)
        return each.withColumn("cy", cell("ay", "by")).withColumn("cx", cell("ax", "bx"))

    def _parts(self) -> Column:
        return F.greatest(F.ceil(F.greatest(F.abs(F.col("qx") - F.col("px")), F.abs(F.col("qy") - F.col("py"))) / 2.0**self.leaf), F.lit(1)).cast("int")

    def placed(self) -> DataFrame:
        """The edges with each leaf (cy, cx) that a piece of theirs falls into, once."""
        dx, dy, n = F.col("qx") - F.col("px"), F.col("qy") - F.col("py"), F.col("n")
        along = lambda p, d, k: F.col(p) + d * (k / n)
        cell = lambda p, d, i: F.floor((along(p, d, i) + along(p, d, i + 1)) / 2 / 2.0**self.leaf)
        cells = F.array_distinct(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(cell("py", dy, i).alias("cy"), cell("px", dx, i).alias("cx"))))
        return self.edges.withColumn("n", self._parts()).withColumn("c", F.explode(cells)).select(*self.edges.columns, "c.cy", "c.cx")

    def _leaves(self) -> tuple[DataFrame, float]:
        low, high = (lambda a, b: F.min(F.least(a, b))), (lambda a, b: F.max(F.greatest(a, b)))
        cells = self.pieces().groupBy("layer", "cy", "cx").agg(
            low("ax", "bx").alias("x0"), high("ax", "bx").alias("x1"), low("ay", "by").alias("y0"), high("ay", "by").alias("y1"), F.min(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"))).alias("some"), F.count("*").alias("n")
        )
        cells = cut(cells)
        met = cells.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0]
        return cells.drop("n"), met or 0.0

    def cells(self, level: int) -> DataFrame:
        """(layer, cy, cx, box, some place) of a level, with the number of the cell around it."""
        up = level - self.leaf
        at = lambda c: F.shiftright(c, up).alias(c) if up else F.col(c)
        got = self.leaves.groupBy("layer", at("cy"), at("cx")).agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.min("some").alias("some")) if up else self.leaves
        return got.withColumn("uy", F.shiftright("cy", STEP)).withColumn("ux", F.shiftright("cx", STEP))

    def few(self, level: int) -> bool:
        """Whether a level's cells are so few, by their number in the extent or else counted, that they may be broadcast."""
        return min((1 + 2 * PIECES) * self.n, self.layers * (self.extent / 2.0**level + 2) ** 2) <= MOST_ROWS or self.cells(level).limit(MOST_ROWS + 1).count() <= MOST_ROWS


def _bounds(frontier: DataFrame) -> DataFrame:
    """Squared distances in degrees: the box's, which no edge in the cell undercuts, and some place's, which the nearest edge doesn't exceed."""
    off = lambda a, b, v: F.greatest(F.col(a) - F.col(v), F.col(v) - F.col(b), F.lit(0.0))
    dx, dy = off("x0", "x1", "x") * F.col("shrink"), off("y0", "y1", "y")
    sx, sy = (F.col("some.x") - F.col("x")) * F.col("shrink"), F.col("some.y") - F.col("y")
    return frontier.withColumn("least", dx * dx + dy * dy).withColumn("most", sx * sx + sy * sy).drop("x0", "x1", "y0", "y1", "some")


def _near(sphere: bool, least: Column, most: Column) -> Column:
    if not sphere:
        return least <= most * (1 + 1e-9) + 1e-20
    # East-west degrees shrink towards the poles, so the plane at the point over- and underrates what lies off its latitude; the margin covers both.
    reach, lat = 2 * F.sqrt(most) + 1e-9, F.abs("y")
    cosine = lambda a: F.greatest(F.cos(F.radians(F.least(F.greatest(a, F.lit(0.0)), F.lit(90.0)))), F.lit(0.0))
    return least * cosine(lat + reach) <= most * cosine(lat - reach) * 1.01


def _pruned(frontier: DataFrame, sphere: bool) -> DataFrame:
    """The cells that may hold the nearest edge, with what the point has seen so far (``seen``)."""
    if "seen" in frontier.columns:  # what the cells around have shown spares the others the shuffle
        frontier = frontier.where(_near(sphere, F.col("least"), F.col("seen"))).withColumn("most", F.least("most", "seen")).drop("seen")
    seen = frontier.withColumn("seen", F.min("most").over(W.partitionBy("point", "layer")))
    return seen.where(_near(sphere, F.col("least"), F.col("seen"))).drop("least", "most")


def nearest_edges(sphere: bool):
    """The function that takes a leaf's points and its edges, as tables, and returns for each point the edges that are as near as any of them, but for rounding."""
    import numpy as np
    import pyarrow as pa

    def nearest(points: pa.Table, edges: pa.Table) -> pa.Table:
        of = lambda t, c: t.column(c).to_numpy()
        x, y, shrink = of(points, "x"), of(points, "y"), of(points, "shrink")
        px, py, qx, qy = (of(edges, c)[None, :] for c in ("px", "py", "qx", "qy"))
        whose, which = [], []
        step = max(1, CHUNK // max(1, px.shape[1]))
        for at in range(0, len(x) if px.shape[1] else 0, step):
            a, b, s = (v[at : at + step, None] for v in (x, y, shrink))
            rx, ry, dx, dy = (px - a) * s, py - b, (qx - px) * s, qy - py
            long = dx * dx + dy * dy
            t = np.clip(-(rx * dx + ry * dy) / np.where(long == 0, 1.0, long), 0.0, 1.0)
            fx, fy = px + t * (qx - px), py + t * (qy - py)
            if sphere:
                u, v = np.radians(b), np.radians(fy)
                far = np.sin((v - u) / 2) ** 2 + np.cos(u) * np.cos(v) * np.sin(np.radians(fx - a) / 2) ** 2
            else:
                far = (fx - a) ** 2 + (fy - b) ** 2
            k, j = np.nonzero(far <= far.min(1, keepdims=True) * (1 + 1e-9) + 1e-28)
            whose.append(k + at)
            which.append(j)
        whose, which = (pa.array(np.concatenate(v) if v else np.zeros(0, np.int64)) for v in (whose, which))
        own, met = points.select(["point", "x", "y", "shrink"]).take(whose), edges.select(["layer", "key", "px", "py", "qx", "qy"]).take(which)
        return pa.table([*own.columns, *met.columns], names=[*own.column_names, *met.column_names])

    return nearest


def _met_edges(frontier: DataFrame, tree: Tree, sphere: bool) -> DataFrame:
    """Each point with the nearest edges of each leaf that it has come to; edges of leaves without points are left where they are. A leaf's points are dealt to shares that keep a task's rows bounded."""
    leaf = ["layer", "cy", "cx"]
    frontier = cut(frontier.drop("seen"))
    held = cut(frontier.groupBy(*leaf).agg(F.count("*").alias("m")).withColumn("_m", F.ceil(F.col("m") / LEAF_PLACES).cast("int")))
    shares, key = small(held.drop("m")), [*leaf, "_j"]
    edges = tree.placed().join(shares, leaf).withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_m") - 1))).select(*key, "key", "px", "py", "qx", "qy")
    crowded = small(held.where(F.col("_m") > 1).drop("m"))
    points = frontier.join(crowded, leaf, "left").withColumn("_j", F.coalesce(F.pmod(F.xxhash64("point"), F.col("_m")).cast("int"), F.lit(0))).select(*key, "point", "x", "y", "shrink")
    rows = frontier.count() + (2 * PIECES + 1) * tree.n
    tasks = rows // TASK_ROWS + 1
    kinds = {c: (frontier if c in frontier.columns else tree.edges).schema[c].dataType for c in ("point", "x", "y", "shrink", "layer", "key", "px", "py", "qx", "qy")}
    schema = T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])
    both = points.repartition(tasks, *key).groupBy(*key).cogroup(edges.repartition(tasks, *key).groupBy(*key))
    return both.applyInArrow(nearest_edges(sphere), schema)


def nearest_shapes(points: DataFrame, shapes: DataFrame, point_key: str, shape_key: str = "id", layer: str = "layer", lat: str = "lat", lng: str = "lng", sphere: bool = False) -> DataFrame:
    """(point, layer, shape, distance_m): the nearest shape of each layer, whatever its distance; none for a layer without shapes.

    Nearest in plane degrees, as a planar index has it, or with ``sphere`` in metres; ties go to the lesser distance in metres, then to the lesser key.
    The distance in metres is to that shape's nearest place, 0 within a polygon (a hole is outside).
    points: unique key, lat and lng, rows without coordinates have no result; shapes: layer, key, type (Point, LineString, Polygon or MultiPolygon), and
    ``path`` or ``rings``, arrays of struct(x, y). The date line is not crossed.
    """
    tree = Tree(shapes, layer, shape_key)
    at = points.where(F.col(lat).isNotNull() & F.col(lng).isNotNull()).select(F.col(point_key).alias("point"), F.col(lng).cast("double").alias("x"), F.col(lat).cast("double").alias("y"))
    at = at.withColumn("shrink", F.cos(F.radians("y")) if sphere else F.lit(1.0))
    top = cut(tree.cells(tree.top))  # four cells a layer at most
    layers = F.array(*(F.lit(r.layer) for r in top.select("layer").distinct().collect())).cast(T.ArrayType(top.schema["layer"].dataType))
    frontier, inside = at.withColumn("layer", F.explode(layers)), None
    if tree.areas:  # what lies within a polygon has found its nearest one
        areas = shapes.where(F.col("type").isin(*AREAS)).select(F.col(layer).alias("layer"), F.col(shape_key).alias("key"), parts_of(shapes).alias("rings"))
        inside = cut(first_polygons(at, areas, "point", "layer", "key", "y", "x"))
        frontier = frontier.join(inside, ["point", "layer"], "left_anti")
    frontier = _pruned(_bounds(frontier.join(F.broadcast(top.drop("uy", "ux")), "layer")), sphere)
    for level in range(tree.top - STEP, tree.leaf - 1, -STEP):
        cells = tree.cells(level)
        cells = F.broadcast(cells) if tree.few(level) else cells
        within = frontier.withColumnsRenamed({"cy": "uy", "cx": "ux"}).join(cells, ["layer", "uy", "ux"]).drop("uy", "ux")
        frontier = _pruned(_bounds(within), sphere)
    met = _met_edges(frontier, tree, sphere)
    px, py = (F.col("px") - F.col("x")) * F.col("shrink"), F.col("py") - F.col("y")
    dx, dy = (F.col("qx") - F.col("px")) * F.col("shrink"), F.col("qy") - F.col("py")
    t = F.coalesce(F.least(F.greatest(-(px * dx + py * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))
    foot = met.withColumn("t", t).withColumn("fx", F.col("px") + F.col("t") * (F.col("qx") - F.col("px"))).withColumn("fy", F.col("py") + F.col("t") * (F.col("qy") - F.col("py")))
    far = F.lit(0.0) if sphere else (F.col("fx") - F.col("x")) * (F.col("fx") - F.col("x")) + (F.col("fy") - F.col("y")) * (F.col("fy") - F.col("y"))
    outside = foot.select("point", "layer", far.alias("far"), haversine_m("y", "x", "fy", "fx").alias("distance_m"), "key")
    if inside is not None:
        outside = outside.unionByName(inside.select("point", "layer", F.lit(0.0).alias("far"), F.lit(0.0).alias("distance_m"), "key"))
    return _best(outside, point_key, shape_key, layer)


def _best(found: DataFrame, point_key: str, shape_key: str, layer: str) -> DataFrame:
    best = found.groupBy("point", "layer").agg(F.min(F.struct("far", "distance_m", "key")).alias("b"))
    return best.select(F.col("point").alias(point_key), F.col("layer").alias(layer), F.col("b.key").alias(shape_key), F.col("b.distance_m").alias("distance_m"))
