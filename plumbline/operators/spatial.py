"""Spatial joins as equi-joins on grid buckets.

Points fall into buckets as high and wide as the search radius or more. The width follows the latitude of the bucket's row, and
each row closes around the globe, so the date line and the poles need no care. One side is exploded to
its bucket and those around it; then it is an ordinary equi-join, which Spark can shuffle,
broadcast or split where a bucket is hot. The exact distance is checked last.

Boxes and polygons meet on a grid of levels: each stands in at most four cells of the level that fits its size.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DecimalType, FractionalType, IntegralType

from ..functions.geo import DEGREE_M, RADIUS_M, haversine_m
from .checkpoints import cut
from .lookup import small
from .sweep import tile_sums


def _columns_of(row: Column, metres: float) -> Column:
    """How many buckets a row has: so few that none is narrower than the radius anywhere in the row or its neighbours."""
    step = metres / DEGREE_M * 1.001
    far = F.least(F.greatest(F.abs((row - 1) * step), F.abs((row + 2) * step)), F.lit(90.0))
    reach = math.sin(min(math.pi / 2, metres / RADIUS_M / 2)) / F.greatest(F.cos(F.radians(far)), F.lit(1e-12))
    width = F.degrees(2 * F.asin(F.least(reach, F.lit(1.0)))) * 1.001
    return F.greatest(F.floor(360.0 / width), F.lit(1)).cast("bigint")


def _buckets(df: DataFrame, lat: str, lng: str, metres: float, around: bool) -> DataFrame:
    by = F.floor(F.col(lat) / (metres / DEGREE_M * 1.001))

    def cell(row: Column) -> tuple[Column, Column]:
        n = _columns_of(row, metres)
        return n, F.floor((F.col(lng) + 180.0) / 360.0 * n).cast("bigint")

    if not around:
        n, x = cell(by)
        return df.withColumn("_by", by).withColumn("_bx", F.pmod(x, n))
    rows = []
    for i in (-1, 0, 1):
        n, x = cell(by + i)
        rows += [F.struct((by + i).alias("y"), F.pmod(x + j, n).alias("x")) for j in (-1, 0, 1)]
    near = F.array_distinct(F.array(*rows))
    return df.withColumn("_b", F.explode(near)).withColumn("_by", F.col("_b.y")).withColumn("_bx", F.col("_b.x")).drop("_b")


def _paired(left: DataFrame, right: DataFrame, metres: float, left_at, right_at, explode: str) -> DataFrame:
    a = _buckets(left.where(F.col(left_at[0]).isNotNull() & F.col(left_at[1]).isNotNull()), *left_at, metres, explode == "left")
    b = _buckets(right.where(F.col(right_at[0]).isNotNull() & F.col(right_at[1]).isNotNull()), *right_at, metres, explode == "right")
    return a.join(b, ["_by", "_bx"]).drop("_by", "_bx")


def radius_join(left: DataFrame, right: DataFrame, metres: float, left_at=("lat", "lng"), right_at=("r_lat", "r_lng"), explode: str = "left", distance: str = "distance_m") -> DataFrame:
    """Pairs of points within ``metres``, with their distance. Name the smaller side to ``explode``. Null coordinates match nothing."""
    pairs = _paired(left, right, metres, left_at, right_at, explode)
    return pairs.withColumn(distance, haversine_m(*left_at, *right_at)).where(F.col(distance) <= metres)


def _on_sphere(lat: str, lng: str, prefix: str) -> dict[str, Column]:
    """The point's place on the unit sphere."""
    phi, lam = F.radians(F.col(lat)), F.radians(F.col(lng))
    return {f"{prefix}x": F.cos(phi) * F.cos(lam), f"{prefix}y": F.cos(phi) * F.sin(lam), f"{prefix}z": F.sin(phi)}


#: Points of a cell of a quarter of the reach, as a point sees them on average, up to which pairs of points are cheaper than circles swept over sorted points; and of a leaf of the cells.
DIRECT, LEAF_POINTS = 4, 64
#: Points and places of a tile that one task holds at a time; more are dealt to several. A tile is TILE times as wide as the reach.
TILE_ROWS, TILE = 200_000, 8
#: Cells of a level stand side by side in those of the next one, FAN by FAN; there are LEVELS_MOST levels at most.
FAN, LEVELS_MOST = 8, 5
#: Metres that a cell must keep from a circle's edge to count as whole or outside.
MARGIN_M = 1e-6


def _first_cells(reach: float) -> tuple[float, Column, Column]:
    """The height in degrees of cells of a quarter of the reach, a point's row, and how many cells its row has."""
    high = reach / 4 / DEGREE_M
    row = F.floor(F.col("r_lat") / high)
    return high, row, F.greatest(F.ceil(360.0 * F.cos(F.radians(F.least(F.when(row >= 0, row * high).otherwise(-(row + 1) * high), F.lit(90.0)))) / high), F.lit(1)).cast("bigint")


def _crowd(points: DataFrame, reach: float) -> float:
    """How many points a cell of a quarter of the reach holds, as a point sees them on average."""
    _, row, columns = _first_cells(reach)
    held = points.groupBy(row.alias("y"), F.floor((F.col("r_lng") + 180.0) / 360.0 * columns).alias("x")).count()
    return held.agg(F.sum(F.col("count") * F.col("count")) / F.sum("count")).first()[0] or 0.0


def _cell_pyramid(points: DataFrame, sums: list[str], reach: float) -> tuple[list[DataFrame], DataFrame]:
    """The levels of cells over points of distinct places, coarse first, and the points with the cells they lie in.

    A cell (its middle in the grid, not among its points) knows its points' sums and the greatest distance of any from the middle.
    """
    high, _, columns0 = _first_cells(reach)
    placed = points.withColumn("_n0", columns0)

    def at(level: int) -> tuple[Column, Column]:
        fan = FAN**level
        return F.floor(F.col("r_lat") / (high / fan)).cast("bigint"), F.floor((F.col("r_lng") + 180.0) / 360.0 * (F.col("_n0") * fan)).cast("bigint")

    levels = []
    for level in range(LEVELS_MOST):
        y, x = at(level)
        placed = placed.withColumn(f"_c{level}", F.struct(y.alias("y"), x.alias("x"), F.col("_n0").alias("n")))
        fan = FAN**level
        own = F.col(f"_c{level}")
        middle = placed.withColumn("m_lat", F.least(F.greatest((own["y"] + 0.5) * (high / fan), F.lit(-90.0)), F.lit(90.0))).withColumn("m_lng", (own["x"] + 0.5) / (own["n"] * fan) * 360.0 - 180.0)
        up = [F.first(f"_c{level - 1}").alias("up")] if level else []
        cells = cut(middle.groupBy(own.alias("cell")).agg(F.first("m_lat").alias("m_lat"), F.first("m_lng").alias("m_lng"), F.max(haversine_m("r_lat", "r_lng", "m_lat", "m_lng")).alias("wide"), F.count("*").alias("n"), *up, *(F.sum(c).alias(c) for c in sums)))
        crowd = cells.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0] or 0.0
        levels.append(cells.drop("n"))
        if crowd <= LEAF_POINTS:
            break
    return levels, placed


def radius_sums(left: DataFrame, right: DataFrame, sums: dict[str, tuple[Column, float]], left_at=("lat", "lng"), right_at=("r_lat", "r_lng")) -> DataFrame:
    """For each left row the sums of right values within several radii; 0 where nothing is near or the row has no coordinates. Rows may be repeated.

    Sums are taken for distinct places of the left side. Where the right points lie thinly, pairs within the largest radius are formed
    in buckets, the smaller side dealt to the buckets around. Where they lie densely, tiles of points meet the places whose circles may reach them, and in a tile each circle is swept
    over the sorted points: running totals give what lies wholly within, and only points at the circles' edges are compared. So the work for a place follows its circles' edges
    and not the number of points. Which of the two it is goes by how many points a cell holds on average. Sums of decimals, dense ones, descend a pyramid of cells.
    sums: result column -> (value, metres).
    """
    metres, radii, names = max(m for _, m in sums.values()), [m for _, m in sums.values()], [f"_v{k}" for k in range(len(sums))]
    values = list({id(v): v for v, _ in sums.values()}.values())  # a value that several radii share is carried once
    owns = [f"_w{next(j for j, w in enumerate(values) if w is v)}" for v, _ in sums.values()]
    held = [f"_w{j}" for j in range(len(values))]
    places = cut(left.select(F.col(left_at[0]).alias("lat"), F.col(left_at[1]).alias("lng")).where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).distinct())
    # Rows are dealt by all that they hold, so rows of one place need not meet in a task.
    points = right.select(F.col(right_at[0]).alias("r_lat"), F.col(right_at[1]).alias("r_lng"), *(v.alias(n) for n, v in zip(held, values)), F.xxhash64(*right.columns).alias("_deal")).where(F.col("r_lat").isNotNull() & F.col("r_lng").isNotNull())
    kinds = {n: points.schema[n].dataType for n in held}
    fractions = [n for n, kind in kinds.items() if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType)]
    points = points.withColumns({n: F.col(n).cast("double" if n in fractions else "bigint") for n, kind in kinds.items() if n in fractions or isinstance(kind, IntegralType)})
    # Of equal places one row, where pairs are formed.
    merged = lambda some: some.groupBy("r_lat", "r_lng").agg(*(F.sum(n).alias(n) for n in held))
    if _crowd(points, metres) <= DIRECT:
        parts = [_pair_sums(places, cut(merged(points)), names, owns, radii, metres)]
    elif all(isinstance(kind, IntegralType) or n in fractions for n, kind in kinds.items()):
        odd = functools.reduce(lambda a, b: a | b, [F.coalesce(F.isnan(F.abs(n) * 0.0), F.lit(False)) for n in fractions], F.lit(False))  # infinite or no number, which would spoil running totals
        parts = [_swept(places, points.where(~odd), names, owns, radii, metres)]
        strange = points.where(odd)
        parts += [] if not fractions or strange.isEmpty() else [_pair_sums(places, cut(merged(strange)), names, owns, radii, metres)]
    else:
        levels, placed = _cell_pyramid(cut(merged(points).select("r_lat", "r_lng", *(F.col(w).alias(n) for n, w in zip(names, owns)))), names, metres)
        parts = _descended(places, levels, placed, names, radii, metres)
    got = functools.reduce(DataFrame.unionByName, parts)
    got = got.groupBy(F.col("lat").alias("_lat"), F.col("lng").alias("_lng")).agg(*(F.sum(n).alias(n) for n in names))
    kept = left.join(got, (F.col(left_at[0]) == F.col("_lat")) & (F.col(left_at[1]) == F.col("_lng")), "left")
    return kept.select(*(left[c] for c in left.columns), *(F.coalesce(n, F.lit(0)).alias(name) for n, name in zip(names, sums)))


def _chord(metres: float) -> float:
    """The squared chord through the unit sphere that spans so many metres."""
    return (2 * math.sin(min(math.pi / 2, metres / RADIUS_M / 2))) ** 2


def _pair_sums(places: DataFrame, points: DataFrame, names: list[str], owns: list[str], radii: list[float], metres: float) -> DataFrame:
    """The sums from pairs of points, which are compared by their chords; that takes no trigonometry for a pair."""
    side = "left" if places.count() <= points.count() else "right"
    a = _buckets(places.withColumns(_on_sphere("lat", "lng", "_l")), "lat", "lng", metres, side == "left")
    b = _buckets(points.withColumns(_on_sphere("r_lat", "r_lng", "_r")), "r_lat", "r_lng", metres, side == "right")
    # A merge join reads a bucket's points in a row and keeps a place's pairs together, which a hashed relation of this size doesn't.
    near = a.hint("merge").join(b.drop("r_lat", "r_lng"), ["_by", "_bx"])
    chord = sum(((F.col(f"_l{c}") - F.col(f"_r{c}")) * (F.col(f"_l{c}") - F.col(f"_r{c}")) for c in "xyz"), F.lit(0.0))
    near = near.withColumn("_d", chord).where(F.col("_d") <= _chord(metres))
    return near.groupBy("lat", "lng").agg(*(F.sum(F.when(F.col("_d") <= _chord(m), F.col(w))).alias(n) for n, w, m in zip(names, owns, radii)))


def _met_tiles(places: DataFrame, metres: float, tile: float) -> DataFrame:
    """A row for each tile (_by, _bx) that a place's circle may meet: its own, and those of the eight around whose border is within ``metres``."""
    step, up = tile / DEGREE_M * 1.001, metres / DEGREE_M * 1.001
    beside = lambda c: F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias(c)
    rows = places.withColumn("_row", F.floor(F.col("lat") / step)).select("lat", "lng", "_row", beside("_i"))
    rows = rows.where((F.col("_i") == 0) | ((F.col("_i") < 0) & (F.col("lat") - F.col("_row") * step <= up)) | ((F.col("_i") > 0) & ((F.col("_row") + 1) * step - F.col("lat") <= up)))
    far = F.least(F.abs("lat") + up, F.lit(90.0))
    side = F.degrees(2 * F.asin(F.least(math.sin(min(math.pi / 2, metres / RADIUS_M / 2)) / F.greatest(F.cos(F.radians(far)), F.lit(1e-12)), F.lit(1.0)))) * 1.001
    rows = rows.select("lat", "lng", (F.col("_row") + F.col("_i")).alias("_by"), side.alias("_side")).withColumn("_n", _columns_of(F.col("_by"), tile))
    rows = rows.withColumn("_at", (F.col("lng") + 180.0) / 360.0 * F.col("_n")).withColumn("_x", F.floor("_at").cast("bigint")).select("*", beside("_j"))
    n, j = F.col("_n"), F.col("_j")
    gap = F.when(j < 0, F.col("_at") - F.col("_x")).otherwise(F.col("_x") + 1 - F.col("_at")) * 360.0 / n
    # Of one or two columns in a row none is met twice.
    rows = rows.where((j == 0) | ((n > F.when(j < 0, 2).otherwise(1)) & ((n <= 3) | (gap <= F.col("_side")))))
    return rows.select("lat", "lng", "_by", F.pmod(F.col("_x") + j, n).alias("_bx"))


def _swept(places: DataFrame, points: DataFrame, names: list[str], owns: list[str], radii: list[float], metres: float) -> DataFrame:
    """The sums by circles swept over tiles of sorted points. Of a crowded tile points and places are each dealt to as many shares as keep a task's rows bounded; sums add up over shares."""
    tile = ["_by", "_bx"]
    finite = lambda df, *at: df.withColumns({c: F.col(c).cast("double") for c in at}).where(functools.reduce(lambda p, q: p & q, [F.abs(c) < F.lit(math.inf) for c in at]))
    a = _met_tiles(finite(places, "lat", "lng"), metres, metres * TILE)
    b = _buckets(finite(points, "r_lat", "r_lng"), "r_lat", "r_lng", metres * TILE, False)
    held = cut(b.groupBy(*tile).agg(F.count("*").alias("n")).join(a.groupBy(*tile).agg(F.count("*").alias("m")), tile))
    shares = small(held.select(*tile, F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("_n"), F.ceil(F.col("m") / TILE_ROWS).cast("int").alias("_m")))
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda at, c: F.pmod(at, F.col(c)).cast("int")
    carried = sorted(set(owns))
    key, rows = [*tile, "_i", "_j"], held.agg(F.sum(F.col("n") + F.col("m"))).first()[0] or 0
    a = a.join(shares, tile).withColumn("_j", own(F.xxhash64("lat", "lng"), "_m")).withColumn("_i", each("_n")).select(*key, "lat", "lng")
    b = b.join(shares, tile).withColumn("_i", own(F.col("_deal"), "_n")).withColumn("_j", each("_m")).select(*key, "r_lat", "r_lng", *carried)
    tasks = rows // TILE_ROWS + 1
    a, b = a.repartition(tasks, *key), b.repartition(tasks, *key)
    schema = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType()), *(T.StructField(n, T.LongType() if isinstance(points.schema[w].dataType, IntegralType) else T.DoubleType()) for n, w in zip(names, owns))])
    return a.groupBy(*key).cogroup(b.groupBy(*key)).applyInArrow(tile_sums(names, owns, [m / RADIUS_M for m in radii], to_arrow_schema(schema)), schema)


def _descended(places: DataFrame, levels: list[DataFrame], placed: DataFrame, names: list[str], radii: list[float], metres: float) -> list[DataFrame]:
    """The sums of whole cells of each level, and of the points in what remains."""
    parts, rest = [], None
    for level, cells in enumerate(levels):
        if level:
            met = rest.join(cells.withColumnRenamed("up", "_up"), F.col("_cell") == F.col("_up")).drop("_cell", "_up")
        else:
            wide = cells.agg(F.max("wide")).first()[0]
            met = _paired(places, cells, metres + wide + 1.0, ("lat", "lng"), ("m_lat", "m_lng"), "left").withColumns({f"_open{k}": F.lit(True) for k in range(len(radii))})
        met = met.withColumn("_d", haversine_m("lat", "lng", "m_lat", "m_lng"))
        whole = [F.col(f"_open{k}") & (F.col("_d") + F.col("wide") <= m - MARGIN_M) for k, m in enumerate(radii)]
        crossed = [F.col(f"_open{k}") & (F.col("_d") + F.col("wide") > m - MARGIN_M) & (F.col("_d") - F.col("wide") <= m + MARGIN_M) for k, m in enumerate(radii)]
        met = cut(met.select("lat", "lng", "cell", *names, *(w.alias(f"_whole{k}") for k, w in enumerate(whole)), *(c.alias(f"_open{k}") for k, c in enumerate(crossed))).where(functools.reduce(lambda p, q: p | q, [F.col(f"_{w}{k}") for k in range(len(radii)) for w in ("whole", "open")])))
        parts.append(met.groupBy("lat", "lng").agg(*(F.sum(F.when(F.col(f"_whole{k}"), F.col(n))).alias(n) for k, n in enumerate(names))))
        rest = met.where(functools.reduce(lambda p, q: p | q, [F.col(f"_open{k}") for k in range(len(radii))])).select("lat", "lng", F.col("cell").alias("_cell"), *(f"_open{k}" for k in range(len(radii))))
    last = placed.select(F.col(f"_c{len(levels) - 1}").alias("_leaf"), "r_lat", "r_lng", *names)
    near = rest.join(last, F.col("_cell") == F.col("_leaf"))
    far = sum(((a - b) * (a - b) for a, b in zip(_on_sphere("lat", "lng", "").values(), _on_sphere("r_lat", "r_lng", "").values())), F.lit(0.0))
    near = near.withColumn("_d", far)
    return [*parts, near.groupBy("lat", "lng").agg(*(F.sum(F.when(F.col(f"_open{k}") & (F.col("_d") <= _chord(m)), F.col(n))).alias(n) for k, (n, m) in enumerate(zip(names, radii))))]


def nearest_within(left: DataFrame, right: DataFrame, key: str, metres: float, id_col: str, carry: tuple[str, ...], **where) -> DataFrame:
    """The nearest right row within ``metres`` of each left row, ties by id: key, distance_m, the id and the columns to carry."""
    near = radius_join(left, right, metres, **where)
    best = F.min(F.struct("distance_m", id_col, *carry)).alias("best")
    return near.groupBy(key).agg(best).select(key, "best.*")


#: Points that a search circle of the first round holds on average, for each neighbour wanted; remaining queries that are broadcast; points of a task.
ROOM, FEW_QUERIES, TASK_POINTS = 2, 20_000, 20_000


def _first_reach(points: DataFrame, right_at, k: int, metres: float) -> float:
    """At most ``metres``, and less where points lie so densely, as a point sees them on average, that a circle of ROOM * k points is smaller."""
    most = ROOM * k / math.pi  # points of a bucket as wide as the reach
    for _ in range(8):
        held = _buckets(points, *right_at, metres, False).groupBy("_by", "_bx").count()
        crowd = held.agg(F.sum(F.col("count") * F.col("count")) / F.sum("count") - 1).first()[0] or 0.0  # but for the point itself
        if crowd <= 1.5 * most or metres <= 1.0:
            break
        metres = max(metres * math.sqrt(most / crowd), 1.0)
    return metres


def knn_join(queries: DataFrame, points: DataFrame, k: int, metres: float, query_key: str, point_key: str, skip_self: bool = False, left_at=("lat", "lng"), right_at=("r_lat", "r_lng"), distance: str = "distance_m") -> DataFrame:
    """The k nearest points of each query, ranks from 1, ties by key; all points if there are fewer.

    The search radius starts at ``metres``, or less where points are crowded, and doubles for those queries only that have fewer than k points
    yet, up to half the globe's girth, so no query is left incomplete; each round is a bucket join. While queries are many the points are dealt to the buckets
    around, so that a query's pairs stand in its own bucket and are ranked there, without another shuffle. Of points at one place only those of
    least key count, as many as may be wanted. Keys are unique; points without coordinates, or with skip_self without a key, are nobody's neighbours.
    """
    somewhere = points.where(F.col(right_at[0]).isNotNull() & F.col(right_at[1]).isNotNull())
    somewhere = somewhere.where(F.col(point_key).isNotNull()) if skip_self else somewhere
    wanted = k + (1 if skip_self else 0)
    at_place = W.partitionBy(*(F.col(c) + 0.0 for c in right_at)).orderBy(point_key)
    somewhere = cut(somewhere.withColumn("_k", F.row_number().over(at_place)).where(F.col("_k") <= wanted).drop("_k"))
    n = somewhere.count()
    most = min(k, n - (1 if skip_self else 0))
    reach = _first_reach(somewhere, right_at, k, metres) if most > 0 else metres
    done, rest = None, queries if most <= 0 else cut(queries)
    left = 0 if most <= 0 else rest.count()
    while most > 0 or done is None:
        last = reach > math.pi * RADIUS_M or most <= 0
        many = left * 9 >= n
        a = _buckets(rest.where(F.col(left_at[0]).isNotNull() & F.col(left_at[1]).isNotNull()), *left_at, reach, not many)
        b = _buckets(somewhere, *right_at, reach, many)
        if many:  # as many tasks as points ask for: their pairs are far more than the rows shuffled
            tasks = max(left, n) // TASK_POINTS + 1
            a, b = a.repartition(tasks, "_by", "_bx"), b.repartition(tasks, "_by", "_bx")
        a, b = a.withColumns(_on_sphere(*left_at, "_l")), b.withColumns(_on_sphere(*right_at, "_r"))
        chord = sum(((F.col(f"_l{c}") - F.col(f"_r{c}")) * (F.col(f"_l{c}") - F.col(f"_r{c}")) for c in "xyz"), F.lit(0.0))  # spares the trigonometry of most pairs
        near = (F.broadcast(a) if left <= FEW_QUERIES else a).join(b, ["_by", "_bx"]).where(chord <= _chord(reach) * 1.001 + 1e-15).drop(*(f"_{side}{c}" for side in "lr" for c in "xyz")).withColumn(distance, haversine_m(*left_at, *right_at)).where(F.col(distance) <= reach)
        near = near.where(F.col(query_key) != F.col(point_key)) if skip_self else near
        ranked_by = W.partitionBy(*(["_by", "_bx"] if many else []), query_key).orderBy(distance, point_key)
        ranked = near.withColumn("rank", F.row_number().over(ranked_by)).where(F.col("rank") <= k).drop("_by", "_bx")
        ranked = ranked if last else cut(ranked)  # what a round has found is kept, not found anew by the next one
        full = ranked.where(F.col("rank") == most).select(query_key)
        part = ranked if last else ranked.join(full, query_key, "left_semi")
        done = part if done is None else done.unionByName(part)
        if last:
            break
        rest = cut(rest.join(full, query_key, "left_anti"))
        left = rest.count()
        if not left:
            break
        reach *= 2
    return done


#: Levels of the grid that boxes and polygons meet on: cells of 2 ** level degrees.
LEVELS = (-20, 9)
#: Levels below its own that a box meets points on: 25 cells at most. A polygon of 2 ** WIDE degrees goes as many levels deeper: 289 cells.
FINER, WIDE = 2, -3


def _level(height: Column, width: Column) -> Column:
    """The least level whose cells are as large as the box."""
    size = F.greatest(height, width, F.lit(2.0 ** LEVELS[0]))
    return F.least(F.ceil(F.log2(size)), F.lit(LEVELS[1])).cast("int")


def _cells(df: DataFrame, y0: Column, y1: Column, x0: Column, x1: Column, level: Column) -> DataFrame:
    """A row for each cell (_y, _x) of the level that the box touches: four at most if the level fits."""
    step = F.pow(F.lit(2.0), level)
    steps = lambda a, b: F.sequence(F.floor(a / step), F.floor(b / step))
    return df.withColumn("_y", F.explode(steps(y0, y1))).withColumn("_x", F.explode(steps(x0, x1)))


def _dealt(boxes: DataFrame, box, wide: int = 0) -> DataFrame:
    """A row for each cell (_level, _y, _x) that a box touches, FINER levels below the box's size, and ``wide`` more for boxes of WIDE degrees."""
    y0, y1, x0, x1 = map(F.col, box)
    level = _level(y1 - y0, x1 - x0)
    finer = F.greatest(level - F.when(level >= WIDE, FINER + wide).otherwise(FINER), F.lit(LEVELS[0]))
    return _cells(boxes.withColumn("_level", finer), y0, y1, x0, x1, F.col("_level"))


def _placed(points: DataFrame, dealt: DataFrame, lat: str, lng: str, tasks: int = 0) -> DataFrame:
    """The points joined with what is dealt to their cells, in so many tasks if given: a few points' pairs may be far more than their bytes tell. They stand in one cell of each level that occurs; there are LEVELS[1] - LEVELS[0] of them at the most."""
    levels = sorted(r._level for r in dealt.where(F.col("_level").isNotNull()).select("_level").distinct().collect())
    at = [F.struct(F.lit(k).alias("level"), F.floor(F.col(lat) / 2.0**k).alias("y"), F.floor(F.col(lng) / 2.0**k).alias("x")) for k in levels]
    placed = points.withColumn("_at", F.explode(F.array(*at))) if at else points.where("false").withColumn("_at", F.lit(None).cast("struct<level:int,y:bigint,x:bigint>"))
    placed = placed.select(*points.columns, F.col("_at.level").alias("_level"), F.col("_at.y").alias("_y"), F.col("_at.x").alias("_x"))
    if tasks:
        placed, dealt = (side.repartition(tasks, "_level", "_y", "_x") for side in (placed, dealt))
    return placed.join(dealt, ["_level", "_y", "_x"]).drop("_level", "_y", "_x")


def points_in_boxes(points: DataFrame, boxes: DataFrame, lat: str = "lat", lng: str = "lng", box=("y0", "y1", "x0", "x1"), tasks: int = 0) -> DataFrame:
    """Pairs of points and boxes (y0, y1, x0, x1, edges included) that hold them, with the columns of both.

    Boxes stand in cells of a quarter of their size, so the points of a large box are dealt over as many keys, and few of them lie beside it.
    """
    y0, y1, x0, x1 = map(F.col, box)
    return _placed(points, _dealt(boxes, box), lat, lng, tasks).where(F.col(lat).between(y0, y1) & F.col(lng).between(x0, x1))


def closed_ring(ring: Column) -> Column:
    return F.when(F.element_at(ring, 1) == F.element_at(ring, -1), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def _boxed(polygons: DataFrame, polygon_key: str) -> DataFrame:
    """The polygons' closed rings with their boxes; a table of single rings (``ring``) counts as polygons of one ring."""
    rings = F.col("rings") if "rings" in polygons.columns else F.array("ring")
    some = polygons.select(polygon_key, F.filter(rings, lambda r: F.size(r) > 0).alias("rings")).where(F.size("rings") > 0)
    axis = lambda f: F.flatten(F.transform("rings", lambda r: F.transform(r, lambda p: p[f])))
    xs, ys = axis("x"), axis("y")
    return some.select(polygon_key, F.transform("rings", closed_ring).alias("rings"), F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))


def _edges(rings: Column) -> Column:
    """The edges of closed rings, with what tests need; those without coordinates are left out."""
    pair = lambda p, q: F.struct(p["x"].alias("x"), p["y"].alias("y"), q["y"].alias("to"), (q["x"] - p["x"]).alias("dx"), (q["y"] - p["y"]).alias("dy"))
    every = F.flatten(F.transform(rings, lambda r: F.zip_with(F.slice(r, F.lit(1), F.size(r) - 1), F.slice(r, F.lit(2), F.size(r) - 1), pair)))
    return F.filter(every, lambda e: e["dx"].isNotNull() & e["dy"].isNotNull())


def _odd(edges: Column, x: Column, y: Column) -> Column:
    """Whether a ray to the east crosses an odd number of edges."""
    crossed = F.filter(edges, lambda e: ((e["y"] > y) != (e["to"] > y)) & (x < e["dx"] * (y - e["y"]) / F.nullif(e["dy"], F.lit(0.0)) + e["x"]))
    return F.size(crossed) % 2 == 1


def _touches(edges: Column, x: Column, y: Column, half: Column) -> Column:
    """Whether an edge meets the square around (x, y): neither an axis nor the edge's own direction parts them."""
    wide = half * 1.0001  # a little more, for rounding
    meets = lambda e: (F.abs(e["x"] + e["dx"] / 2 - x) <= F.abs(e["dx"]) / 2 + wide) & (F.abs(e["y"] + e["dy"] / 2 - y) <= F.abs(e["dy"]) / 2 + wide) & (F.abs(e["dx"] * (e["y"] - y) - e["dy"] * (e["x"] - x)) <= wide * (F.abs(e["dx"]) + F.abs(e["dy"])))
    return F.exists(edges, meets)


def point_in_polygon(points: DataFrame, polygons: DataFrame, point_key: str, polygon_key: str, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """(point, polygon) for points inside; polygons: key and ``ring``, an array of struct(x, y), closed or not, or ``rings``, several of them.

    With several rings the even-odd rule holds over all: what a hole's ring encloses is outside, and parts of a multipolygon may lie apart.
    A polygon stands in the cells of the level grid that it touches. A cell that no edge meets is inside as a whole, so its points are without a test, or outside, and is
    dropped; in the others points count the edges that a ray to the east crosses.
    """
    pairs = _placed(points.select(point_key, lat, lng), _polygon_cells(polygons, polygon_key), lat, lng)
    return pairs.where(F.col("_edges").isNull() | _odd(F.col("_edges"), F.col(lng), F.col(lat))).select(point_key, polygon_key)


def _polygon_cells(polygons: DataFrame, polygon_key: str) -> DataFrame:
    """(polygon_key, _edges, _level, _y, _x): the cells that a polygon touches, without edges those that lie within it as a whole."""
    boxed = _boxed(polygons, polygon_key).withColumn("_edges", _edges(F.col("rings"))).drop("rings")
    return _met(_dealt(boxed, ("y0", "y1", "x0", "x1"), wide=2)).select(polygon_key, "_edges", "_level", "_y", "_x")


def _met(cells: DataFrame) -> DataFrame:
    """The cells that the polygon of ``_edges`` meets; those within it as a whole lose their edges."""
    step = F.pow(F.lit(2.0), F.col("_level"))
    cells = cells.withColumns({"_my": (F.col("_y") + 0.5) * step, "_mx": (F.col("_x") + 0.5) * step, "_half": step / 2})
    cells = cells.withColumn("_border", _touches(F.col("_edges"), F.col("_mx"), F.col("_my"), F.col("_half")))
    cells = cells.where(F.col("_border") | _odd(F.col("_edges"), F.col("_mx"), F.col("_my"))).withColumn("_edges", F.when(F.col("_border"), F.col("_edges")))
    return cells.drop("_my", "_mx", "_half", "_border")


#: Polygons whose edges meet a cell, up to which points are tested against each; times that crowded cells are split, by FINER levels each; how many times as many entries as polygons end that early; entries that are broadcast.
EDGED, SPLITS, MOST_SPLIT, FEW_CELLS = 4, 4, 16, 100_000


def first_polygons(points: DataFrame, polygons: DataFrame, point_key: str, layer: str, polygon_key: str, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """(point, layer, polygon): of each layer's polygons that hold a point, the one of least key; polygons: layer, key and ``rings``.

    However many polygons lie over each other, a cell keeps one of those that hold it as a whole, the first, and of those whose edges meet it only the ones of lesser keys. Where
    these are still many, the cell gives way to those within. So a point meets few polygons, not all that hold it.
    Cells go from the coarsest down, and what a coarser cell keeps as its first holds for all within. A level's first ones are found before its edges are kept, so polygons that
    an earlier one covers are written for no cell: what is kept follows the number of cells, and not of polygons, where these lie thickly.
    """
    named = polygons.select(F.struct(F.col(layer).alias("layer"), F.col(polygon_key).alias("key")).alias("_polygon"), "rings")
    fit = _level(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))
    boxed = _boxed(named, "_polygon").select(F.col("_polygon.layer").alias("_layer"), F.col("_polygon.key").alias("_key"), _edges(F.col("rings")).alias("_edges"), "y0", "y1", "x0", "x1", fit.alias("_fit"))
    # Alone, a polygon is split as far as point_in_polygon deals it.
    boxed = boxed.withColumn("_until", (F.col("_fit") - F.when(F.col("_fit") >= WIDE, FINER + 2).otherwise(FINER)).cast("int")).withColumn("_level", (F.ceil(F.col("_fit") / FINER) * FINER).cast("int"))
    boxed = cut(boxed.where(F.col("_level").isNotNull()).drop("_fit"))
    own, at = ["_layer", "_key", "_edges", "_level", "_y", "_x"], ["_layer", "_y", "_x"]
    kept = [*own, "_until"]
    levels = {r._level: r["count"] for r in boxed.groupBy("_level").count().collect()}
    edges, room = boxed.schema["_edges"].dataType, sum(levels.values()) * MOST_SPLIT
    parts, firsts, split, k = [], [], None, max(levels, default=LEVELS[0])
    while levels or split is not None:
        some = split
        if levels.pop(k, 0):
            fresh = _cells(boxed.where(F.col("_level") == k), *map(F.col, ("y0", "y1", "x0", "x1", "_level"))).select(*kept).withColumn("_first", F.lit(None).cast(boxed.schema["_key"].dataType))
            for j, first in firsts:  # what coarser cells keep
                above = first.select("_layer", F.col("_y").alias("_uy"), F.col("_x").alias("_ux"), "_own")
                fresh = fresh.withColumns({"_uy": F.shiftright("_y", j - k), "_ux": F.shiftright("_x", j - k)}).join(small(above), ["_layer", "_uy", "_ux"], "left").select(*kept, F.least("_first", "_own").alias("_first"))
            some = fresh if some is None else some.unionByName(fresh)
        if some is not None:
            open_ = F.col("_first").isNull() | (F.col("_key") < F.col("_first"))
            met = _met(some.where(open_))
            whole = cut(met.where(F.col("_edges").isNull()).groupBy(*at).agg(F.min("_key").alias("_own")))
            firsts.append((k, whole))
            parts.append(whole.select("_layer", F.col("_own").alias("_key"), F.lit(None).cast(edges).alias("_edges"), F.lit(k).alias("_level"), "_y", "_x"))
            border = met.where(F.col("_edges").isNotNull()).join(small(whole), at, "left").select(*kept, F.least("_first", "_own").alias("_first"))
            border, split = cut(border.where(open_)), None
            again = F.col("_until") <= k - FINER
            if border.count() <= room:
                crowded = cut(border.groupBy(*at).count().where(F.col("count") > EDGED))
                border, again = border.join(small(crowded), at, "left"), again | (F.col("count").isNotNull() & (F.col("_until") - SPLITS * FINER < k))
            again = again & F.lit(k - FINER >= LEVELS[0])
            parts.append(border.where(~again).select(*own))
            if not border.where(again).isEmpty():
                within = lambda c: F.explode(F.sequence(F.col(c) * 2**FINER, F.col(c) * 2**FINER + (2**FINER - 1)))
                split = border.where(again).withColumn("_level", F.col("_level") - FINER).withColumn("_y", within("_y")).withColumn("_x", within("_x")).select(*kept, "_first")
        k -= FINER
    if not parts:
        return points.where("false").select(point_key, F.lit(None).cast(polygons.schema[layer].dataType).alias(layer), F.lit(None).cast(polygons.schema[polygon_key].dataType).alias(polygon_key))
    pairs = _placed(points.select(point_key, lat, lng), small(functools.reduce(DataFrame.unionByName, parts), FEW_CELLS), lat, lng)
    held = pairs.where(F.col("_edges").isNull() | _odd(F.col("_edges"), F.col(lng), F.col(lat)))
    return held.groupBy(point_key, F.col("_layer").alias(layer)).agg(F.min("_key").alias(polygon_key))


def ring_area(ring: Column) -> Column:
    """Area of a closed ring in squared degrees."""
    twice = F.aggregate(F.sequence(F.lit(2), F.size(ring)), F.lit(0.0), lambda s, i: s + F.element_at(ring, i - 1)["x"] * F.element_at(ring, i)["y"] - F.element_at(ring, i)["x"] * F.element_at(ring, i - 1)["y"])
    return F.abs(twice) / 2


def vertex_mean(ring: Column) -> Column:
    """The mean of all vertices, the closing one included: struct(x, y)."""
    mean = lambda f: F.aggregate(F.transform(ring, lambda p: p[f]), F.lit(0.0), lambda a, v: a + v) / F.size(ring)
    return F.struct(mean("x").alias("x"), mean("y").alias("y"))


def box_meets_polygon(boxes: DataFrame, rings: DataFrame, box_key: str, polygon_key: str) -> DataFrame:
    """(box, polygon) that touch: a vertex in the box, a box corner in the polygon, or crossing edges; a box within a hole touches nothing.

    Both sides stand in the cells of their own level and of the coarser ones that occur; a pair meets at the coarser of its two levels.
    boxes: lat_min, lat_max, lng_min, lng_max.
    """
    closed = _boxed(rings, polygon_key)
    sides = (boxes.withColumn("_own", _level(F.col("lat_max") - F.col("lat_min"), F.col("lng_max") - F.col("lng_min"))), closed.withColumn("_own", _level(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))))
    levels = sorted({r._own for side in sides for r in side.select("_own").distinct().collect() if r._own is not None})
    every = F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")
    rise = lambda side: side.withColumn("_level", F.explode(F.filter(every, lambda k: k >= F.col("_own"))))
    a = _cells(rise(sides[0]).withColumnRenamed("_own", "_a"), F.col("lat_min"), F.col("lat_max"), F.col("lng_min"), F.col("lng_max"), F.col("_level"))
    b = _cells(rise(sides[1]).withColumnRenamed("_own", "_b"), F.col("y0"), F.col("y1"), F.col("x0"), F.col("x1"), F.col("_level"))
    pairs = a.join(b, ["_level", "_y", "_x"]).where(F.col("_level") == F.greatest("_a", "_b"))
    pairs = pairs.where((F.col("lat_min") <= F.col("y1")) & (F.col("lat_max") >= F.col("y0")) & (F.col("lng_min") <= F.col("x1")) & (F.col("lng_max") >= F.col("x0")))
    inside = F.exists(F.flatten("rings"), lambda p: p["x"].between(F.col("lng_min"), F.col("lng_max")) & p["y"].between(F.col("lat_min"), F.col("lat_max")))
    corners = boxes.select(box_key, F.explode(F.array(*(F.struct(F.col(a).alias("lat"), F.col(b).alias("lng")) for a in ("lat_min", "lat_max") for b in ("lng_min", "lng_max")))).alias("c")).select(box_key, "c.lat", "c.lng")

    def cuts(ring, i):
        p, q = F.element_at(ring, i - 1), F.element_at(ring, i)
        at = lambda x: p["y"] + (q["y"] - p["y"]) * (x - p["x"]) / F.nullif(q["x"] - p["x"], F.lit(0.0))
        over = lambda y: p["x"] + (q["x"] - p["x"]) * (y - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0))
        sides = [F.col(c).between(F.least(p["x"], q["x"]), F.greatest(p["x"], q["x"])) & at(F.col(c)).between(F.col("lat_min"), F.col("lat_max")) for c in ("lng_min", "lng_max")]
        ends = [F.col(c).between(F.least(p["y"], q["y"]), F.greatest(p["y"], q["y"])) & over(F.col(c)).between(F.col("lng_min"), F.col("lng_max")) for c in ("lat_min", "lat_max")]
        return F.coalesce(sides[0] | sides[1] | ends[0] | ends[1], F.lit(False))

    crossing = F.exists("rings", lambda ring: F.exists(F.sequence(F.lit(2), F.greatest(F.size(ring), F.lit(2))), lambda i: (F.size(ring) > 1) & cuts(ring, i)))
    touching = pairs.where(inside | crossing).select(box_key, polygon_key)
    return touching.unionByName(point_in_polygon(corners, rings, box_key, polygon_key)).distinct()


def _segments(lines: DataFrame, metres: float, more: float, line_key: str, path: str) -> DataFrame:
    """(line, _p, _q, box): the segments with their boxes, widened by the reach and by ``more`` degrees."""
    ends = F.when(F.size(path) == 1, F.array(F.struct(F.element_at(path, 1).alias("p"), F.element_at(path, 1).alias("q")))).otherwise(F.arrays_zip(F.slice(path, F.lit(1), F.size(path) - 1).alias("p"), F.slice(path, F.lit(2), F.size(path) - 1).alias("q")))
    parts = lines.where(F.size(path) > 0).select(line_key, F.explode(ends).alias("_s")).select(line_key, F.col("_s.p").alias("_p"), F.col("_s.q").alias("_q"))
    high = F.least(F.greatest(F.abs(F.col("_p.y")), F.abs(F.col("_q.y"))) + metres / DEGREE_M, F.lit(89.0))
    up, side = F.lit(metres / DEGREE_M * 1.001 + more), metres / (DEGREE_M * F.cos(F.radians(high))) * 1.001 + more
    return parts.select(line_key, "_p", "_q", (F.least("_p.y", "_q.y") - up).alias("y0"), (F.greatest("_p.y", "_q.y") + up).alias("y1"), (F.least("_p.x", "_q.x") - side).alias("x0"), (F.greatest("_p.x", "_q.x") + side).alias("x1"))


def _segment_m(near: DataFrame, lat: str, lng: str) -> DataFrame:
    """With ``distance_m`` to the segment _p, _q. Each step is a column of its own; don't filter by it before an aggregate, as a filter repeats them all for each of their uses."""
    shrink = F.cos(F.radians(lat))
    near = near.withColumns({"_px": (F.col("_p.x") - F.col(lng)) * shrink, "_py": F.col("_p.y") - F.col(lat), "_dx": (F.col("_q.x") - F.col("_p.x")) * shrink, "_dy": F.col("_q.y") - F.col("_p.y")})
    px, py, dx, dy = map(F.col, ("_px", "_py", "_dx", "_dy"))
    near = near.withColumn("_t", F.coalesce(F.least(F.greatest(-(px * dx + py * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)), F.lit(0.0)))
    foot = near.withColumns({"_fy": F.col("_p.y") + F.col("_t") * (F.col("_q.y") - F.col("_p.y")), "_fx": F.col("_p.x") + F.col("_t") * (F.col("_q.x") - F.col("_p.x"))})
    return foot.withColumn("distance_m", haversine_m(lat, lng, "_fy", "_fx")).drop("_px", "_py", "_dx", "_dy", "_t", "_fy", "_fx")


#: Points, or cells of points, of a task that compares them with lines.
TASK_PLACES = 5_000


def line_distances(points: DataFrame, lines: DataFrame, metres: float, point_key: str, line_key: str, lat: str = "lat", lng: str = "lng", path: str = "path") -> DataFrame:
    """(point, line, distance_m) for the lines within ``metres``; lines: key and an array of struct(x, y), a single point included.

    Points meet the segments' boxes, widened by the reach, on the level grid. The foot of the perpendicular is found on the plane that
    touches the sphere at the point, and the distance to it on the sphere. All pairs are listed, so the rows grow with the product of both sides;
    ``lines_around`` counts them without.
    """
    near = points_in_boxes(points.select(point_key, lat, lng), _segments(lines, metres, 0.0, line_key, path), lat, lng, tasks=points.count() // TASK_PLACES + 1)
    far = _segment_m(near, lat, lng).groupBy(point_key, line_key).agg(F.min("distance_m").alias("distance_m"))
    return far.where(F.col("distance_m") <= metres)


#: Points of a cell, as a point sees them on average, beyond which cells are made smaller; the first are of an eighth of the reach.
CELL_POINTS = 32


def lines_around(points: DataFrame, lines: DataFrame, metres: float, point_key: str, line_key: str, lat: str = "lat", lng: str = "lng", path: str = "path") -> DataFrame:
    """(point, n, least_m, most_m): the number of lines within ``metres`` of each point, and the least and greatest of their distances, as ``line_distances``
    lists them; points without any are left out. Point keys are unique.

    Cells of points meet the lines first. A line that is within the reach of all of a cell's points counts for them as a whole; points are compared only with lines that the
    reach may part, and those that may be the nearest or the farthest. So the work for a point follows its circle's edge and not the number of lines within.
    """
    somewhere = points.select(point_key, lat, lng).where(F.col(lat).isNotNull() & F.col(lng).isNotNull())
    step, n = metres / 8 / DEGREE_M, somewhere.count()
    own = lambda step: F.struct(F.floor(F.col(lat) / step).alias("y"), F.floor(F.col(lng) / step).alias("x"))
    for _ in range(12):
        crowd = somewhere.groupBy(own(step).alias("cell")).count().agg(F.sum(F.col("count") * F.col("count")) / F.sum("count")).first()[0] or 0.0
        if crowd <= CELL_POINTS:
            break
        step /= 2
    placed = somewhere.withColumn("cell", own(step)).repartition(n // TASK_PLACES + 1, "cell")
    middle = placed.withColumns({"m_lat": (F.col("cell.y") + 0.5) * step, "m_lng": (F.col("cell.x") + 0.5) * step})
    cells = cut(middle.groupBy("cell", "m_lat", "m_lng").agg(F.max(haversine_m(lat, lng, "m_lat", "m_lng")).alias("wide")))
    parts = cut(_segments(lines, metres, step * 0.5001, line_key, path))
    single = parts.groupBy(line_key).count().where(F.col("count") > 1).isEmpty()
    tasks = cells.count() // TASK_PLACES + 1
    met = _segment_m(points_in_boxes(cells, parts, "m_lat", "m_lng", tasks=tasks), "m_lat", "m_lng").select("cell", line_key, "_p", "_q", "m_lat", "wide", F.col("distance_m").alias("_m"))
    # A foot on the plane may be farther than the nearest place of the segment: by the ratio of the parallels around, at most.
    far = (metres + 2 * F.col("wide")) * 1.05 / DEGREE_M + step
    high, low = F.abs("m_lat") + far, F.greatest(F.abs("m_lat") - far, F.lit(0.0))
    skew = F.when((high < 75.0) & (far < 1.0), F.sqrt(F.cos(F.radians(low)) / F.cos(F.radians(high)) * (1 + F.pow(F.radians(far) / F.cos(F.radians(high)), 2))))
    met = met.withColumn("_skew", skew)
    met = met.select("cell", line_key, "_p", "_q", F.coalesce(F.col("_m") / F.col("_skew") - F.col("wide") - MARGIN_M, F.lit(0.0)).alias("_lo"), F.coalesce(F.col("_skew") * (F.col("_m") + F.col("wide")) + MARGIN_M, F.lit(math.inf)).alias("_hi"))
    met = met.repartition(n // TASK_PLACES + 1, "cell")
    if single:
        met = met.withColumns({"_near": F.col("_lo"), "_far": F.col("_hi"), "_one": F.lit(1)})
    else:  # a line is as near as its nearest segment
        line = W.partitionBy("cell", line_key)
        met = met.withColumns({"_near": F.min("_lo").over(line), "_far": F.min("_hi").over(line), "_one": F.row_number().over(line.orderBy("_lo"))})
    whole, cell = F.col("_far") <= metres, W.partitionBy("cell")
    met = met.withColumns({"_whole": F.count_if(whole & (F.col("_one") == 1)).over(cell), "_least": F.min("_far").over(cell), "_most": F.max(F.when(whole, F.col("_near"))).over(cell)})
    tested = met.where((F.col("_near") <= metres) & (F.col("_lo") <= F.col("_far")) & (~whole | (F.col("_near") <= F.col("_least")) | (F.col("_far") >= F.col("_most"))))
    both = _segment_m(placed.join(tested.select("cell", line_key, "_p", "_q", "_whole", whole.alias("_in")), "cell"), lat, lng)
    if not single:
        both = both.groupBy("cell", point_key, line_key).agg(F.min("distance_m").alias("distance_m"), F.first("_whole").alias("_whole"), F.first("_in").alias("_in"))
    inside = F.when(F.col("distance_m") <= metres, F.col("distance_m"))
    found = both.groupBy("cell", point_key).agg((F.first("_whole") + F.count(F.when(~F.col("_in"), inside))).alias("n"), F.min(inside).alias("least_m"), F.max(inside).alias("most_m"))
    return found.where(F.col("n") > 0).drop("cell")


def parts_of(shapes: DataFrame) -> Column:
    """The paths of a shape: its ``rings``, or where there are none its one ``path``."""
    one = F.array("path") if "path" in shapes.columns else None
    if "rings" not in shapes.columns:
        return one
    return F.col("rings") if one is None else F.coalesce("rings", one)


def shape_distances(points: DataFrame, shapes: DataFrame, metres: float, point_key: str, shape_key: str, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """As ``line_distances`` for shapes (key, type, path or rings): a point within a polygon is at distance 0, one in a hole isn't."""
    edges = line_distances(points, shapes.select(shape_key, F.explode(parts_of(shapes)).alias("path")), metres, point_key, shape_key, lat, lng)
    polygons = shapes.where(F.col("type").isin("Polygon", "MultiPolygon")).select(shape_key, parts_of(shapes).alias("rings"))
    inside = point_in_polygon(points, polygons, point_key, shape_key, lat, lng).withColumn("distance_m", F.lit(0.0))
    return edges.unionByName(inside).groupBy(point_key, shape_key).agg(F.min("distance_m").alias("distance_m"))
