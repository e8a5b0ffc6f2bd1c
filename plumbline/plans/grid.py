"""The search plan: grid cells times categories, split where a search overflows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import KM_PER_DEGREE, haversine_m, quadrants
from ..operators.checkpoints import cut
from ..operators.spatial import box_meets_polygon, knn_join, points_in_boxes

RESULT_CAP = 120
METRO_KM, METRO_FACTOR = 25.0, 0.1
CELL = "struct<lat_min:double,lat_max:double,lng_min:double,lng_max:double>"


def grid_cells(spark: SparkSession, lat_min: float, lat_max: float, lng_min: float, lng_max: float, cell_km: float) -> DataFrame:
    """Rows of cells from the south-west; a row's width in degrees follows its own latitude. Steps are multiplied, not added up."""
    dy = cell_km / KM_PER_DEGREE
    rows = spark.range(max(0, math.ceil((lat_max - lat_min) / dy - 1e-9))).select(F.col("id").alias("row"), (F.lit(lat_min) + F.col("id") * F.lit(dy)).alias("y"))
    rows = rows.withColumn("dx", cell_km / (KM_PER_DEGREE * F.cos(F.radians("y")))).withColumn("n", F.ceil((lng_max - lng_min) / F.col("dx") - 1e-9))
    cells = rows.where("n > 0").select("row", "y", "dx", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("col"))
    return cells.select("row", "col", F.col("y").alias("lat_min"), F.least(F.col("y") + dy, F.lit(lat_max)).alias("lat_max"), (F.lit(lng_min) + F.col("col") * F.col("dx")).alias("lng_min"), F.least(F.lit(lng_min) + (F.col("col") + 1) * F.col("dx"), F.lit(lng_max)).alias("lng_max"))


def cell_of_point(lat: Column, lng: Column, lat_min: float, lat_max: float, lng_min: float, lng_max: float, cell_km: float) -> Column:
    """struct(row, col, cell fields) of the grid's cell that a point lies in; null outside the box. Points on the last edges belong to the last cells."""
    dy, dx_km = cell_km / KM_PER_DEGREE, cell_km
    rows = max(1, math.ceil((lat_max - lat_min) / dy - 1e-9))
    row = F.least(F.floor((lat - lat_min) / dy), F.lit(rows - 1)).cast("bigint")
    south = F.lit(lat_min) + row * F.lit(dy)
    dx = dx_km / (KM_PER_DEGREE * F.cos(F.radians(south)))
    col = F.least(F.floor((lng - lng_min) / dx), F.greatest(F.ceil((lng_max - lng_min) / dx - 1e-9) - 1, F.lit(0))).cast("bigint")
    west = F.lit(lng_min) + col * dx
    cell = F.struct(row.alias("row"), col.alias("col"), south.alias("lat_min"), F.least(south + dy, F.lit(lat_max)).alias("lat_max"), west.alias("lng_min"), F.least(F.lit(lng_min) + (col + 1) * dx, F.lit(lng_max)).alias("lng_max"))
    return F.when(lat.between(lat_min, lat_max) & lng.between(lng_min, lng_max), cell)


def priorities(cells: DataFrame, districts: DataFrame, metros: DataFrame) -> DataFrame:
    """Adds ``priority``: kilometres to the nearest district, a tenth of it within 25 km of a metro; 0 without districts.

    districts and metros (name, lat, lng) are lookup tables of a country and are broadcast as arrays, if they have at most
    LOOKUP_SPOTS rows each; larger ones are searched by bucket joins.
    """
    centre = cells.withColumn("_y", (F.col("lat_min") + F.col("lat_max")) / 2).withColumn("_x", (F.col("lng_min") + F.col("lng_max")) / 2)
    both = _nearest_km(_nearest_km(centre, districts, "_d"), metros, "_m")
    near = F.coalesce(F.col("_m") <= METRO_KM, F.lit(False))
    km = F.coalesce("_d", F.lit(0.0)) * F.when(near, METRO_FACTOR).otherwise(1.0)
    return both.withColumn("priority", F.floor(km * 100 + 0.5) / 100).drop("_y", "_x", "_d", "_m")


#: Rows of a table of places that goes to all tasks as one array, of 16 bytes each.
LOOKUP_SPOTS = 20_000


def _nearest_km(centre: DataFrame, spots: DataFrame, name: str) -> DataFrame:
    """Adds the kilometres from (_y, _x) to the nearest spot; null without any."""
    if spots.limit(LOOKUP_SPOTS + 1).count() <= LOOKUP_SPOTS:
        held = spots.agg(F.collect_list(F.struct("lat", "lng")).alias("_s"))
        least = F.array_min(F.transform("_s", lambda p: haversine_m(F.col("_y"), F.col("_x"), p["lat"], p["lng"]) / 1000))
        return centre.join(F.broadcast(held)).withColumn(name, least).drop("_s")
    at = F.struct("_y", "_x")
    points = spots.select(F.monotonically_increasing_id().alias("_p"), F.col("lat").alias("r_lat"), F.col("lng").alias("r_lng"))
    places = centre.select(at.alias("_q"), F.col("_y").alias("lat"), F.col("_x").alias("lng")).distinct()
    near = knn_join(places, points, 1, METRO_KM * 1000, "_q", "_p").select("_q", (F.col("distance_m") / 1000).alias(name))
    return centre.withColumn("_q", at).join(near, "_q", "left").drop("_q")


def tasks(cells: DataFrame, categories: list[str]) -> DataFrame:
    """Each cell with each category, in order of priority."""
    names = F.array(*(F.struct(F.lit(k).alias("category_pos"), F.lit(c).alias("category")) for k, c in enumerate(categories)))
    every = cells.withColumn("_c", F.explode(names)).select(*cells.columns, "_c.category_pos", "_c.category")
    return every.orderBy("priority", "lat_min", "lng_min", "category_pos")


def split_overflow(cells: DataFrame, points: DataFrame, max_depth: int, cap: int = RESULT_CAP) -> DataFrame:
    """(cell fields, depth, n): cells with ``cap`` points or more are quartered until max_depth. Cells are half open.

    Points find their cell once, by an equi-join on the level grid; below it the quarter is arithmetic on the
    cell itself, so each depth is one count and one join by cell. The state of each depth is checkpointed.
    """
    box = ("lat_min", "lat_max", "lng_min", "lng_max")
    roots = cells.select(*box)
    held = points_in_boxes(points.select("lat", "lng"), roots, box=box).where((F.col("lat") < F.col("lat_max")) & (F.col("lng") < F.col("lng_max")))
    rooted = cut(held.select("lat", "lng", F.struct(*box).alias("cell")))
    here, done = roots.select(F.struct(*box).alias("cell")), None
    for depth in range(max_depth + 1):
        counts = rooted.groupBy("cell").agg(F.count("*").alias("n"))
        counted = cut(here.join(counts, "cell", "left").select("cell", F.coalesce("n", F.lit(0)).alias("n")))
        split = (F.col("n") >= cap) & F.lit(depth < max_depth)
        kept = counted.where(~split).select("cell.*", F.lit(depth).alias("depth"), "n")
        done = kept if done is None else done.unionByName(kept)
        over = counted.where(split).select("cell")
        if depth == max_depth or over.isEmpty():
            break
        here = over.select(F.explode(quadrants(F.col("cell"))).alias("cell"))
        middle = lambda a, b: (F.col(f"cell.{a}") + F.col(f"cell.{b}")) / 2
        quarter = F.element_at(quadrants(F.col("cell")), (F.when(F.col("lat") >= middle("lat_min", "lat_max"), 2).otherwise(0) + F.when(F.col("lng") >= middle("lng_min", "lng_max"), 1).otherwise(0) + 1).cast("int"))
        rooted = cut(rooted.join(over, "cell", "left_semi").select("lat", "lng", quarter.alias("cell")))
    return done


def circle_grid(spark: SparkSession, lat: float, lng: float, radius_km: float, cell_km: float) -> DataFrame:
    """(row, col, cell fields) of the cells over the square around a point whose centres lie within the radius and one cell's width."""
    dy, span = cell_km / KM_PER_DEGREE, radius_km / KM_PER_DEGREE
    rows = spark.range(math.ceil(2 * span / dy - 1e-9)).select(F.col("id").alias("row"), (F.lit(lat - span) + F.col("id") * F.lit(dy)).alias("lat_min"))
    per_degree = KM_PER_DEGREE * F.cos(F.radians("lat_min"))
    rows = rows.withColumn("dx", cell_km / per_degree).withColumn("west", F.lit(lng) - radius_km / per_degree)
    n = math.ceil(2 * radius_km / cell_km - 1e-9)
    cells = rows.select("row", "lat_min", "dx", "west", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))).alias("col"))
    cells = cells.select("row", "col", "lat_min", (F.col("lat_min") + dy).alias("lat_max"), (F.col("west") + F.col("col") * F.col("dx")).alias("lng_min"), (F.col("west") + (F.col("col") + 1) * F.col("dx")).alias("lng_max"))
    centre = ((F.col("lat_min") + F.col("lat_max")) / 2, (F.col("lng_min") + F.col("lng_max")) / 2)
    return cells.where(haversine_m(F.lit(lat), F.lit(lng), *centre) <= (radius_km + cell_km) * 1000)


def expand_to_depth(cells: DataFrame, depth: int, inside: DataFrame | None = None) -> DataFrame:
    """The cells (cell fields) quartered ``depth`` times; after each time those that touch no ring of ``inside`` (boundary, ring) go."""
    box = ("lat_min", "lat_max", "lng_min", "lng_max")
    now = cells.select(*box)
    for _ in range(depth):
        now = now.select(F.explode(quadrants(F.struct(*box))).alias("c")).select("c.*")
        if inside is not None:
            named = now.withColumn("_cell", F.struct(*box))
            now = now.join(box_meets_polygon(named, inside, "_cell", "boundary").select("_cell").distinct(), F.struct(*box) == F.col("_cell"), "left_semi")
    return now


def cell_key() -> Column:
    """The cell's name: a JSON record of its four bounds in order of their names."""
    return F.to_json(F.struct(*(F.col(c) for c in ("lat_max", "lat_min", "lng_max", "lng_min"))))


def cell_of_key(key: Column) -> Column:
    """struct(cell fields) of a cell's name; null if it is none."""
    cell = F.from_json(key, "lat_max double, lat_min double, lng_max double, lng_min double")
    return F.when(cell["lat_max"].isNotNull() & cell["lat_min"].isNotNull() & cell["lng_max"].isNotNull() & cell["lng_min"].isNotNull(), cell)


def finished_tasks(tasks: DataFrame, limit: int = 0) -> DataFrame:
    """The distinct (cell, category) of completed tasks in order; the first ``limit`` if that isn't 0."""
    done = tasks.where(F.col("status") == "completed").select("cell", "category").distinct().orderBy("cell", "category")
    return done.limit(limit) if limit else done


def circle_grids(centres: DataFrame, radius_km: float, cell_km: float) -> DataFrame:
    """``circle_grid`` around each row of ``centres`` (id, lat, lng): id, row, col, cell fields."""
    dy, span = cell_km / KM_PER_DEGREE, radius_km / KM_PER_DEGREE
    n_rows, n = math.ceil(2 * span / dy - 1e-9), math.ceil(2 * radius_km / cell_km - 1e-9)
    steps = lambda k: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint")))
    rows = centres.select("id", "lat", "lng", steps(n_rows).alias("row")).withColumn("lat_min", F.col("lat") - span + F.col("row") * F.lit(dy))
    rows = rows.withColumn("_d", KM_PER_DEGREE * F.cos(F.radians("lat_min"))).withColumn("col", steps(n))
    west = lambda k: F.col("lng") - radius_km / F.col("_d") + (F.col("col") + k) * (cell_km / F.col("_d"))
    cells = rows.select("id", "lat", "lng", "row", "col", "lat_min", (F.col("lat_min") + dy).alias("lat_max"), west(0).alias("lng_min"), west(1).alias("lng_max"))
    centre = ((F.col("lat_min") + F.col("lat_max")) / 2, (F.col("lng_min") + F.col("lng_max")) / 2)
    return cells.where(haversine_m("lat", "lng", *centre) <= (radius_km + cell_km) * 1000).drop("lat", "lng")
