"""What is around a point: population, businesses, types, places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_m, in_box, within
from ..functions.shapes import area as shape_area
from ..functions.shapes import bounds, geojson_of_shape
from ..functions.text import same_name, unaccented
from ..operators.checkpoints import cut
from ..operators.nearest import nearest_shapes
from ..operators.spatial import parts_of, point_in_polygon

NO_CATEGORY = "Sin clasificar"
TYPES_M, TYPES_LEAST = 2000.0, 0.5
LIST_ROWS = 20_000


def population(cells: DataFrame, lat: float, lng: float, metres: float) -> DataFrame:
    return cells.where(within("lat", "lng", lat, lng, metres)).agg(F.coalesce(F.sum("population"), F.lit(0.0)).alias("population"))


def total(business: DataFrame, lat: float, lng: float, metres: float) -> DataFrame:
    return business.where(F.col("is_active") & within("lat", "lng", lat, lng, metres)).agg(F.count("*").alias("total"))


def by_category(business: DataFrame, lat: float, lng: float, metres: float) -> DataFrame:
    """Active businesses by category, the most frequent first."""
    near = business.where(F.col("is_active") & within("lat", "lng", lat, lng, metres))
    return near.groupBy(F.coalesce("business_category", F.lit(NO_CATEGORY)).alias("category")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "category")


def top_types(business: DataFrame, lat: float, lng: float, k: int = 10, metres: float = TYPES_M) -> DataFrame:
    """The k most frequent types among businesses of certain category, always within the same radius."""
    near = business.where(F.col("is_active") & (F.col("category_confidence") >= TYPES_LEAST) & within("lat", "lng", lat, lng, metres))
    return near.groupBy("business_type", "business_category").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col("business_type").asc_nulls_last(), F.col("business_category").asc_nulls_last()).limit(k)


def ratio(business: DataFrame, cells: DataFrame, lat: float, lng: float, metres: float) -> DataFrame:
    """Businesses per 1000 inhabitants, 0 where nobody lives."""
    both = total(business, lat, lng, metres).join(population(cells, lat, lng, metres))
    return both.select("total", "population", F.when(F.col("population") > 0, F.floor(F.col("total") * 1000 / F.col("population") * 100 + 0.5) / 100).otherwise(0.0).alias("per_1000"))


def nearest_list(business: DataFrame, lat: float, lng: float, metres: float, k: int = LIST_ROWS) -> DataFrame:
    """The k nearest active businesses; a top-k report."""
    near = business.where(F.col("is_active") & in_box("lat", "lng", lat, lng, metres)).withColumn("distance_m", haversine_m("lat", "lng", lat, lng)).where(F.col("distance_m") <= metres)
    return near.orderBy("distance_m", "id").limit(k).select("id", "name", "distance_m")


#: How far a road with a name may be to stand for a nearer one without (fixed values), and the labels where none is.
NAMED_M, LABEL = 1000.0, "Via sin nombre"
PRINCIPAL_NAMED_M, PRINCIPAL_LABEL = 3000.0, "Vía principal sin nombre"
#: Kinds of principal roads (fixed values).
PRINCIPAL = ("motorway", "trunk", "primary", "secondary", "tertiary")


def nearest_named(points: DataFrame, shapes: DataFrame, key: str = "id", named_m: float = NAMED_M, label: str = LABEL) -> DataFrame:
    """(key, name, kind, distance_m): the nearest shape at any distance if it has a name; else the nearest named one within ``named_m``; else
    the nearest with a label of its kind. shapes: shape, name (null or empty if it has none), kind, type, and path or rings."""
    own = shapes.select("shape", F.nullif("name", F.lit("")).alias("name"), "kind", "type", parts_of(shapes).alias("rings"))
    about = own.select("shape", "name", "kind")
    near = cut(nearest_shapes(points, own.withColumn("layer", F.lit(0)), key, "shape", sphere=True).drop("layer").join(about, "shape").select(key, "name", "kind", "distance_m"))
    rest = points.join(near.where(F.col("name").isNull()).select(key), key, "left_semi")
    # Only the nearest named shape counts, so another descent finds it, whatever the number of those within ``named_m``.
    named = nearest_shapes(rest, own.where(F.col("name").isNotNull()).withColumn("layer", F.lit(0)), key, "shape", sphere=True).where(F.col("distance_m") <= named_m)
    named = named.select(key, "shape", F.col("distance_m").alias("n_distance")).join(about.withColumnsRenamed({"name": "n_name", "kind": "n_kind"}), "shape").drop("shape")
    both = near.join(named, key, "left")
    pick = lambda c: F.when(F.col("n_name").isNotNull(), F.col(f"n_{c}")).otherwise(F.col(c))
    return both.select(key, F.coalesce("name", "n_name", F.concat(F.lit(f"{label} ("), F.col("kind"), F.lit(")"))).alias("name"), pick("kind").alias("kind"), F.when(F.col("n_name").isNotNull(), F.col("n_distance")).otherwise(F.col("distance_m")).alias("distance_m"))


def principal_road(points: DataFrame, roads: DataFrame, by_cell: DataFrame | None = None, key: str = "id") -> DataFrame:
    """(key, nombre, tipo, distancia_m); roads: road, name, highway, path.

    The nearest principal road if it has a name; else the nearest named one within 3000 m; else the nearest with a label; and for points that have
    none, as where no road is principal, the distance that by_cell (key, dist_via_principal_m) knows, without name and kind.
    """
    principal = roads.where(F.col("highway").isin(*PRINCIPAL)).select(F.col("road").alias("shape"), "name", F.col("highway").alias("kind"), F.lit("LineString").alias("type"), "path")
    found = nearest_named(points, principal, key, PRINCIPAL_NAMED_M, PRINCIPAL_LABEL).select(key, F.col("name").alias("nombre"), F.col("kind").alias("tipo"), F.col("distance_m").alias("distancia_m"))
    if by_cell is not None:
        rest = by_cell.join(found, key, "left_anti").where(F.col("dist_via_principal_m").isNotNull())
        found = found.unionByName(rest.select(key, F.lit(None).cast("string").alias("nombre"), F.lit(None).cast("string").alias("tipo"), F.col("dist_via_principal_m").alias("distancia_m")))
    return found.withColumn("distancia_m", F.floor(F.col("distancia_m") * 10 + 0.5) / 10)


#: Order in which boundaries name a city (fixed values).
CITY_ORDER = (("admin_level", "8"), ("admin_level", "9"), ("place", "city"), ("place", "town"))


def city_of(points: DataFrame, boundaries: DataFrame, point_key: str = "id") -> DataFrame:
    """(point, city): of the boundaries that hold a point, the first by CITY_ORDER; then by name. Other boundaries come last."""
    rank = F.coalesce(*(F.when(F.col(c) == v, F.lit(k)) for k, (c, v) in enumerate(CITY_ORDER)), F.lit(len(CITY_ORDER)))
    held = point_in_polygon(points, boundaries.select("boundary", "rings" if "rings" in boundaries.columns else "ring"), point_key, "boundary").join(boundaries.select("boundary", "name", rank.alias("rank")), "boundary")
    return held.groupBy(point_key).agg(F.min_by("name", F.struct("rank", "name")).alias("city"))


def largest_named(boundaries: DataFrame, name: str | None = None, admin_level: str | None = None) -> DataFrame:
    """Of the polygons of a name, the one of largest area (the first by id of equals): id, name, admin_level, geojson, box and area; one for each name if none is given.

    Names are equal but for case and accents. boundaries: id, name, admin_level, type, and rings or path; other geometries than polygons don't count.
    """
    some = boundaries.where(F.col("type").isin("Polygon", "MultiPolygon"))
    some = some if name is None else some.where(same_name(F.col("name"), F.lit(name)))
    some = some if admin_level is None else some.where(F.col("admin_level") == admin_level)
    sized = some.withColumn("rings", parts_of(some)).withColumn("area", shape_area(F.col("rings")))
    best = sized.groupBy(unaccented(F.col("name")).alias("_name")).agg(F.min(F.struct((-F.col("area")).alias("area"), "id", "name", "admin_level", "type", "rings")).alias("b")).where(F.col("_name") != "")
    b = lambda c: F.col(f"b.{c}")
    return best.select(b("id").alias("id"), b("name").alias("name"), b("admin_level").alias("admin_level"), geojson_of_shape(b("type"), b("rings")).alias("geojson"), bounds(b("rings")).alias("box"), (-b("area")).alias("area"))
