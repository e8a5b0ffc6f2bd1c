"""Feature tables of cells and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import cell_id, haversine_m
from ..operators.checkpoints import cut
from ..operators.listings import clean_listings, trim_outliers
from ..operators.lookup import small
from ..operators.nearest import nearest_shapes
from ..operators.spatial import parts_of, radius_sums

RADII = (500.0, 1000.0, 2000.0)
FRONT_M, WATER_M = 120.0, 400.0
#: Cells, of some 70 bytes, whose features are broadcast.
CELLS_SMALL = 1_000_000


def cell_representatives(cells: DataFrame) -> DataFrame:
    """One point for each grid cell: its first population row by id."""
    return cells.withColumn("cell", cell_id("lat", "lng")).groupBy("cell").agg(F.min(F.struct("id", "lat", "lng")).alias("p")).select("cell", "p.lat", "p.lng")


def cell_features(representatives: DataFrame, layers: dict[str, DataFrame]) -> DataFrame:
    """Distances from each cell to the nearest shape of each layer (id, type, and path or rings), null only where a layer has none.

    All layers are searched in one descent, nearest in plane degrees. The flags frente_avenida and cerca_agua belong to layers named dist_via_principal_m and dist_agua_m.
    """
    representatives, every = cut(representatives), None
    for name, layer in layers.items():
        part = layer.select(F.lit(name).alias("layer"), F.col("id").cast("string").alias("id"), "type", parts_of(layer).alias("rings"))
        every = part if every is None else every.unionByName(part)
    near = nearest_shapes(representatives, cut(every), "cell")
    wide = near.groupBy("cell").agg(*(F.max(F.when(F.col("layer") == name, F.col("distance_m"))).alias(name) for name in layers))
    out = representatives.join(wide, "cell", "left")
    flag = lambda c, m: F.coalesce(F.col(c) < m, F.lit(False)) if c in layers else F.lit(False)
    return out.withColumn("frente_avenida", flag("dist_via_principal_m", FRONT_M)).withColumn("cerca_agua", flag("dist_agua_m", WATER_M))


def layer_features(representatives: DataFrame, layers: dict[str, DataFrame]) -> DataFrame:
    """``cell_features`` of the map's layers: roads, parks, water, and of the equipment the hospitals and universities."""
    of = lambda kind: layers["equipamiento"].where(F.col("amenity") == kind)
    return cell_features(representatives, {"dist_via_principal_m": layers["vias"], "dist_parque_m": layers["parques"], "dist_agua_m": layers["agua"], "dist_hospital_m": of("hospital"), "dist_universidad_m": of("university")})


def _people(cells: DataFrame) -> DataFrame:
    return cells.select("id", "population", F.col("lat").alias("r_lat"), F.col("lng").alias("r_lng"))


def _active(business: DataFrame) -> DataFrame:
    return business.where("is_active").select("id", F.lit(1).cast("bigint").alias("one"), F.col("lat").alias("r_lat"), F.col("lng").alias("r_lng"))


def population_radii(listings: DataFrame, cells: DataFrame) -> DataFrame:
    value = F.col("population")
    return radius_sums(listings, _people(cells), {f"pob_{int(m)}": (value, m) for m in RADII})


def business_radii(listings: DataFrame, business: DataFrame) -> DataFrame:
    value = F.col("one")
    return radius_sums(listings, _active(business), {f"neg_{int(m)}": (value, m) for m in RADII})


def _all_radii(listings: DataFrame, cells: DataFrame, business: DataFrame) -> DataFrame:
    """People and businesses in one pass, so the listings' places are dealt, and their sums met with them, once."""
    people, active = _people(cells), _active(business)
    both = people.withColumn("id", F.col("id").cast("bigint")).unionByName(active.withColumn("id", F.col("id").cast("bigint")), allowMissingColumns=True)
    values = {"pop": F.col("population"), "biz": F.col("one")}
    return radius_sums(listings, both, {f"{kind}_{name}": (value, m) for kind, value in values.items() for m, name in zip(RADII, ("500m", "1km", "2km"))})


def listing_features(listings: DataFrame, cells: DataFrame, business: DataFrame, by_cell: DataFrame, centre: tuple[float, float]) -> DataFrame:
    """The table that the price model is fitted on: clean listings (priced in ``precio_usd``) with usd_m2, what their cell knows of the map, people and businesses in three radii, and
    kilometres to the centre; without the cheapest and the dearest hundredth by usd_m2. A listing whose cell ``by_cell`` lacks has no map features.
    """
    base = clean_listings(listings).where(F.col("precio_usd") > 0)
    base = base.withColumn("usd_m2", F.floor(F.col("precio_usd") / F.col("superficie_m2") * 100 + 0.5) / 100).withColumn("cell", cell_id("lat", "lng"))
    both = _all_radii(trim_outliers(base, "usd_m2"), cells, business).join(small(cut(by_cell.drop("lat", "lng")), CELLS_SMALL), "cell", "left")
    return both.withColumn("dist_asuncion_km", F.floor(haversine_m("lat", "lng", *centre) / 10 + 0.5) / 100)
