"""Dedup of records: by key, by name, and by greedy proximity."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geo import DEGREE_M, RADIUS_M, haversine_m
from .checkpoints import cut
from .lookup import MOST_ROWS


def first_by(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in an order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("_n") == 1).drop("_n")


def dedup_exact_name(df: DataFrame, name: str = "name", seq: str = "id") -> DataFrame:
    """One row for each name (trimmed, lower-cased): the longest spelling, the first of equals. Distance plays no part."""
    return first_by(df, [F.lower(F.trim(F.col(name)))], [F.length(name).desc(), seq])


def _tiles(df: DataFrame, metres: float, lat: str, lng: str) -> DataFrame:
    """Adds the tile (ty, tx) of a point: so small that any two points in one are nearer to each other than ``metres``."""
    height = metres / DEGREE_M / math.sqrt(2) * 0.999
    row = F.floor(F.col(lat) / height)
    return df.withColumn("ty", row).withColumn("tx", F.floor((F.col(lng) + 180.0) / 360.0 * _tiles_of(row, height)).cast("bigint"))


def _tiles_of(row: Column, height: float) -> Column:
    """Tiles of a row around the globe: none is wider at its wide end than a tile is high."""
    wide = F.cos(F.radians(F.least(F.when(row >= 0, row * height).otherwise(-(row + 1) * height), F.lit(90.0))))
    return F.greatest(F.ceil(360.0 * wide / height), F.lit(1)).cast("bigint")


#: More than there are tiles near one, but for the poles, where a row has few.
NEAR_TILES = 40


def _with_near_tiles(df: DataFrame, metres: float) -> DataFrame:
    """A row for each tile (ty, tx) that has points within ``metres`` of some place in the row's own tile; some thirty of them."""
    height = metres / DEGREE_M / math.sqrt(2) * 0.999
    sine = math.sin(min(math.pi / 2, metres / RADIUS_M / 2))
    rows = df.withColumn("_own", _tiles_of(F.col("ty"), height)).withColumn("_y", F.explode(F.sequence(F.col("ty") - 2, F.col("ty") + 2)))
    far = F.least(F.greatest(F.abs("ty"), F.abs(F.col("ty") + 1), F.abs("_y"), F.abs(F.col("_y") + 1)) * height, F.lit(90.0))
    rows = rows.withColumn("_n", _tiles_of(F.col("_y"), height)).withColumn("_reach", F.degrees(2 * F.asin(F.least(sine / F.greatest(F.cos(F.radians(far)), F.lit(1e-12)), F.lit(1.0)))) * 1.001)
    rows = rows.withColumn("_a", F.floor((F.col("tx") * 360.0 / F.col("_own") - F.col("_reach")) / 360.0 * F.col("_n"))).withColumn("_b", F.floor(((F.col("tx") + 1) * 360.0 / F.col("_own") + F.col("_reach")) / 360.0 * F.col("_n")))
    rows = rows.withColumn("_x", F.explode(F.sequence(F.col("_a"), F.least("_b", F.col("_a") + F.col("_n") - 1))))
    return rows.withColumn("ty", F.col("_y")).withColumn("tx", F.pmod("_x", "_n")).select(*df.columns)


def proximity_clusters(df: DataFrame, metres: float, seq: str = "id", lat: str = "lat", lng: str = "lng") -> DataFrame:
    """(seq, seed) by the greedy rule: in order of seq (unique), a row that no earlier seed is nearer to than ``metres`` is a seed itself;
    any other joins its first seed. Rows without coordinates are seeds.

    Rounds find the seeds in parallel: the first open row of a tile is a seed if no tile around has an earlier one, and rows near a new seed are settled. Rows are compared
    to seeds only, of which a tile holds one at most, so the work grows with the rows however dense they lie, and no list of neighbours is made. There are as many rounds as
    the longest chain of ever earlier neighbours, a few for ids that don't follow the map.
    """
    points = _tiles(df.where(F.col(lat).isNotNull() & F.col(lng).isNotNull()).select(F.col(seq).alias("v"), F.col(lat).cast("double").alias("lat"), F.col(lng).cast("double").alias("lng")), metres, "lat", "lng")
    reach = lambda some, n: (F.broadcast if NEAR_TILES * n <= MOST_ROWS else lambda df: df)(_with_near_tiles(some.select("ty", "tx", F.col("v").alias("seed"), F.col("lat").alias("s_lat"), F.col("lng").alias("s_lng")), metres))
    open_, seeds, found = cut(points), None, 0
    while not open_.isEmpty():
        firsts = open_.groupBy("ty", "tx").agg(F.min(F.struct("v", "lat", "lng")).alias("p")).select("ty", "tx", "p.*")
        around = _with_near_tiles(firsts.select("ty", "tx", "v"), metres).groupBy("ty", "tx").agg(F.min("v").alias("least"))
        new = cut(firsts.join(around, ["ty", "tx"]).where(F.col("v") == F.col("least")).drop("least"))
        seeds = new if seeds is None else seeds.unionByName(new)
        n = new.count()
        found += n
        near = open_.join(reach(new, n), ["ty", "tx"]).where((F.col("v") == F.col("seed")) | (haversine_m("lat", "lng", "s_lat", "s_lng") < metres)).select("v").distinct()
        open_ = cut(open_.join(near, "v", "left_anti"))
    ids = df.select(F.col(seq).alias("v"))
    if seeds is None:
        return ids.select(F.col("v").alias(seq), F.col("v").alias("seed"))
    near = points.join(reach(seeds, found), ["ty", "tx"]).where((F.col("seed") < F.col("v")) & (haversine_m("lat", "lng", "s_lat", "s_lng") < metres))
    joined = near.groupBy(F.col("v").alias("hi")).agg(F.min("seed").alias("seed"))
    return ids.join(joined, F.col("v") == F.col("hi"), "left").select(F.col("v").alias(seq), F.coalesce("seed", "v").alias("seed"))


def dedup_proximity(df: DataFrame, metres: float = 50.0, name: str = "name", seq: str = "id", **where) -> DataFrame:
    """The row of the longest name of each greedy cluster, the first of equals."""
    clusters = proximity_clusters(df, metres, seq, **where).withColumnRenamed(seq, "_seq")
    return first_by(df.join(clusters, F.col(seq) == F.col("_seq")).drop("_seq"), ["seed"], [F.length(name).desc(), seq]).drop("seed")


def deduplicate(df: DataFrame, metres: float = 50.0, name: str = "name", seq: str = "id", **where) -> DataFrame:
    """By exact name, then by proximity."""
    return dedup_proximity(dedup_exact_name(df, name, seq), metres, name, seq, **where)
