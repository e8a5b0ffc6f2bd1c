"""Coverage against a reference report: which of its places does the table have?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_alnum
from .spatial import radius_join

NEAR_M, NAMED_M = 25.0, 70.0
#: Degrees around the report's points within which stored rows count.
MARGIN = 0.02
PREFIX, NAME_LEAST = 8, 5


def classify_gap(report: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """Adds ``found``: near (a row within 25 m), near_name (within 70 m, and the names begin with the same eight letters or one holds
    the other), name (an equal name of five letters or more anywhere in the report's box) or missing."""
    a = report.withColumn("_n", norm_alnum(F.col("name")))
    box = report.agg(*(f(c).alias(f"{n}_{c}") for c in ("lat", "lng") for n, f in (("min", F.min), ("max", F.max))))
    inside = [F.col(c).between(F.col(f"min_{c}") - MARGIN, F.col(f"max_{c}") + MARGIN) for c in ("lat", "lng")]
    near_by = stored.join(F.broadcast(box), inside[0] & inside[1])  # one row
    b = near_by.select(F.col("lat").alias("r_lat"), F.col("lng").alias("r_lng"), norm_alnum(F.col("name")).alias("_m"))
    n, m = F.col("_n"), F.col("_m")
    similar = (n != "") & (m != "") & ((F.left(n, F.lit(PREFIX)) == F.left(m, F.lit(PREFIX))) | F.contains(m, n) | F.contains(n, m))
    close = radius_join(a.select(key, "_n", "lat", "lng"), b, NAMED_M).groupBy(key).agg(F.bool_or(F.col("distance_m") <= NEAR_M).alias("near"), F.bool_or(similar).alias("alike"))
    names = b.where(F.length("_m") >= NAME_LEAST).select(F.col("_m").alias("_n")).distinct().withColumn("same", F.lit(True))
    joined = a.join(close, key, "left").join(names, "_n", "left")
    found = F.when(F.col("near"), "near").when(F.col("alike"), "near_name").when(F.col("same"), "name").otherwise("missing")
    return joined.withColumn("found", found).select(*report.columns, "found")
