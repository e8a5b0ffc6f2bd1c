"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .checkpoints import cut


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b: bigint): nodes that a path joins share a root, which is one of them.

    Each round every node falls to the neighbour that comes first in an order drawn anew for the round, itself included; its edges go along, so what was connected
    stays connected, and the graph shrinks by a constant share of its nodes, chains and stars alike. Without edges left, a component has one name.
    """
    both = cut(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    roots, step = None, 0
    while not both.isEmpty():
        drawn = lambda c, k=step: F.struct(F.xxhash64(F.lit(k), c).alias("h"), F.col(c).alias("v"))
        ways = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        falls = cut(ways.groupBy(F.col("a").alias("node")).agg(F.least(F.min(drawn("b")), F.first(drawn("a"))).alias("to")).select("node", F.col("to.v").alias("to")))
        if roots is None:
            roots = falls.select("node", F.col("to").alias("root"))
        else:
            roots = cut(roots.join(falls.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        at = lambda c: falls.select(F.col("node").alias(c), F.col("to").alias(f"_{c}"))
        both = cut(both.join(at("a"), "a").join(at("b"), "b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).where("a != b").distinct())
        step += 1
    return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0) if roots is None else roots
