"""Row numbers over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .checkpoints import cut


def numbered(df: DataFrame, order: list, name: str = "_i", total: str | None = None) -> DataFrame:
    """Adds the row's number in an order, from 0, and on request the number of all rows.

    Rows are sorted in ranges and numbered within them; a range's offset is the count of those before it, so no task sees all rows.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # a row for each range
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("_total", F.sum("_n").over(W.partitionBy()))
    placed = ranged.join(F.broadcast(before.drop("_n")), "_range").withColumn(name, F.col("_before") + F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1)
    return placed.select(*df.columns, name, *([F.col("_total").alias(total)] if total else []))
