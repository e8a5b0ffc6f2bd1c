"""Lookup tables: broadcast if they are as small as they should be."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of some 100 bytes each.
MOST_ROWS = 300_000


def small(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """With a broadcast hint if the table has at most so many rows, counted before; else as it is, to be shuffled."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
