"""Raw records to business records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import CATEGORY_PARTS, category_by_part, clean_name, coordinates, place_id


def normalize(raw: DataFrame, categories=CATEGORY_PARTS) -> DataFrame:
    """Cleans names, takes coordinates from the fields if both are numbers, else from the link, and drops rows without a name or a place.

    raw: name, lat, lng (strings or numbers), category, address, source_url, search_category.
    """
    pair = F.struct(F.col("lat").cast("string").try_cast("double").alias("lat"), F.col("lng").cast("string").try_cast("double").alias("lng"))
    at = F.when(pair["lat"].isNotNull() & pair["lng"].isNotNull(), pair).otherwise(coordinates(F.col("source_url")))
    rows = raw.withColumn("raw_name", F.col("name")).withColumn("name", clean_name(F.col("name"))).withColumn("_at", at)
    kept = rows.where((F.col("name") != "") & F.col("_at.lat").isNotNull() & F.col("_at.lng").isNotNull())
    return (
        kept.withColumn("lat", F.col("_at.lat")).withColumn("lng", F.col("_at.lng")).withColumn("category", category_by_part(F.col("category"), categories)).withColumn("google_place_id", place_id(F.col("source_url"))).drop("_at")
    )
