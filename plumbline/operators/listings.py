"""Cleaning and pricing of real-estate listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checkpoints import cut
from .lookup import small

PIN_ROWS = 10
LEAST_AREA = 30


def office_pins(listings: DataFrame, least: int = PIN_ROWS) -> DataFrame:
    """Points that so many listings share, of all that have coordinates; their listings show an office, not a place."""
    return listings.where(F.col("lat").isNotNull() & F.col("lng").isNotNull()).groupBy("lat", "lng").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def clean_listings(listings: DataFrame, operation: str | None = None) -> DataFrame:
    """Listings with a place of their own, a price and an area of 30 m2 or more; optionally of one operation."""
    real = F.col("lat").isNotNull() & F.col("lng").isNotNull() & ~((F.col("lat") == 0) & (F.col("lng") == 0))
    kept = listings.where(real & (F.col("precio") > 0) & (F.col("superficie_m2") >= LEAST_AREA))
    kept = kept if operation is None else kept.where(F.col("operacion") == operation)
    return kept.join(small(cut(office_pins(listings).select("lat", "lng"))), ["lat", "lng"], "left_anti").select(*listings.columns)


def dollars(price: Column, currency: Column, rate: Column) -> Column:
    """Price in dollars; currencies count in any case, others than these two and prices of 0 give null."""
    c = F.upper(F.trim(currency))
    return F.when(price <= 0, None).when(c == "USD", price).when(c == "PYG", price / rate)


def latest_rate(rates: DataFrame) -> DataFrame:
    return rates.agg(F.max_by("pyg_por_usd", "fecha").alias("rate"))


def dollarize(listings: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds precio_usd at the latest rate, for all rows alike."""
    return listings.join(F.broadcast(latest_rate(rates))).withColumn("precio_usd", dollars(F.col("precio"), F.col("moneda"), F.col("rate"))).drop("rate")


def dollarize_as_of(listings: DataFrame, rates: DataFrame, day: str) -> DataFrame:
    """Extension: at the latest rate up to each listing's day. Only the distinct days of both sides (one row a day) meet, in one window; listings join them by equality."""
    from pyspark.sql import Window as W

    days = listings.select(F.col(day).cast("date").alias("_d")).where(F.col("_d").isNotNull()).distinct()
    known = rates.groupBy(F.col("fecha").alias("_d")).agg(F.max("pyg_por_usd").alias("_r"))
    both = days.join(known, "_d", "full_outer").withColumn("_r", F.last("_r", ignorenulls=True).over(W.orderBy("_d").rowsBetween(W.unboundedPreceding, 0)))
    joined = listings.join(small(both), F.col(day).cast("date") == F.col("_d"), "left")
    return joined.withColumn("precio_usd", dollars(F.col("precio"), F.col("moneda"), F.col("_r"))).drop("_d", "_r")


def trim_outliers(df: DataFrame, value: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Rows between two exact percentiles, both included."""
    bounds = df.agg(F.percentile(value, F.lit(low)).alias("_low"), F.percentile(value, F.lit(high)).alias("_high"))
    return df.join(F.broadcast(bounds)).where((F.col(value) >= F.col("_low")) & (F.col(value) <= F.col("_high"))).drop("_low", "_high")


def price_summary(rows: DataFrame, by: str = "fuente") -> DataFrame:
    """Rows, rows with a price in dollars, and least, mean and highest price of each source, with the means of prices named in dollars and of sales."""
    p = F.col("precio_usd")
    return rows.groupBy(by).agg(
        F.count("*").alias("n"), F.count(p).alias("n_usd"), F.min(p).alias("low"), F.avg(p).alias("mean"), F.max(p).alias("high"), F.avg(F.when(F.col("moneda") == "USD", p)).alias("mean_in_usd"), F.avg(F.when(F.col("operacion") == "venta", p)).alias("mean_of_sales")
    )
