"""Categories of business records: a cascade of lookups, and its distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import rating_category, unaccented
from .lookup import small

#: Source of each tier and its confidence, in order (fixed values).
TIERS = (("google_categoria", 0.90), ("categoria_original", 0.85), ("search_category", 0.60), ("nombre", 0.50))
#: Closing notes of a category, cut off once (fixed value).
STATUS = r"\s+(cerrado|abierto|cierra pronto|abre pronto)(\s+(temporalmente|permanentemente|24 horas))?$"
KEYWORD_LEAST = 5


def lookup_key(x: Column) -> Column:
    return F.regexp_replace(unaccented(x), STATUS, "")


def keywords_of(names: DataFrame, keys: DataFrame) -> DataFrame:
    """(name, key) for distinct plain names that hold a key (``key``, KEYWORD_LEAST letters or more) as whole words: the longest, the first of equals.

    Every run of words of a name, up to as many as a key has, is a candidate, and candidates and keys meet by equality; so neither the number of keys nor
    that of names has a bound. Keys begin and end with a word's letter.
    """
    held = keys.where(F.length("key") >= KEYWORD_LEAST).select("key").distinct()
    most = held.agg(F.max(F.regexp_count("key", F.lit(r"\w+")))).first()[0] or 0
    pieces = F.split("name", r"\b")  # words and what stands between them, in turn
    first = lambda i: F.explode(F.sequence(F.lit(1), F.least(F.lit(most), F.floor((F.size("_p") - i) / 2) + 1).cast("int")))
    words = names.where(F.lit(most > 0)).select("name", pieces.alias("_p")).select("name", "_p", F.posexplode("_p").alias("_i", "_w")).where(F.col("_w").rlike(r"\w"))
    runs = words.withColumn("_k", first(F.col("_i"))).select("name", "_i", F.array_join(F.slice("_p", F.col("_i") + 1, 2 * F.col("_k") - 1), "").alias("key"))
    best = runs.where(F.length("key") >= KEYWORD_LEAST).join(small(held), "key").groupBy("name").agg(F.max(F.struct(F.length("key").alias("n"), (-F.col("_i")).alias("first"), "key")).alias("b"))
    return best.select("name", F.col("b.key").alias("key"))


def curate(df: DataFrame, mappings: DataFrame) -> DataFrame:
    """Adds raw category, type, category, source and confidence; the first tier that hits counts.

    Tiers: the tail of the record's category after a rating, the category itself, the search term, and the longest
    mapping key of five letters or more among those that the name holds as whole words (the first of equals). The
    raw category is the tail, whatever tier hits.
    mappings: raw_norm (unique), type, category; broadcast while it is a small table, else joined.
    """
    named = df.withColumn("_name", unaccented(F.col("name")))
    found = keywords_of(named.select(F.col("_name").alias("name")).distinct(), mappings.select(F.col("raw_norm").alias("key"))).select(F.col("name").alias("_held"), F.col("key").alias("_longest"))
    df, longest = named.join(found, F.col("_name") == F.col("_held"), "left").drop("_name", "_held"), F.col("_longest")
    columns = [c for c in df.columns if c != "_longest"]
    m = small(mappings.select(F.col("raw_norm").alias("k"), F.struct(F.col("type"), F.col("category")).alias("v")))
    keys = (lookup_key(rating_category(F.col("category"))), lookup_key(F.col("category")), lookup_key(F.col("search_category")), longest)
    rows = df.withColumns({f"_k{t}": F.nullif(k, F.lit("")) for t, k in enumerate(keys)})
    for t in range(len(TIERS)):
        rows = rows.join(m.select(F.col("k").alias("_m"), F.col("v").alias(f"_v{t}")), F.col(f"_k{t}") == F.col("_m"), "left").drop("_m")
    hit = lambda t: F.when(F.col(f"_v{t}").isNotNull(), F.struct(F.col(f"_v{t}.type").alias("type"), F.col(f"_v{t}.category").alias("category"), F.lit(TIERS[t][0]).alias("source"), F.lit(TIERS[t][1]).alias("confidence")))
    best = F.coalesce(*map(hit, range(len(TIERS))))
    return rows.withColumn("_b", best).select(*columns, rating_category(F.col("category")).alias("raw_category"), F.col("_b.type").alias("business_type"), F.col("_b.category").alias("business_category"), F.col("_b.source").alias("category_source"), F.col("_b.confidence").alias("category_confidence"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of each value."""
    from pyspark.sql import Window as W

    return df.groupBy(column).agg(F.count("*").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy()))


def clean_rows(df: DataFrame) -> DataFrame:
    """Active rows with a category and a search category."""
    filled = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c)) != "")
    return df.where(F.col("is_active") & filled("category") & (F.col("category") != "Sin categoria") & filled("search_category"))
