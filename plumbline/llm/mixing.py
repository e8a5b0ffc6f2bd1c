"""Mixing sources to target weights by entropy balancing.

Each source gets a target number of words. Among all rates r of its documents that
meet sum(r * size) = target and 0 <= r <= cap, those closest to 1 in relative entropy
are r = min(cap, exp(lambda * x)) with x the document's size over its source's mean. One
lambda for each source solves the convex dual; safeguarded Newton steps find all of
them at once, each step one aggregation of a histogram (source, size, documents), never
of the documents. Rates then become whole copies, rounded along the sizes so that the
errors cancel, and a last pass moves single copies to close what is left.

Sums are decimal, hence the same in any order: reruns agree. Null and empty texts have
size 0 and take nothing. A null source is a source of its own, last in order. Repeated
rows are documents of their own. An empty table gives an empty result. Columns other than
id, text and source are not read. A source's rows are rounded in windows dealt by id and size, so only rows that agree in both
can make one larger than WINDOW_ROWS; targets are shared out in one window with a row for each source.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, scratch, words

WEIGHTS = (1, 2, 3)
CAP = 3
#: Rows that are rounded in one window; a larger source is dealt into more windows.
WINDOW_ROWS = 50_000
#: Per-source tables of up to so many rows (some 60 bytes each) are broadcast, larger ones shuffled.
BROADCAST_ROWS = 100_000
STEPS, CLOSE = 40, 1e-7


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Adds ``sid`` (rank by code point, null last) and ``target`` to rows of source and source_size.

    Sources in order of cap * size / weight: the first few end at their cap, all others
    share what remains by weight, at one level. One row per source is all that the windows see.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("sid", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("sid") % len(weights) + 1).cast("bigint")).withColumn("most", cap * F.col("source_size"))
    filling = W.orderBy(F.col("most") / F.col("weight"), "sid")
    everything = W.partitionBy()
    levels = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("sharing", F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("full", F.col("most") * F.col("sharing") <= F.col("left") * F.col("weight"))
        .withColumn("left_after", F.first(F.when(~F.col("full"), F.col("left")), ignorenulls=True).over(filling.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        .withColumn("sharing_after", F.first(F.when(~F.col("full"), F.col("sharing")), ignorenulls=True).over(filling.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    )
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("left_after") * F.col("weight") / F.col("sharing_after"))
    return levels.select("source", "sid", "source_size", "n_docs", target.alias("target"))


def _rate(cap: int):
    return F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(math.log(cap))))


def tilts(histogram: DataFrame, sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Adds ``lam`` and ``full`` to the sources: Newton steps on log sum(n * size * rate) = log target.

    histogram: sid, size, n. Bounds on lambda are kept for each source; a step that leaves them halves them instead.
    """
    state = sources.select(
        "*",
        (F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1))).alias("mean"),
        (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("lam"),
        F.lit(-1e6).alias("lo"),
        F.lit(1e6).alias("hi"),
        F.lit(False).alias("done"),
    ).withColumn("done", F.col("full") | (F.col("source_size") == 0))
    state = cut(state)
    exact = lambda c: F.sum(c.cast("decimal(38,9)")).cast("double")
    for _ in range(STEPS):
        if state.where(~F.col("done")).isEmpty():
            break
        open_ = state.where(~F.col("done")).select("sid", "lam", "mean")
        words_at = F.col("n") * F.col("size") * _rate(cap)
        free = F.col("lam") * F.col("size") / F.col("mean") < math.log(cap)
        sums = histogram.join(open_, "sid").groupBy("sid").agg(exact(words_at).alias("got"), exact(F.when(free, words_at * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"))
        moved = state.join(sums, "sid", "left")
        above = F.col("got") > F.col("target")
        hi, lo = F.when(above, F.col("lam")).otherwise(F.col("hi")), F.when(above, F.col("lo")).otherwise(F.col("lam"))
        newton = F.when(F.col("slope") > 0, F.col("lam") - F.col("got") / F.col("slope") * F.log(F.col("got") / F.col("target")))
        # Outside the bounds, or where no document is free to move: halve, on a scale that also fits bounds far apart.
        squeeze = lambda x: F.signum(x) * F.log1p(F.abs(x))
        mid = (squeeze(hi) + squeeze(lo)) / 2
        half = F.signum(mid) * F.expm1(F.abs(mid))
        step = F.when((newton > lo) & (newton < hi), newton).otherwise(half)
        close = F.abs(F.col("got") - F.col("target")) <= CLOSE * F.col("target")
        rest = [c for c in state.columns if c not in ("lam", "lo", "hi", "done")]
        state = cut(
            moved.select(
                *rest,
                F.when(F.col("done") | close, F.col("lam")).otherwise(F.round(step, 12)).alias("lam"),
                F.when(F.col("done"), F.col("lo")).otherwise(lo).alias("lo"),
                F.when(F.col("done"), F.col("hi")).otherwise(hi).alias("hi"),
                (F.col("done") | F.coalesce(close, F.lit(False))).alias("done"),
            )
        )
    return state


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, source, size, source_size, target, rate, copies, taken (= copies * size), and the columns to carry."""
    sized = docs.select(F.col(id_col), F.col(source_col).alias("source"), F.size(words(F.col(text_col))).cast("bigint").alias("size"), *carry)
    sized = scratch(sized.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    sources = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs")), weights, cap))
    n_sources = sources.count()
    small = (lambda df: F.broadcast(df)) if n_sources <= BROADCAST_ROWS else (lambda df: df)
    ids = sources.select(F.col("source").alias("_source"), "sid")
    histogram = scratch(sized.groupBy("source", "size").agg(F.count("*").alias("n")).join(small(ids), F.col("source").eqNullSafe(F.col("_source"))).select("sid", "size", "n"), "mix-histogram")
    state = tilts(histogram, sources, cap)
    known = state.select(F.col("source").alias("_source"), "sid", "source_size", "n_docs", "target", "mean", "lam", "full")
    rated = sized.join(small(known), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("full"), float(cap)).otherwise(_rate(cap))
    rated = rated.withColumn("rate", F.least(rate, F.lit(float(cap))).cast("decimal(18,12)")).withColumn("part", F.pmod(F.xxhash64(F.col(id_col), F.col("size")), F.ceil(F.col("n_docs") / WINDOW_ROWS).cast("bigint")))
    along = W.partitionBy("sid", "part").orderBy(F.desc("size"), F.xxhash64(F.col(id_col)), F.col(id_col), "row")
    run = F.sum("rate").over(along.rowsBetween(W.unboundedPreceding, 0)) + F.lit(0.5).cast("decimal(18,12)")
    counted = rated.withColumn("run", run).withColumn("copies", (F.floor("run") - F.floor(F.col("run") - F.col("rate"))).cast("bigint"))
    keep = [id_col, "source", "size", *carry, "row", "sid", "source_size", "target", "rate", "copies"]
    counted = scratch(counted.select(*keep), "mix-copies")
    for _ in range(2):
        counted = _closed(counted, cap, small, id_col)
    return counted.select(id_col, "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"), *carry)


def _closed(counted: DataFrame, cap: int, small, id_col: str) -> DataFrame:
    """Moves one copy in each source, of the document whose size comes nearest to what its source has too few or too many."""
    off = counted.groupBy("sid").agg(F.first("target").alias("goal"), F.sum(F.col("copies") * F.col("size")).alias("got")).select("sid", (F.col("goal") - F.col("got")).alias("off"))
    able = counted.join(small(off), "sid").where((F.col("size") > 0) & (F.col("size") < 2 * F.abs("off")) & F.when(F.col("off") > 0, F.col("copies") < cap).otherwise(F.col("copies") > 0))
    best = F.struct(F.abs(F.col("size") - F.abs("off")).alias("far"), F.xxhash64(F.col(id_col)).alias("h"), F.col("row"), F.signum("off").cast("bigint").alias("move"))
    pick = able.groupBy("sid").agg(F.min(best).alias("best")).select(F.col("best.row").alias("row"), F.col("best.move").alias("move"))
    moved = counted.join(small(pick), "row", "left")
    return scratch(moved.select(*(F.col(c) if c != "copies" else (F.col("copies") + F.coalesce("move", F.lit(0))).alias("copies") for c in counted.columns)), "mix-closed")


def op10(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")
