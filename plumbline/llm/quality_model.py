"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are counted by one projection (those of ``quality_rules``); only these numbers
reach Python, where all trees, flattened into arrays, are walked for a whole batch at once.
The model is fitted in numpy on a bounded sample of labelled rows: the ``max_rows`` of least
hash. Documents of the held-out fold are never among them.

Texts that are null, empty or blank are scored by their zero counts. Rows with a null id are
in the fold of the empty string. Of several labels for one id the least counts; null labels are left out. With
no labelled rows of both classes every score is the share of class 1, or 0.5 without any.
Repeated rows are scored each. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered
from .quality_rules import statistics

THRESHOLD = 0.3
#: The bound of the training sample, in rows.
MAX_ROWS = 20_000
FOLDS = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaim", "n_capitals", "n_distinct_words", "n_stop_words")


def features(counts: np.ndarray) -> np.ndarray:
    """Ratios that stay comparable between short and long texts, from rows of COUNTS."""
    n, chars, symbols, dup, repeat, lines, exclaim, capitals, distinct, stop = counts.astype(float).T
    n1, lines1, chars1 = np.maximum(n, 1), np.maximum(lines, 1), np.maximum(chars, 1)
    return np.column_stack([np.log1p(n), chars / n1, symbols / n1, dup / lines1, repeat / n1, n / lines1, exclaim / n1, capitals / chars1, distinct / n1, stop / n1])


@dataclass
class Trees:
    """Complete binary trees: children of node i are 2i + 1 and 2i + 2; the leaves' values are apart."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 3.0, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss on binned features; split gains come from cumulated histograms."""
    inner, leaves = 2**depth - 1, 2**depth
    share = float(np.mean(y)) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        base = float(np.log((share + 1e-6) / (1 - share + 1e-6))) if len(y) else 0.0
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])  # bin b holds values up to cuts[b]
    width = bins + 1
    base = float(np.log(share / (1 - share)))
    total, out = np.full(len(y), base), ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        feature, threshold, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            best = np.full(nodes, 1e-6)
            where = np.zeros(nodes, np.int64)
            for j in range(x.shape[1]):
                cell = (at - first) * width + binned[:, j]
                G = np.bincount(cell, g, nodes * width).reshape(nodes, width)
                H = np.bincount(cell, h, nodes * width).reshape(nodes, width)
                gl, hl = G.cumsum(1), H.cumsum(1)
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (gl[:, -1:] ** 2) / (hl[:, -1:] + ridge)
                gain[(hl < least) | (hr < least)] = -1
                gain[:, len(cuts[j]) :] = -1
                top = gain.argmax(1)
                better = gain[np.arange(nodes), top] > best
                best[better] = gain[np.arange(nodes), top][better]
                where[better] = top[better]
                feature[first : first + nodes][better] = j
                threshold[first : first + nodes][better] = cuts[j][np.minimum(top, len(cuts[j]) - 1)][better]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
        G, H = np.bincount(at - inner, g, leaves), np.bincount(at - inner, h, leaves)
        leaf = rate * G / (H + ridge)
        total += leaf[at - inner]
        for k, v in enumerate((feature, threshold, leaf)):
            out[k].append(v)
    return Trees(*map(np.array, out), base)


def fold(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Trees:
    """Fits on labelled documents outside the held-out fold, at most ``max_rows`` of them."""
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != 0)).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = texts.join(F.broadcast(chosen), "id")  # max_rows pairs of numbers at most
    counted = statistics(joined.select(F.struct("id", "y").alias("key"), "text"), "key", "text").select(F.xxhash64("key.id").alias("h"), "key.y", *COUNTS)
    # Rows of one id are more than one; the bound holds for them, too, in the same order.
    rows = np.array(counted.orderBy("h", *COUNTS, "y").limit(max_rows).drop("h").toPandas(), dtype=float).reshape(-1, 1 + len(COUNTS))
    return fit(features(rows[:, 1:]), rows[:, 0])


def score(docs: DataFrame, model: Trees, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, score, predicted, and the columns to carry. Only the counts go to Python and back."""

    @F.pandas_udf("double")
    def walk(*counts: pd.Series) -> pd.Series:
        return pd.Series(model.score(features(np.column_stack([c.to_numpy() for c in counts]))))

    key = F.struct(F.col(id_col).alias("id"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(carry)))
    counted = statistics(docs.select(key.alias("_key"), F.col(text_col).alias("text")), "_key", "text")
    scored = counted.select("_key", walk(*COUNTS).alias("score"))
    return scored.select(F.col("_key.id").alias(id_col), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *(F.col(f"_key.c{k}").alias(c) for k, c in enumerate(carry)))


def keep_good(docs: DataFrame, model: Trees, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the model doesn't reject, all columns unchanged; nothing is shuffled."""
    rows, named = numbered(docs)
    scored = score(rows, model, threshold, named[id_col], named[text_col], tuple(n for n in rows.columns if n != named[id_col]))
    return scored.where(F.col("predicted") == 1).select(*(F.col(n).alias(c) for c, n in named.items()))


def op9(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return got.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")
