"""Helpers shared by the text operators: word arrays, UTF-8 buffers, scratch tables."""

from __future__ import annotations

import atexit
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def text_of(column: Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(column, F.lit(""))


def words(text: Column) -> Column:
    """Array of the maximal runs of non-blank characters; empty for null, empty and blank texts."""
    trimmed = F.btrim(text_of(text), F.lit(BLANKS))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows under names that clash with none of an operator's own, and the new name of each column."""
    names = {c: f"_in{k}" for k, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), names


def matched(left: DataFrame, right: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """Inner equi-join on the keys and on an id of the same name that may be null: null meets null."""
    other = right.withColumnRenamed(id_col, "_matched").withColumnsRenamed({k: f"_matched_{k}" for k in keys})
    on = F.col(id_col).eqNullSafe(F.col("_matched"))
    for k in keys:
        on &= F.col(k) == F.col(f"_matched_{k}")
    return left.join(other, on).drop("_matched", *(f"_matched_{k}" for k in keys))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; one below the warehouse only where none is set, as in local tests."""
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    spark.sparkContext.setCheckpointDir(configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of small iterative state with a reliable checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


#: Nothing reads a scratch table's shuffles after it is written, so their files may go then.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Unlike ``checkpoint`` the columns stay compressed and later reads prune them. The table goes when the driver
    ends, or by ``discard``. The rows are counted as they are written; ``rows_of`` tells their number without a job.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    before, counted = spark.conf.get(CLEANUP, "false"), Observation()
    spark.conf.set(CLEANUP, "true")
    try:
        df.observe(counted, F.count(F.lit(1)).alias("n")).write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    atexit.register(_remove, spark, path)
    written = spark.read.schema(df.schema).parquet(path)
    written._scratch_path, written._rows = path, counted.get.get("n")
    return written


def rows_of(table: DataFrame) -> int:
    """Rows of a scratch table, without a job; of any other by counting."""
    known = getattr(table, "_rows", None)
    return table.count() if known is None else known


def discard(*tables: DataFrame | None) -> None:
    """Removes scratch tables that nothing reads any more."""
    for t in tables:
        if t is not None:
            _remove(t.sparkSession, t._scratch_path)


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def utf8_buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after another, and the n + 1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # more than one chunk stays when they are too large together
        texts = pa.concat_arrays(texts.chunks)
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def small_batches(batch: pa.RecordBatch, column: str = "text", most: int = 4_000_000):
    """Slices of a batch of about ``most`` UTF-8 bytes each, so memory doesn't follow the number of rows in a batch."""
    sizes = np.nan_to_num(np.array(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), float))
    part = (np.cumsum(sizes) // most).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


#: Fixed odd multiplier and seed of the word hashes.
_FACTOR = 0x9E3779B97F4A7C15
_SEED = 20_240_229


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class WordHasher:
    """64-bit hashes of the words in a buffer of UTF-8 texts, in whole-array steps.

    A word is a maximal run of bytes for which ``is_word`` holds, within one text; A-Z counts as a-z.
    """

    def __init__(self, is_word: np.ndarray):
        table = np.random.default_rng(_SEED).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        table[ord("A") : ord("Z") + 1] = table[ord("a") : ord("z") + 1]
        self.is_word, self.table = is_word, table
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                for name, factor in (("up", _FACTOR), ("down", _inverse(_FACTOR))):
                    steps = np.full(n, factor, np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.multiply.accumulate(steps))

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First bytes, ends, text numbers and hashes of all words, in order."""
        n = len(data)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, none, np.zeros(0, np.uint64)
        self._powers(n)
        inside = self.is_word[data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < n)]
        begins[edges] |= inside[edges]
        stops[edges - 1] |= inside[edges - 1]
        first, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        text = np.searchsorted(offsets, first, side="right") - 1
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.table[data] * self.up[:n], out=sums[1:])
            h = (sums[end] - sums[first]) * self.down[first]
            return first, end, text, mixed(h + (end - first).astype(np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of each hash over all 64."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return h ^ (h >> np.uint64(32))


def chained(h: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Hash of a sequence that ``h`` stands for, followed by ``nxt``."""
    with np.errstate(over="ignore"):
        return mixed(h * np.uint64(_FACTOR) + nxt)
