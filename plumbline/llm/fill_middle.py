"""Fill-in-middle: texts cut at two unit boundaries and put together as suffix, prefix and middle.

Units are lines (or characters). Texts are decomposed into chunks of bytes that overlap by one character to the left: whether a
unit begins at a place depends on it and its left neighbour only, so all chunks are counted independently, by whole-array steps. Prefix sums of
the counts give each text's number of units and route both cut ranks to the chunks that own them; only
those are scanned again for the places. Which two ranks are taken, and in which form the text is written, goes by a hash of seed and id.

One pass without a shuffle: a text, its three parts and its hash belong to one row anyway. Null and empty texts stay as they are and are of plain form, as
are texts that contain a mark. A null id hashes like an empty one. Repeated rows are treated alike, rows of one id and other texts are cut
by the same hashes. Columns other than the id and the text are not read, so their names can't clash. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_of, utf8_buffers

#: Marks of prefix, suffix and middle (fixed values of the contract).
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Percent of the texts that are rearranged, and of those the percent that begin with the suffix.
RATE, SUFFIX_FIRST = 100, 50
#: Bytes of a chunk.
CHUNK = 1 << 16
UNITS = ("line", "character")


def chunks(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every chunk, none of which spans two texts, and the n + 1 numbers of each text's first chunk."""
    per_text = -(-np.diff(offsets) // size)
    owner = np.concatenate([[0], np.cumsum(per_text)])
    of = np.repeat(np.arange(len(per_text)), per_text)
    return offsets[of] + (np.arange(owner[-1]) - owner[of]) * size, owner


def begins(data: np.ndarray, unit: str) -> np.ndarray:
    """Where a unit begins by what stands at the place and left of it; the first place of a text is none."""
    out = np.zeros(len(data), bool)
    if unit == "line":
        out[1:] = data[:-1] == 10
    else:
        out[1:] = (data[1:] & 0xC0) != 0x80
    return out


class Cutter:
    """Cut places for a batch of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, unit: str, size: int):
        self.data, self.offsets, self.unit = data, offsets, unit
        self.first, self.owner = chunks(offsets, size)
        self.end = np.minimum(self.first + size, offsets[np.searchsorted(offsets, self.first, side="right")]) if len(self.first) else self.first
        marks = begins(data, unit)
        marks[offsets[:-1][offsets[:-1] < len(data)]] = False
        self.before = self._sums(marks)  # boundaries before each chunk
        self.points = self._sums((data & 0xC0) != 0x80)  # code points before each chunk
        self.n = np.diff(self.before[self.owner]) + (np.diff(offsets) > 0)

    def _sums(self, flags: np.ndarray) -> np.ndarray:
        counts = np.add.reduceat(flags, self.first, dtype=np.int64) if len(self.first) else np.zeros(0, np.int64)
        return np.concatenate([[0], np.cumsum(counts)])

    def places(self, ranks: np.ndarray) -> np.ndarray:
        """The byte at which so many units of each text end."""
        texts = np.arange(len(ranks))
        out = np.where(ranks <= 0, self.offsets[texts], self.offsets[texts + 1])
        inner = np.flatnonzero((ranks > 0) & (ranks < self.n))
        wanted = self.before[self.owner[inner]] + ranks[inner]
        chunk = np.searchsorted(self.before, wanted, side="left") - 1
        for t, c, rank in zip(inner.tolist(), chunk.tolist(), (wanted - self.before[chunk]).tolist()):
            a, b = int(self.first[c]), int(self.end[c])
            left = max(a - 1, int(self.offsets[t]))  # one byte of the chunk to the left
            at = np.flatnonzero(begins(self.data[left:b], self.unit)) + left
            out[t] = at[at >= a][rank - 1]
        return out

    def code_points(self, places: np.ndarray) -> np.ndarray:
        """Code points of each text before a place in it."""
        out = np.zeros(len(places), np.int64)
        for t in np.flatnonzero(np.diff(self.offsets) > 0).tolist():
            c = min(int(np.searchsorted(self.first, places[t], side="right")) - 1, int(self.owner[t + 1]) - 1)
            rest = np.count_nonzero((self.data[self.first[c] : places[t]] & 0xC0) != 0x80)
            out[t] = self.points[c] + rest - self.points[self.owner[t]]
        return out


def transform(batch: pa.RecordBatch, unit: str, rate: int, suffix_first: int, size: int) -> pa.RecordBatch:
    data, offsets = utf8_buffers(batch.column("text"))
    h = [batch.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4)]
    cutter = Cutter(data, offsets, unit, size)
    ranks = [x % (cutter.n + 1) for x in h[:2]]
    low, high = (cutter.places(pick(*ranks)) for pick in (np.minimum, np.maximum))
    ends = [cutter.code_points(p) for p in (low, high)]
    raw = data.tobytes()
    marks = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
    form, output, prefix_chars, middle_chars = [], [], [], []
    for t in range(len(offsets) - 1):
        a, b, c, d = int(offsets[t]), int(low[t]), int(high[t]), int(offsets[t + 1])
        if a == d or h[2][t] % 100 >= rate or any(raw.find(m, a, d) >= 0 for m in marks):
            form.append("plain")
            output.append(raw[a:d])
            prefix_chars.append(None)
            middle_chars.append(None)
            continue
        p, s, m = marks
        first = h[3][t] % 100 < suffix_first
        form.append("spm" if first else "psm")
        output.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c]) if first else (p, raw[a:b], s, raw[c:d], m, raw[b:c])))
        prefix_chars.append(int(ends[0][t]))
        middle_chars.append(int(ends[1][t] - ends[0][t]))
    columns = [batch.column("id"), pa.array(cutter.n.astype(np.int64)), pa.array(form), pa.array(prefix_chars, pa.int64()), pa.array(middle_chars, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, unit: str = "line", rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n (units), form, prefix_chars, middle_chars and the output text."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}, not {unit!r}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    drawn = [F.conv(F.substring("_digest", 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), digest.alias("_digest")).select("id", "text", *drawn)

    def cut(batches):
        for whole in batches:
            for batch in small_batches(whole):
                yield transform(batch, unit, rate, suffix_first, chunk)

    schema = f"id {rows.schema['id'].dataType.simpleString()}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return rows.mapInArrow(cut, schema).withColumnRenamed("id", id_col)


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of. No text of another form than plain contains a mark, so each mark stands once."""
    part = lambda text, mark, k: F.split_part(text, F.lit(mark), F.lit(k))
    tail = part(output, MIDDLE, 1)
    prefix_first = F.concat(part(part(tail, SUFFIX, 1), PREFIX, 2), part(output, MIDDLE, 2), part(tail, SUFFIX, 2))
    suffix_first = F.concat(part(tail, PREFIX, 2), part(output, MIDDLE, 2), part(part(tail, PREFIX, 1), SUFFIX, 2))
    return F.when(form == "psm", prefix_first).when(form == "spm", suffix_first).otherwise(output)


def op12(spark, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    sha = lambda text: F.sha2(text_of(text).cast("binary"), 256)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("form"), F.col("output"))).alias("restored_sha256"))


def op12_sql() -> str:
    return r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
        sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
ranked AS (
    SELECT *, len(lines) AS n, ('0x' || substr(digest, 1, 8))::BIGINT % (len(lines) + 1) AS r1, ('0x' || substr(digest, 9, 8))::BIGINT % (len(lines) + 1) AS r2,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || substr(digest, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
            WHEN ('0x' || substr(digest, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
    SELECT *, array_to_string(lines[1:least(r1, r2)], '') AS prefix, array_to_string(lines[least(r1, r2) + 1:greatest(r1, r2)], '') AS middle,
        array_to_string(lines[greatest(r1, r2) + 1:], '') AS suffix FROM ranked)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts"""
