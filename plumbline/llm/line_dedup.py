"""Line dedup: equal lines are kept once in the corpus, where they rank first.

Lines are normalised (A-Z lower-cased, blanks trimmed and runs of them made one space) and hashed, once, into a
scratch table. Only digests are shuffled: they are counted globally, which drops those that occur once; of the others the
earliest occurrence by document id and place stays, the rest is removed, and the code point offsets in the
original text are kept. A removed line goes with the line feed after it. Lines of fewer than ``min_words`` words
have no digest and always stay. A very common line is counted by partial aggregates; its occurrences are joined with one
row, broadcast or, beyond BROADCAST_ROWS repeated lines, by a join that adaptive execution can split.

Null and empty texts have one empty line. Rows with equal id and text are one document; of different texts with one
id, the one with the lesser SHA-256 ranks first. Null ids rank first. Columns other than the id and
the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_RUN, BLANKS, numbered, scratch, text_of

#: Lines without words stay; a larger number leaves short lines as well.
MIN_WORDS = 1
#: Lists of digests of up to so many rows (some 40 bytes each) are broadcast, larger ones shuffled.
BROADCAST_ROWS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(line: Column) -> Column:
    low = F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER))
    trimmed = F.btrim(low, F.lit(BLANKS))
    return F.when(trimmed.rlike(r"[\x09-\x0D]|\x20\x20"), F.regexp_replace(trimmed, BLANK_RUN, " ")).otherwise(trimmed)


def _lines(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(row, pos, n, a, b, id, digest): the lines of all rows; a and b are null below min_words, id and digest stand at the first line."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text"))
    lines = rows.select("row", "id", F.sha2("text", 256).alias("digest"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("row", "pos", "id", "digest", F.length("line").alias("n"), normalised(F.col("line")).alias("norm"))
    # One blank stands between two words.
    enough = (F.col("norm") != "") if min_words <= 1 else F.substring_index("norm", " ", min_words - 1) != F.col("norm")
    first = F.col("pos") == 0
    key = [F.when(enough, h).alias(k) for k, h in (("a", F.xxhash64("norm")), ("b", F.xxhash64(F.lit(1), "norm")))]
    lines = scratch(lines.select("row", "pos", "n", *key, F.when(first, F.col("id")).alias("id"), F.when(first, F.col("digest")).alias("digest")), "lines")
    own = lines.where(first).select("row", "id", "digest")
    again = own.groupBy("id", "digest").agg(F.min("row").alias("least"), F.count("*").alias("times")).where(F.col("times") > 1)
    again = again.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "least")
    copies = scratch(own.join(_small(scratch(again, "lines-again")), F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))).where(F.col("row") != F.col("least")).select("row"), "lines-copies")
    return lines if copies.isEmpty() else lines.join(_small(copies), "row", "left_anti")


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, digest (SHA-256 of the text), n_lines, removed (start and end of each line removed)."""
    lines = _lines(docs, min_words, id_col, text_col)
    repeated = scratch(lines.where(F.col("a").isNotNull()).groupBy("a", "b").count().where(F.col("count") > 1).select("a", "b"), "lines-repeated")
    members = scratch(lines.select("row", "pos", "a", "b").join(_small(repeated), ["a", "b"]), "lines-members")
    names = lines.where(F.col("pos") == 0).select("row", "id", "digest")
    ranked = members.join(names, "row").select("a", "b", "row", "pos", F.struct("id", "digest", "pos").alias("rank"))
    firsts = scratch(ranked.groupBy("a", "b").agg(F.min("rank").alias("first")), "lines-firsts")
    gone = ranked.join(_small(firsts), ["a", "b"]).where(F.col("rank") != F.col("first")).select("row", "pos")
    # The lines of a document meet; a mark follows each line that goes.
    none = F.lit(None)
    marks = lines.select("row", "pos", "n", "id", "digest").unionByName(gone.select("row", "pos", none.cast("int").alias("n"), none.cast(lines.schema["id"].dataType).alias("id"), none.cast("string").alias("digest")))
    whole = marks.groupBy("row").agg(F.max("id").alias("id"), F.max("digest").alias("digest"), F.count("n").alias("n_lines"), F.array_sort(F.collect_list(F.struct("pos", F.col("n").isNull().alias("gone"), "n"))).alias("lines"))
    span = "array<struct<start:bigint,end:bigint>>"
    at = lambda acc, x: F.when(x["gone"], acc["at"]).otherwise(acc["at"] + x["n"] + 1)
    removed = F.aggregate(
        "lines",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("start"), F.array().cast(span).alias("out")),
        lambda acc, x: F.struct(
            at(acc, x).cast("bigint").alias("at"),
            F.when(x["gone"], acc["start"]).otherwise(acc["at"]).alias("start"),
            F.when(x["gone"], F.array_append(acc["out"], F.struct(acc["start"].alias("start"), (acc["at"] - 1).alias("end")))).otherwise(acc["out"]).cast(span).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return whole.select(F.col("id").alias(id_col), "digest", "n_lines", removed.alias("removed"))


def remove_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the lines that stand earlier in the corpus; other columns are unchanged. Equal rows become one."""
    rows, named = numbered(docs)
    key, text = named[id_col], text_of(F.col(named[text_col]))
    found = repeated_lines(docs, min_words, id_col, text_col).where(F.size("removed") > 0).select(F.col(id_col).alias("_id"), F.col("digest").alias("_digest"), "removed")
    joined = rows.withColumn("_own", F.sha2(text, 256)).dropDuplicates([key, "_own"]).join(found, F.col("_own").eqNullSafe(F.col("_digest")) & F.col(key).eqNullSafe(F.col("_id")), "left")
    part = lambda a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    kept = F.aggregate(
        "removed",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, s: F.struct(F.concat(acc["out"], part(acc["at"], s["start"])).alias("out"), (s["end"] + 1).alias("at")),
        lambda acc: F.concat(acc["out"], part(acc["at"], F.length(text))),
    )
    return joined.select(*(F.when(F.col("removed").isNull(), F.col(n)).otherwise(kept).alias(c) if c == text_col else F.col(n).alias(c) for c, n in named.items()))


def op3(spark, sf_dir: str) -> DataFrame:
    got = repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return got.select("doc_id", "n_lines", F.size("removed").cast("bigint").alias("n_removed"), spans.alias("removed"))


def op3_sql() -> str:
    """The same rows in DuckDB SQL."""
    return rf"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t, sha256(coalesce(text, '')) AS h FROM documents),
l AS (SELECT doc_id, h, string_split(t, chr(10)) AS ls FROM d),
u AS (SELECT doc_id, h, i, ls[i] AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM l)),
n AS (SELECT *, regexp_replace(trim(translate(line, '{_UPPER}', '{_LOWER}'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+', ' ', 'g') AS norm,
 coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id, h ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM u),
r AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id NULLS FIRST, h, i) AS k, CASE WHEN norm = '' THEN 0 ELSE len(string_split(norm, ' ')) END AS w FROM n)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (w >= {MIN_WORDS} AND k > 1) AS n_removed,
 coalesce(string_agg(CAST(start AS BIGINT) || ':' || CAST(start + length(line) AS BIGINT), ',' ORDER BY i) FILTER (w >= {MIN_WORDS} AND k > 1), '') AS removed
FROM r GROUP BY doc_id, h"""
