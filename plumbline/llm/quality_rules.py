"""Quality rules: a threshold table compiled into one projection, evaluated without user functions.

Every figure is counted within its own row, so nothing is shuffled; the plan is a
scan and projections. Null and empty texts have no words: all counts are 0 and the
row fails the base rule. Repeated rows are judged alike, each for itself. Columns of
the input other than the id and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, text_of, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "der", "die", "das", "und", "den", "mit", "le", "la", "les", "et", "un", "que", "el", "los", "y", "en", "de")


@dataclass(frozen=True)
class Rule:
    """Passes while low <= 100 * part / whole <= high; judged only from ``least`` words up."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    least: int = 0

    def sql(self) -> str:
        tests = [f"100 * {self.part} >= {self.low} * {self.whole}"] * (self.low is not None) + [f"100 * {self.part} <= {self.high} * {self.whole}"] * (self.high is not None)
        return f"(n_words < {self.least} OR ({' AND '.join(tests)}))"


#: All in whole numbers, so that any engine decides alike. Parts and wholes are columns of ``statistics``.
RULES = (
    Rule("mean word length", "word_chars", "n_words", low=200, high=1200),
    Rule("symbols per word", "n_symbols", "n_words", high=20),
    Rule("exclamation marks per word", "n_exclaim", "n_words", high=40),
    Rule("capitals per character", "n_capitals", "word_chars", high=45),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=50),
    Rule("different words", "n_distinct_words", "n_words", low=5),
    Rule("stop words", "n_stop_words", "n_words", low=1, least=150),
)


def _joined_hashes(hashes: str, apart: int) -> Column:
    """Of each hash with the one so many places after it."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(F.col(hashes), i + apart)))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and the counts that rules refer to (all long)."""
    text = text_of(F.col(text_col))
    base = docs.select(F.col(id_col), text.alias("_text"), words(F.col(text_col)).alias("_words"))
    n = F.size("_words")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    wide = base.select(id_col, "_text", "_words", F.transform("_words", lambda w: F.xxhash64(w)).alias("_h1"), lines.alias("_lines"), F.array_join("_words", "").alias("_solid"))
    # Hashes of windows of 2, 4 and 8 words, each from two of half the width; the last ones reach past the end and are cut off.
    width = 1
    while width < WINDOW:
        wide = wide.withColumn(f"_h{2 * width}", _joined_hashes(f"_h{width}", width))
        width *= 2
    windows = F.when(n >= WINDOW, F.slice(f"_h{WINDOW}", F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<bigint>"))
    wide = wide.withColumn("_windows", windows)
    ordered = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    wide = wide.select("*", ordered.alias("_ordered"))
    at = lambda k: F.get(F.col("_ordered"), k)["h"]
    same = lambda x, k: F.coalesce(at(k) == x["h"], F.lit(False))
    twice = F.filter(F.col("_ordered"), lambda x, k: same(x, k - 1) | same(x, k + 1))
    starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n"), (p + WINDOW).alias("end")),
        lambda acc: acc["n"],
    )
    longest = max(map(len, STOP_WORDS))
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length("_solid"),
        "n_symbols": F.regexp_count("_solid", F.lit(f"[{SYMBOLS}]")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        # The last term is 0. It keeps filters on the counts above this projection; pushed below, each figure would be
        # computed anew within the others.
        "n_repeat_words": F.coalesce(covered, F.lit(0)) + F.monotonically_increasing_id() * 0,
        "n_lines": F.size("_lines"),
        "n_exclaim": F.regexp_count("_solid", F.lit("!")),
        "n_capitals": F.regexp_count("_solid", F.lit("[A-Z]")),
        "n_distinct_words": F.size(F.array_distinct("_h1")),
        "n_stop_words": F.size(F.filter("_words", lambda w: (F.length(w) <= longest) & F.lower(w).isin(*STOP_WORDS))),
    }
    return wide.select(id_col, *(c.cast("bigint").alias(k) for k, c in counts.items()))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``statistics`` with base_failed, the failed rules' names, and kept."""
    judged = statistics(docs, id_col, text_col).withColumn("base_failed", base_failed())
    failed = F.filter(F.array(*(F.when(~F.expr(r.sql()), F.lit(r.name)) for r in rules)), lambda x: x.isNotNull())
    passed = reduce(lambda a, b: a & b, (F.expr(r.sql()) for r in rules), F.lit(True))
    return judged.select("*", failed.alias("failed_rules"), (~F.col("base_failed") & passed).alias("kept"))


def op1(spark, sf_dir: str) -> DataFrame:
    got = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op1_sql() -> str:
    """The same rows in DuckDB SQL."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    rules = "\n AND ".join(r.sql() for r in RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
e AS (SELECT rid, unnest(range(1, len(w) - 6)) AS i, w FROM w WHERE len(w) >= 8),
h AS (SELECT rid, i, array_to_string(w[i:i+7], ' ') AS g FROM e),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM h) WHERE c > 1),
gap AS (SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS n FROM dup),
rep AS (SELECT rid, sum(n) AS n FROM gap GROUP BY rid),
s AS (
 SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
  CAST(len(l) AS BIGINT) AS n_lines,
  CAST(length(t) - length(translate(t, '!', '')) AS BIGINT) AS n_exclaim,
  CAST(length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS BIGINT) AS n_capitals,
  CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct_words,
  CAST(len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop_words
 FROM w LEFT JOIN rep USING (rid)),
b AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 (NOT base_failed AND {rules}) AS kept FROM b"""
