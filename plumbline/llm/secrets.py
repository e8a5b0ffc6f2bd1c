"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its content. A pair of
blob and rule version that the ledger already holds is not scanned again; the others
are scanned once each, however many paths show them, and the findings are joined back
to all paths. Only DataFrame functions are used.

Of the paths of an unseen blob the least speaks for it; a first pass takes digests only, and the texts that need no scan are
left out by their paths, so texts are not shuffled as long as those (or the others) are few enough to broadcast.
Only blobs with findings are joined back; a blob with very many paths is split by adaptive execution.

Null texts are scanned as empty ones. Repeated rows and copies share one scan and get
the same findings, a row each. Null paths count as one path. Offsets are code points, ends exclusive. Columns other
than the path and the text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, text_of

RULE_VERSION = "2"
#: Lists of paths and digests of up to so many rows (some 100 bytes each) are broadcast, larger ones shuffled.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class Rule:
    """A finding is a leftmost non-overlapping match whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The patterns below hold for Java's and RE2's engines alike. The first three kinds are the base set.
RULES = (
    Rule("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),  # runs shorter than 16 characters can't hold a longer match
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("vcs", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
)
BASE_KINDS = ("assign", "access", "hex")
SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint>"


def _found(rule: Rule, rank: int) -> Column:
    """Array of spans: the lengths of what lies between and in the matches add up to their places."""
    text = F.col("text")
    pattern = F.lit(rule.pattern)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    judged = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    before = F.transform(F.split(text, rule.pattern, -1), F.length)
    parts = F.arrays_zip(before.alias("before"), whole.alias("whole"), judged.alias("judged"))
    spans = F.aggregate(
        parts,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["before"] + F.coalesce(x["whole"], F.lit(0))).cast("bigint").alias("at"),
            F.when(
                F.coalesce(x["judged"] >= rule.least, F.lit(False)),
                F.array_append(acc["spans"], F.struct((acc["at"] + x["before"]).cast("bigint").alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (acc["at"] + x["before"] + x["whole"]).cast("bigint").alias("end"))),
            )
            .otherwise(acc["spans"])
            .cast(f"array<{SPAN}>")
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return F.when(text.rlike(rule.pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob`` and ``findings`` (by start, then in the order of the rules) for rows of ``blob`` and ``text``."""
    found = F.array_sort(F.flatten(F.array(*(_found(r, k) for k, r in enumerate(rules)))))
    return blobs.select("blob", found.alias("findings"))


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def secret_scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION, path_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Findings of all versions, and the ledger rows that are new.

    ledger: rows of blob, rule_version, findings from earlier runs; it may be None or empty.
    Returns (path, blob, findings) for each input row, and the (blob, rule_version, findings) to append.
    """
    rows = versions.select(F.col(path_col).alias("path"), text_of(F.col(text_col)).alias("text")).withColumn("blob", F.sha2("text", 256))
    keys = scratch(rows.select("path", "blob"), "secrets-keys")
    known = None if ledger is None else ledger.where(F.col("rule_version") == rule_version).select("blob", "findings")
    speakers = keys.groupBy("blob").agg(F.min("path").alias("path"))
    if known is not None:
        speakers = speakers.join(known.select("blob"), "blob", "left_anti")
    speakers = scratch(speakers, "secrets-unseen").select(F.col("blob").alias("_blob"), F.col("path").alias("_path"))
    same = F.col("path").eqNullSafe(F.col("_path")) & (F.col("blob") == F.col("_blob"))
    silent = scratch(keys.join(speakers, same, "left_anti").distinct(), "secrets-seen").select(F.col("blob").alias("_blob"), F.col("path").alias("_path"))
    # Without the texts that need no scan if these are few, else only those that do.
    unseen = rows.join(F.broadcast(silent), same, "left_anti") if silent.count() <= BROADCAST_ROWS else rows.join(_small(speakers), same, "left_semi")
    fresh = scratch(scan(unseen, rules).dropDuplicates(["blob"]), "secrets-findings")  # a row may be there twice
    all_found = fresh if known is None else fresh.unionByName(known)
    hits = all_found.where(F.size("findings") > 0)
    findings = keys.join(_small(hits), "blob", "left").select(F.col("path").alias(path_col), "blob", F.coalesce("findings", F.array().cast(f"array<{SPAN}>")).alias("findings"))
    return findings, fresh.select("blob", F.lit(rule_version).alias("rule_version"), "findings")


def scan_history(runs: list[DataFrame], path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(path, blob, findings) of the versions of several runs; each run scans what the ledger of those before it lacks."""
    found = ledger = None
    for versions in runs:
        own, fresh = secret_scan(versions, ledger, path_col=path_col, text_col=text_col)
        found = own if found is None else found.unionByName(own)
        ledger = fresh if ledger is None else ledger.unionByName(fresh)
    return found


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    # Two runs over the history: the second one finds copies of what the first has scanned in the ledger.
    early = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    findings = scan_history([docs.where(early), docs.where(~early)])
    of = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("findings", lambda s: s["kind"].isin(*BASE_KINDS))
    return findings.select("doc_id", *(of(k) for k in BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def op5_sql() -> str:
    """The same rows in DuckDB SQL."""
    parts = []
    for k, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(
            f"SELECT rid, {k} AS rank, '{r.kind}' AS kind, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {r.group}) AS g, string_split_regex(t, '{p}') AS b FROM d WHERE regexp_matches(t, '{p}')"
        )
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(parts)}),
x AS (SELECT rid, rank, kind, unnest(range(1, len(m) + 1)) AS i, m, g, b FROM m),
s AS (SELECT rid, rank, kind, length(m[i]) AS n, length(g[i]) AS judged,
  list_sum(list_transform(b[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i-1], lambda y: length(y))), 0) AS start FROM x),
f AS (SELECT * FROM s WHERE kind <> 'assign' OR judged >= 8),
a AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT), ',' ORDER BY start, rank) FILTER (rank < {len(BASE_KINDS)}) AS base,
  string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT), ',' ORDER BY start, rank) AS spans FROM f GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
 sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (rid)"""
