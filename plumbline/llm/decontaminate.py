"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton holds every run of words of the normalised test items. Documents stream
through it: after each word it knows the longest run that ends there and that some item
has too. Where that run reaches the window, or covers a whole item shorter than one, the
words are hit. Spans of hit words are removed; a document of which more than
``max_coverage`` is hit goes as a whole.

Stretches in which two neighbouring words never stand together in any item are skipped by
array operations; no run of the automaton can pass through them.

The automaton is built once, on the driver, flattened into arrays and broadcast, as long as the items have at most
``AUTOMATON_WORDS`` words, summed before anything is collected. Beyond that they are dealt into parts whose sums
are checked; only one part is on the driver at a time, each takes one pass over the documents, written to a
scratch table, and the passes are joined. Null or wordless texts have no words and are never hit; null or
wordless items match nothing. Repeated documents are judged each; items with equal texts
all count; an item without an id hits words, but has no name. An empty table on either side hits nothing. Columns
other than those named, or carried on request, are not read.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, numbered, scratch, small_batches, text_of, utf8_buffers

WINDOW = 10
MAX_COVERAGE = 0.5
AUTOMATON_WORDS = 400_000


def word_bytes() -> np.ndarray:
    """Digits, letters, and all bytes of non-ASCII characters."""
    b = np.arange(256)
    return (b >= 0x80) | ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x61) & (b <= 0x7A)) | ((b >= 0x41) & (b <= 0x5A))


class _Builder:
    """Generalised suffix automaton of items, each a list of word numbers, as it grows."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]

    def add(self, words: list[int]) -> int:
        """The state of the whole item."""
        last = 0
        for w in words:
            last = self._extend(last, w)
        return last

    def _extend(self, last: int, w: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        if w in nxt[last]:
            q = nxt[last][w]
            return q if size[q] == size[last] + 1 else self._clone(last, w, q)
        new = len(size)
        nxt.append({}), link.append(0), size.append(size[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if size[q] == size[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        new = len(size)
        nxt.append(dict(nxt[q])), link.append(link[q]), size.append(size[p] + 1)
        link[q] = new
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = new
            p = link[p]
        return new


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers, and where each list begins and ends."""
    return np.array([x for one in lists for x in one], np.int64), np.r_[0, np.cumsum([len(one) for one in lists], dtype=np.int64)]


class Automaton:
    """The finished automaton in arrays: its transitions are sorted by state and word."""

    def __init__(self, items: list[list[int]], window: int, n_words: int):
        built = _Builder()
        ends = [built.add(words) for words in items]
        self.n_words = max(n_words, 1)
        rows = sorted((s * self.n_words + w, t) for s, out in enumerate(built.next) for w, t in out.items())
        self.keys, self.to = (np.array(x, np.int64) for x in (zip(*rows) if rows else ((), ())))
        self.link, self.size = np.array(built.link, np.int64), np.array(built.size, np.int64)
        #: Items that have the windows of a state, and the short items that end in it.
        holders: list[set[int]] = [set() for _ in built.size]
        short: list[list[int]] = [[] for _ in built.size]
        for k, (words, end) in enumerate(zip(items, ends)):
            if 0 < len(words) < window:
                short[end].append(k)
            elif words:
                state = length = 0
                for w in words:
                    state, length = self.step(state, length, w)
                    if length >= window:
                        holders[self.holding(state, window)].add(k)
        self.holders, self.held = _flat([sorted(x) for x in holders])
        self.short, self.ends = _flat(short)
        self.lengths = np.array([len(x) for x in items], np.int64)
        #: The next state up the links, itself included, in which a short item ends; -1 if there is none.
        up = [-1] * len(built.size)
        for s in sorted(range(len(up)), key=built.size.__getitem__):
            up[s] = s if short[s] else (up[built.link[s]] if built.link[s] >= 0 else -1)
        self.up = np.array(up, np.int64)

    def step(self, state: int, length: int, w: int) -> tuple[int, int]:
        while True:
            key = state * self.n_words + w
            at = int(self.keys.searchsorted(key))
            if at < len(self.keys) and self.keys[at] == key:
                return int(self.to[at]), length + 1
            if state == 0:
                return 0, 0
            state = int(self.link[state])
            length = int(self.size[state])

    def holding(self, state: int, n: int) -> int:
        """The state, up the links, of the last n words."""
        while (up := int(self.link[state])) >= 0 and self.size[up] >= n:
            state = up
        return state


class Matcher:
    """Finds hit words in batches of texts. Made of arrays but for the items' names, so it is cheap to send."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.names = [i for i, _ in items]
        self.hasher, self.window = WordHasher(word_bytes()), window
        data, offsets = utf8_buffers(pa.array([t or "" for _, t in items], pa.large_string()))
        _, _, owner, hashes = self.hasher(data, offsets)
        self.vocabulary, ids = np.unique(hashes, return_inverse=True)
        words: list[list[int]] = [[] for _ in items]
        for k, w in zip(owner.tolist(), ids.tolist()):
            words[k].append(w)
        self.automaton = Automaton(words, window, len(self.vocabulary))
        lengths = [len(x) for x in words if x]
        self.least = min([window, *lengths])
        same = owner[1:] == owner[:-1]
        self.pairs = np.unique((ids[:-1].astype(np.int64) * len(self.vocabulary) + ids[1:])[same])
        self.any = bool(lengths)

    def __call__(self, texts: pa.Array):
        """For each text: number of words, the hit words' runs as (first byte, end byte, first word, end word), names of the items hit."""
        data, offsets = utf8_buffers(texts)
        first, end, owner, hashes = self.hasher(data, offsets)
        counts = np.bincount(owner, minlength=len(texts))
        before = np.cumsum(counts) - counts
        found: list[tuple[list, set]] = [([], set()) for _ in range(len(texts))]
        if self.any and len(hashes):
            ids = np.searchsorted(self.vocabulary, hashes)
            ids[ids == len(self.vocabulary)] = 0
            known = self.vocabulary[ids] == hashes
            code = ids[:-1].astype(np.int64) * len(self.vocabulary) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, code), max(len(self.pairs) - 1, 0))
            together = known[:-1] & known[1:] & (owner[1:] == owner[:-1])
            together &= (self.pairs[at] == code) if len(self.pairs) else False
            # Maximal runs of known words in which all neighbours are known pairs.
            starts = np.flatnonzero(known & ~np.r_[False, together])
            stops = np.flatnonzero(known & ~np.r_[together, False]) + 1
            long = stops - starts >= self.least
            for a, b in zip(starts[long].tolist(), stops[long].tolist()):
                self._walk(ids[a:b].tolist(), a, found[owner[a]])
        for k, (hits, names) in enumerate(found):
            runs = []
            for a, b in sorted(hits):
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            at = before[k]
            yield int(counts[k]), [(int(first[a] - offsets[k]), int(end[b - 1] - offsets[k]), int(a - at), int(b - at)) for a, b in runs], names

    def _walk(self, ids: list[int], at: int, into: tuple[list, set]) -> None:
        auto, window, (hits, names) = self.automaton, self.window, into
        state = length = 0
        for j, w in enumerate(ids):
            state, length = auto.step(state, length, w)
            if length >= window:
                hits.append((at + j + 1 - window, at + j + 1))
                top = auto.holding(state, window)
                names.update(self.names[k] for k in auto.holders[auto.held[top] : auto.held[top + 1]].tolist())
            s = int(auto.up[state])
            while s >= 0:
                for k in auto.short[auto.ends[s] : auto.ends[s + 1]].tolist():
                    n = int(auto.lengths[k])
                    if n <= length:
                        hits.append((at + j + 1 - n, at + j + 1))
                        names.add(self.names[k])
                s = int(auto.up[auto.link[s]]) if auto.link[s] >= 0 else -1


FIELDS = ("first", "end", "word", "end_word")
SPANS = f"array<struct<{','.join(f'{x}:bigint' for x in FIELDS)}>>"


def _pass(rows: DataFrame, items: list[tuple[str | None, str]], window: int) -> DataFrame:
    """Adds n_words, spans and items to the rows, whose texts are in ``text``; the text is left out."""
    shared = rows.sparkSession.sparkContext.broadcast(Matcher(items, window))
    span = pa.list_(pa.struct([(x, pa.int64()) for x in FIELDS]))
    kept = [f for f in rows.schema if f.name != "text"]
    names = [f.name for f in kept]

    def match(batches):
        matcher = shared.value
        for whole in batches:
            for batch in small_batches(whole):
                got = list(matcher(batch.column("text")))
                spans = pa.array([[dict(zip(FIELDS, s)) for s in x[1]] for x in got], span)
                cols = [batch.column(n) for n in names]
                found = [sorted(x[2], key=lambda i: (i is None, i)) for x in got]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([x[0] for x in got], pa.int64()), spans, pa.array(found, pa.list_(pa.string()))], names=[*names, "n_words", "spans", "items"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(match, f"{schema}, n_words bigint, spans {SPANS}, items array<string>")


def benchmark_parts(benchmark: DataFrame, item_col: str, text_col: str, most: int):
    """The items, in lists of ``most`` words at most each, or of one item; one list is collected at a time, after its size is known."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), text_of(F.col(text_col)).alias("text"))
    size = F.floor(F.octet_length("text") / 2) + 1  # a word and its blank take two bytes at the least
    total, n = items.agg(F.sum(size), F.count("*")).first()
    parts = max(1, -(-(total or 0) // most))
    part = lambda: F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    while parts > 1 and not items.groupBy(part().alias("p")).agg(F.sum(size).alias("s"), F.count_distinct("item", "text").alias("n")).where((F.col("s") > most) & (F.col("n") > 1)).isEmpty() and parts < 64 * n:
        parts *= 2
    for k in range(parts):
        own = [(r.item, r.text) for r in items.where(part() == k).orderBy("item", "text").collect()]
        if own or parts == 1:
            yield own


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", most: int = AUTOMATON_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, n_words, n_hit, spans of hit words (bytes and words, ends exclusive), items (names, sorted), and the columns to carry."""
    held = {f"_carry{k}": c for k, c in enumerate(carry)}
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(h) for h, c in held.items()))
    parts = benchmark_parts(benchmark, item_col, item_text_col, most)
    items, more = next(parts), next(parts, None)
    if more is None:
        got = _pass(rows, items, window)
    else:
        rows = rows.withColumn("digest", F.sha2(text_of(F.col("text")), 256))
        once = rows.select("id", "digest", "text")
        got = _merged([scratch(_pass(once, p, window), "contamination") for p in chain((items, more), parts)])
        got = rows.drop("text").withColumnRenamed("id", "_id").withColumnRenamed("digest", "_digest").join(got, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end_word"] - s["word"])
    return got.select(F.col("id").alias(id_col), "n_words", hit.alias("n_hit"), "spans", F.array_sort("items").alias("items"), *(F.col(h).alias(c) for h, c in held.items()))


def _merged(passes: list[DataFrame]) -> DataFrame:
    """One row for each id and text, with the spans of all passes united."""
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p)
    one = every.groupBy("id", "digest").agg(F.first("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_set("spans"))).alias("all"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    empty = F.array().cast(SPANS)
    joined = lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end_word"] >= s["word"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"), F.element_at(acc, -1)["word"].alias("word"), F.greatest(F.element_at(acc, -1)["end_word"], s["end_word"]).alias("end_word"))))).otherwise(F.array_append(acc, s))
    return one.select("id", "digest", "n_words", F.aggregate("all", empty, joined).alias("spans"), "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """The documents with hit spans cut out of their texts, without those of which more than max_coverage of the words is hit.

    All columns come back; texts that are not hit are unchanged.
    """
    rows, named = numbered(docs)
    text = named[text_col]
    found = contamination(rows, benchmark, window, named[id_col], text, carry=tuple(n for n in rows.columns if n != named[id_col]), **names)
    raw = F.col(text).cast("binary")
    cleaned = F.aggregate(
        "spans",
        F.struct(F.lit(b"").alias("out"), F.lit(0).cast("int").alias("at")),
        lambda acc, s: F.struct(F.concat(acc["out"], F.substring(raw, acc["at"] + 1, (s["first"] - acc["at"]).cast("int"))).alias("out"), s["end"].cast("int").alias("at")),
        lambda acc: F.decode(F.concat(acc["out"], F.substring(raw, acc["at"] + 1, F.octet_length(raw))), "UTF-8"),
    )
    kept = found.where(F.col("n_hit") <= max_coverage * F.col("n_words"))
    return kept.select(*(F.when(F.size("spans") > 0, cleaned).otherwise(F.col(n)).alias(c) if n == text else F.col(n).alias(c) for c, n in named.items()))


def op7(spark, sf_dir: str) -> DataFrame:
    got = contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op7_sql() -> str:
    """The same rows in DuckDB SQL."""
    return r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
m AS (SELECT rid, dw.n AS n, i, item_id FROM dw JOIN iw USING (n, g)),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)"""
