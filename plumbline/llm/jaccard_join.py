"""Self-join of documents by the Jaccard similarity of their word n-grams, and its components.

Two documents link when 100 * |A and B| >= 75 * |A or B| for their sets of 5-word shingles.

1. One pass over the texts hashes all shingles, counts them in a table of fixed size (how common
   a shingle is only decides the order; results don't depend on it) and digests each set.
   Documents with equal sets form a class and go on as one.
2. A pass over one text of each class writes its prefix, the rarest |A| - ceil(0.75 |A|) + 1 of its
   shingles, and a signature: one bit for each cell of its hash range that holds a shingle. Classes that
   link share a prefix shingle. Shingles that only one prefix has are told by a count and dropped.
3. Members of a shingle's group are ordered by a random number that each class has. Round by round, the
   members below a threshold are pivots, joined with the later members that aren't known to be connected to them, if
   sizes (length filter), places in the prefixes (positional filter) and signatures (suffix filter) leave room
   for a link. Each pair is verified once, with the whole sets. A group is done when all members are connected or each
   has been a pivot; so every pair of different components is compared, but members of a group of
   near copies are not paired with each other once one pivot connects them. The result is the
   components, not all links.

The suffix filter halves the hash range again and again, down to cells of a fraction of a shingle on average,
and counts the cells that one set has and the other has not: so many shingles at least are not shared. That is the
recursive partition of the suffixes at fixed places instead of their own medians, and deeper.

Thresholds grow eightfold, so groups of n members take log(n) rounds; a group of any size is counted by partial
aggregates and joined with few pivots, so its rows need not meet in one task (adaptive execution splits them).
Words are maximal runs of characters other than space and U+0009 to U+000D, A-Z lower-cased. Texts of fewer than
five words are one shingle; null, empty and blank ones have none, link with nothing and form
components of their own. Repeated rows get the same component; rows of one id with different
texts are different documents. Rows with a null id link like others, but name no component as long as
another row of it has an id. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import WordHasher, chained, discard, matched, mixed, rows_of, scratch, small_batches, utf8_buffers

SHINGLE = 5
#: Similarity in hundredths.
PERCENT = 75
#: Cells of the table of shingle counts: 2 ** 24, of one byte each in a task and when it is broadcast, whatever the input.
CELL_BITS = 24
CHUNK = 1 << 16
#: UTF-8 bytes that are hashed at once, so that the arrays stay in the processor's caches.
BATCH_BYTES = 400_000
#: Longs of the short signature that the groups' rows carry; the whole one has 4 to 8 bits for each shingle.
SHORT = 16
#: Bits of the table that tells which prefix shingles are worth sending: 8 MB. A bit set by another shingle only sends
#: more; single ones are dropped exactly in their groups.
FILTER_BITS = 26
#: Lists of ids of up to so many rows (some 40 bytes each) are broadcast, larger ones shuffled.
BROADCAST_ROWS = 1_000_000
#: How many more pivots each round has than the one before.
GROWTH = 8


def _word_bytes() -> np.ndarray:
    b = np.arange(256)
    return ~((b == 0x20) | ((b >= 0x09) & (b <= 0x0D)))


def _by_owner(of: np.ndarray, order: np.ndarray, owners: int) -> np.ndarray:
    """``order`` sorted once more by owner, ties kept; few bits sort in linear time."""
    return order[np.argsort(of[order].astype(np.min_scalar_type(owners)), kind="stable")]


class Shingler:
    """Distinct shingle hashes of each text of a batch, sorted."""

    def __init__(self, n: int = SHINGLE):
        self.n, self.hasher = n, WordHasher(_word_bytes())

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All hashes, text by text and sorted within each, and the offsets of the texts."""
        data, offsets = utf8_buffers(texts)
        _, _, owner, h = self.hasher(data, offsets)
        count = np.bincount(owner, minlength=len(texts))
        begin = np.cumsum(count) - count
        m = len(h) - self.n + 1
        if m > 0:
            whole = h[:m]
            for k in range(1, self.n):
                whole = chained(whole, h[k : k + m])
            inside = owner[:m] == owner[self.n - 1 :]
            shingles, of = whole[inside], owner[:m][inside]
        else:
            shingles, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = np.flatnonzero((count > 0) & (count < self.n))
        if len(short):
            own = h[begin[short]]
            for k in range(1, self.n - 1):
                more = count[short] > k
                own[more] = chained(own[more], h[begin[short][more] + k])
            shingles, of = np.r_[shingles, mixed(own ^ np.uint64(self.n))], np.r_[of, short]
        order = _by_owner(of, np.argsort(shingles), len(texts))
        shingles, of = shingles[order], of[order]
        first = np.ones(len(of), bool)
        first[1:] = (of[1:] != of[:-1]) | (shingles[1:] != shingles[:-1])
        shingles, of = shingles[first], of[first]
        return shingles, np.r_[0, np.cumsum(np.bincount(of, minlength=len(texts)))]


def cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(values.view(np.int64))).cast(pa.list_(pa.int64()))


def _set_digests(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, in two arrays."""
    with np.errstate(over="ignore"):
        sums = [np.r_[np.uint64(0), np.cumsum(mixed(h ^ np.uint64(salt)))] for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
        a, b = (mixed(s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums)
    return a, b


def signatures(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bit for each cell of the hashes that a set has, as longs, set by set, and the sets' offsets in them.

    A set of n shingles has 2 ** k cells, 4 n to 8 n of them and 64 at least; its cells at 2 ** (k - 1) are the two halves' union.
    """
    n = np.diff(at)
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(4 * n, 1))).astype(np.int64))
    begin = np.r_[0, np.cumsum(bits)]
    flags = np.zeros(begin[-1], bool)
    flags[np.repeat(begin[:-1], n) + (h & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").view(np.uint64), begin >> 6


def _short(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SHORT longs for each set."""
    n = np.diff(at)
    flags = np.zeros((len(n), SHORT * 64), bool)
    flags[np.repeat(np.arange(len(n)), n), (h & np.uint64(SHORT * 64 - 1)).astype(np.int64)] = True
    return np.packbits(flags.ravel(), bitorder="little").view(np.uint64)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows, rows.schema["id"].dataType.simpleString()


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row (id, n, a, b) for each document, and (chunk, counts) rows with each task's counts of shingles, compressed."""
    rows, id_type = _rows(docs, id_col, text_col)
    names = ["id", "n", "a", "b", "chunk", "counts"]

    def digest(batches):
        shingler, counts, id_arrow = Shingler(), np.zeros(1 << CELL_BITS, np.uint8), None
        for whole in batches:
            id_arrow = whole.column("id").type
            for batch in small_batches(whole, most=BATCH_BYTES):
                h, at = shingler(batch.column("text"))
                own, times = np.unique(cells(h), return_counts=True)
                counts[own] = np.minimum(255, counts[own] + times)  # of one task
                n, (a, b) = np.diff(at), _set_digests(h, at)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(a), pa.array(b), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names=names)
        if id_arrow is not None:
            pack, parts = pa.Codec("zstd"), counts.reshape(-1, min(CHUNK, len(counts)))
            some = np.flatnonzero(parts.any(1)).tolist()
            packed, k = [pack.compress(parts[i].tobytes(), asbytes=True) for i in some], len(some)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, id_arrow), *[pa.nulls(k, pa.int64())] * 3, pa.array(some, pa.int32()), pa.array(packed, pa.binary())], names=names)

    return rows.mapInArrow(digest, f"id {id_type}, n bigint, a bigint, b bigint, chunk int, counts binary")


def _table(digests: DataFrame) -> np.ndarray:
    """The counts of all tasks, as one byte a cell: the logarithm in eighths. Of fixed size; a group streams."""
    size = min(CHUNK, 1 << CELL_BITS)

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pack = np.zeros(size, np.int64), pa.Codec("zstd")
        for b in batches:
            for row in b.column("counts"):
                total += np.frombuffer(pack.decompress(row.as_py(), size, asbytes=True), np.uint8)
        small = np.minimum(255, np.round(8 * np.log2(1 + total))).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([small.tobytes()], pa.binary())], names=["chunk", "counts"])

    rows = digests.where(F.col("chunk").isNotNull()).select("chunk", "counts")
    table = np.zeros(1 << CELL_BITS, np.uint8)
    for r in rows.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect():
        table[r.chunk * size : (r.chunk + 1) * size] = np.frombuffer(r.counts, np.uint8)
    return table


def _prefixes(docs: DataFrame, shared: Broadcast, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n, a, b, prefix, whole, short): the rarest shingles in order, and the signatures. shared: the table of counts."""
    rows, id_type = _rows(docs, id_col, text_col)

    def emit(batches):
        shingler, rare = Shingler(), shared.value
        for full in batches:
            for batch in small_batches(full, most=BATCH_BYTES):
                h, at = shingler(batch.column("text"))
                n, (a, b) = np.diff(at), _set_digests(h, at)
                of = np.repeat(np.arange(len(n)), n)
                order = _by_owner(of, np.argsort(rare[cells(h)], kind="stable"), len(n))  # then by hash, as they come
                size = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
                keep = order[np.arange(len(h)) - at[:-1][of] < size[of]]
                whole, ends = signatures(h, at)
                columns = [_lists(h[keep], np.r_[0, np.cumsum(size)]), _lists(whole, ends), _lists(_short(h, at), SHORT * np.arange(len(n) + 1))]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(a), pa.array(b), *columns], names=["id", "n", "a", "b", "prefix", "whole", "short"])

    return rows.mapInArrow(emit, f"id {id_type}, n bigint, a bigint, b bigint, prefix array<bigint>, whole array<bigint>, short array<bigint>")


def _bits(rows: DataFrame, column: str) -> np.ndarray:
    """A bit for each number at its place in a table of fixed size."""
    spot = F.pmod(F.col(column), F.lit(1 << FILTER_BITS)) + 1
    got = rows.groupBy(F.bitmap_bucket_number(spot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits")).collect()
    table = np.zeros(max(4096, 1 << FILTER_BITS >> 3), np.uint8)
    for r in got:
        table[(r.k - 1) * 4096 : r.k * 4096] = np.frombuffer(r.bits, np.uint8)
    return table[: 1 << FILTER_BITS >> 3]


def _marked(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    spot = numbers & (8 * len(bits) - 1)
    return bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1 == 1


def _entries(prefixes: DataFrame, shared: Broadcast) -> DataFrame:
    """(h, cid, n, pos) of the prefix shingles that several classes may have, as the bits of ``shared`` tell."""

    def emit(batches):
        for batch in batches:
            lists = batch.column("prefix")
            h = lists.flatten().to_numpy()
            count = np.diff(lists.offsets.to_numpy())
            of = np.repeat(np.arange(len(count)), count)
            pos = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count)
            keep = np.flatnonzero(_marked(shared.value, h))
            yield pa.RecordBatch.from_arrays([pa.array(h[keep]), *(batch.column(c).take(pa.array(of[keep])) for c in ("cid", "n")), pa.array(pos[keep])], names=["h", "cid", "n", "pos"])

    return prefixes.select("cid", "n", "prefix").mapInArrow(emit, "h bigint, cid bigint, n bigint, pos bigint")


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cid, members) of the wanted ones (cid) of the classes; only their nodes' texts are hashed."""
    some = classes.join(_small(wanted), "cid", "left_semi")
    own = _small(some.select("cid", F.col("node").alias("id"), "n", "a", "b"), wanted)
    rows, id_type = _rows(docs, id_col, text_col)
    rows = rows.join(_small(own.select(F.col("id").alias("_id")), wanted), F.col("id").eqNullSafe(F.col("_id")), "left_semi")

    def emit(batches):
        shingler = Shingler()
        for whole in batches:
            for batch in small_batches(whole, most=BATCH_BYTES):
                h, at = shingler(batch.column("text"))
                n, (a, b) = np.diff(at), _set_digests(h, at)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(a), pa.array(b), _lists(h, at)], names=["id", "n", "a", "b", "members"])

    found = rows.mapInArrow(emit, f"id {id_type}, n bigint, a bigint, b bigint, members array<bigint>")
    return matched(found, own, ["n", "a", "b"]).select("cid", "members")


def _connected(edges: DataFrame) -> DataFrame:
    """(cid, comp): the least node reachable by the edges (v, w) of a scratch table, for the nodes that have any.

    Labels fall to the least among the neighbours' and then to their label's label, so long chains close fast.
    """
    both = edges.select("v", "w").unionByName(edges.select(F.col("w").alias("v"), F.col("v").alias("w")))
    labels = scratch(both.groupBy("v").agg(F.least(F.min("w"), F.col("v")).alias("l")), "jaccard-labels")
    while True:
        seen = both.join(_small(labels.select(F.col("v").alias("w"), F.col("l").alias("lw")), labels), "w").groupBy("v").agg(F.min("lw").alias("lw"))
        near = seen.join(_small(labels), "v").select("v", F.col("l").alias("old"), F.least("l", "lw").alias("l"))
        jump = labels.select(F.col("v").alias("l"), F.col("l").alias("ll"))
        moved = near.join(_small(jump, labels), "l", "left").select("v", F.least("l", F.coalesce("ll", "l")).alias("l"), "old")
        before, falls = labels, Observation()
        labels = scratch(moved.observe(falls, F.count_if(F.col("l") != F.col("old")).alias("n")).select("v", "l"), "jaccard-labels")
        discard(before)
        if not falls.get.get("n"):
            return labels.select(F.col("v").alias("cid"), F.col("l").alias("comp"))


def _merged(comps: DataFrame | None, found: DataFrame) -> DataFrame:
    """The components (cid, comp) after the links (x, y) of one more round; only links between different ones are followed."""
    if comps is None:
        edges = scratch(found.select(F.col("x").alias("v"), F.col("y").alias("w")), "jaccard-edges")
    else:
        at = lambda end: _small(comps.select(F.col("cid").alias(end), F.col("comp").alias(f"c{end}")), comps)
        ends = found.join(at("x"), "x", "left").join(at("y"), "y", "left").select(F.coalesce("cx", "x").alias("v"), F.coalesce("cy", "y").alias("w"))
        edges = scratch(ends.where(F.col("v") != F.col("w")).distinct(), "jaccard-edges")
    roots = scratch(_connected(edges), "jaccard-roots")
    discard(edges)
    if comps is None:
        return roots
    names = _small(roots.select(F.col("cid").alias("comp"), F.col("comp").alias("root")), roots)
    old = comps.join(names, "comp", "left").select("cid", F.coalesce("root", "comp").alias("comp"))
    return scratch(old.unionByName(roots.join(_small(comps.select("cid"), comps), "cid", "left_anti")), "jaccard-components")


def _small(rows: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Rows of a few numbers: broadcast if they, or the scratch table that they come from, are no more than BROADCAST_ROWS."""
    return F.broadcast(rows) if rows_of(rows if table is None else table) <= BROADCAST_ROWS else rows


def _random(cid: Column) -> Column:
    """The place of a class in the order of its groups: evenly spread from 0 to 1."""
    return F.pmod(F.xxhash64(cid), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _enough(shared: Column, percent: int) -> Column:
    return shared * (100 + percent) >= percent * (F.col("n") + F.col("nx"))


def _room(own: Column, other: Column, n: Column, terms: int) -> Column:
    """n less the cells that only the first signature has."""
    return n - sum((F.bit_count(own[k].bitwiseAND(F.bitwise_not(other[k]))) for k in range(terms)), F.lit(0))


def _candidates(groups: DataFrame, pivots: DataFrame, percent: int, short: bool) -> DataFrame:
    """Pairs (x, y) of a pivot (h, x, nx, px, rx, cx) and a later member of its group (h, cid, n, pos, r, comp) for which the length, positional and (with short signatures) suffix filters hold."""
    n, nx = F.col("n"), F.col("nx")
    length = (F.least(n, nx) * 100 >= percent * F.greatest(n, nx)) & (F.col("r") > F.col("rx")) & (F.col("comp") != F.col("cx"))
    # Linked sets pass at the first shingle that their prefixes share: none before it is shared.
    fits = length & _enough(F.least(n - F.col("pos"), nx - F.col("px")), percent)
    if short:
        a, b = F.col("short"), F.col("short_x")
        fits = fits & _enough(F.least(_room(a, b, n, SHORT), _room(b, a, nx, SHORT)), percent)
    return groups.join(pivots, "h").where(fits).select("x", F.col("cid").alias("y")).distinct()


def _suffix_filtered(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose whole signatures leave room for a link, with their sizes."""
    with_y = _small(pairs).join(signs.select(F.col("cid").alias("y"), "n", F.col("whole").alias("b")), "y")
    both = with_y.join(signs.select(F.col("cid").alias("x"), F.col("n").alias("nx"), F.col("whole").alias("a")), "x")
    least = F.least(F.size("a"), F.size("b"))
    # Sizes of linked sets differ by a third at most, so one signature is twice as long as the other, if not equal.
    fold = lambda s: F.when(F.size(s) <= least, s).otherwise(F.zip_with(F.slice(s, F.lit(1), least), F.slice(s, least + 1, least), lambda p, q: p.bitwiseOR(q)))
    only = lambda p, q: F.aggregate(F.zip_with(p, q, lambda u, v: F.bit_count(u.bitwiseAND(F.bitwise_not(v)))), F.lit(0), lambda acc, v: acc + v)
    folded = both.select("x", "y", "n", "nx", fold(F.col("a")).alias("a"), fold(F.col("b")).alias("b"))
    room = F.least(F.col("nx") - only(F.col("a"), F.col("b")), F.col("n") - only(F.col("b"), F.col("a")))
    return folded.where(_enough(room, percent)).select("x", "y", "n", "nx").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link. The sets of the later members go to their pivots; only sets of the pairs' ends are sent."""
    later = sets.withColumnRenamed("cid", "y").withColumnRenamed("members", "members_y").join(_small(pairs), "y")
    pivots = sets.withColumnRenamed("cid", "x").join(_small(pairs.select("x"), pairs), "x", "left_semi")
    return later.join(pivots, "x").where(_enough(F.size(F.array_intersect("members", "members_y")), percent)).select("x", "y").distinct()


def components(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (the least id reachable by links)."""
    return _found(docs, percent, id_col, text_col).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _classes(digests: DataFrame) -> DataFrame:
    """(cid, n, a, b, node): documents with equal sets; the row of the least id speaks for its class."""
    classes = digests.where(F.col("n") > 0).groupBy("n", "a", "b").agg(F.min("id").alias("node"))
    return scratch(classes.withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")


def _one_text_each(docs: DataFrame, digests: DataFrame, classes: DataFrame, id_col: str) -> DataFrame:
    """The documents without those whose id speaks for no class."""
    ids = lambda df, c: df.select(F.col(c).alias("_id")).distinct()
    nodes = ids(classes, "node").withColumnRenamed("_id", "_node")
    rest = ids(digests.where(F.col("chunk").isNull()), "id").join(nodes, F.col("_id").eqNullSafe(F.col("_node")), "left_anti")
    return docs.join(_small(scratch(rest, "jaccard-copies")), F.col(id_col).eqNullSafe(F.col("_id")), "left_anti")


def _found(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, n, a, b, comp (a number of the component, null without shingles), component_id."""
    digests = scratch(_digests(docs, id_col, text_col), "jaccard-digests")
    rows = digests.where(F.col("chunk").isNull()).select("id", "n", "a", "b")
    classes = _classes(digests)
    once = _one_text_each(docs, digests, classes, id_col)
    spread = docs.sparkSession.sparkContext.broadcast
    counts = spread(_table(digests))
    prefixes = _prefixes(once, counts, percent, id_col, text_col)
    # A row that is there twice has its entries twice; pairs are made distinct.
    own = matched(prefixes, _small(classes.withColumnRenamed("node", "id"), classes), ["n", "a", "b"])
    own = scratch(own.select("cid", "n", "prefix", "whole", "short"), "jaccard-prefixes")
    counts.destroy()
    several = own.select(F.explode("prefix").alias("h")).groupBy("h").count().where(F.col("count") > 1)
    bits = spread(_bits(several, "h"))
    groups = scratch(_entries(own, bits).withColumn("r", _random(F.col("cid"))).withColumn("comp", F.col("cid")), "jaccard-groups")
    bits.destroy()
    comps = sets = None
    # First pivots: the first member of each group, told by one aggregate; later ones: all below a threshold.
    known = groups.groupBy("h").agg(F.min(F.struct("r", "cid", "n", "pos")).alias("p"), F.count("*").alias("m")).where(F.col("m") > 1)
    pivots = known.select("h", F.col("p.cid").alias("x"), F.col("p.n").alias("nx"), F.col("p.pos").alias("px"), F.col("p.r").alias("rx"), F.col("p.cid").alias("cx"))
    first, share, tested = True, 1, []
    while True:
        pairs = _candidates(groups, pivots, percent, short=not first)
        for before in tested:  # a pair may meet in a group of which the pivot was another one before
            pairs = pairs.join(_small(before), ["x", "y"], "left_anti")
        pairs = scratch(pairs, "jaccard-pairs")
        close = scratch(_suffix_filtered(pairs, own.select("cid", "n", "whole"), percent), "jaccard-close")
        tested.append(pairs)
        found = None
        if rows_of(close):
            ends = close.select(F.col("x").alias("cid")).union(close.select("y")).distinct()
            missing = scratch(ends if sets is None else ends.join(sets.select("cid"), "cid", "left_anti"), "jaccard-missing")
            more = scratch(_sets(docs, classes, missing, id_col, text_col).dropDuplicates(["cid"]), "jaccard-sets")
            sets = more if sets is None else sets.unionByName(more)
            found = scratch(_verified(close, sets, percent), "jaccard-links")
            discard(missing)
        discard(close)
        if found is not None and rows_of(found):
            comps, before = _merged(comps, found), comps
            discard(before, found)
        # Groups go on while members of different components are left and not all were pivots.
        now = groups.drop("comp", "m", "short")
        now = now.withColumn("comp", F.col("cid")) if comps is None else now.join(_small(comps), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        done, share, first_was = share, share * GROWTH, first
        open_ = now.groupBy("h").agg(F.min("comp").alias("least"), F.max("comp").alias("most"), F.count("*").alias("m")).where((F.col("least") != F.col("most")) & (F.col("m") > (2 if first_was else done))).select("h", "m")
        now = now.join(open_, "h").join(own.select("cid", "short"), "cid").dropDuplicates(["h", "cid"])
        groups, before, first = scratch(now, "jaccard-groups"), groups, False
        discard(before)
        if not rows_of(groups):
            break
        low, high = (0.0 if first_was else done / F.col("m")), share / F.col("m")
        pivots = groups.where((F.col("r") >= low) & (F.col("r") < high)).select("h", F.col("cid").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("r").alias("rx"), F.col("comp").alias("cx"), F.col("short").alias("short_x"))
    if comps is None:
        named = classes.select("n", "a", "b", F.col("cid").alias("comp"), F.col("node").alias("component_id"))
    else:
        whole = classes.join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        named = whole.join(whole.groupBy("comp").agg(F.min("node").alias("component_id")), "comp").select("n", "a", "b", "comp", "component_id")
    return rows.join(named, ["n", "a", "b"], "left").select("id", "n", "a", "b", "comp", F.coalesce("component_id", "id").alias("component_id"))


def _with_digests(texts: DataFrame) -> DataFrame:
    """(id, text, n, a, b) of rows (id, text)."""
    id_type = texts.schema["id"].dataType.simpleString()

    def digest(batches):
        shingler = Shingler()
        for whole in batches:
            for batch in small_batches(whole):
                h, at = shingler(batch.column("text"))
                a, b = _set_digests(h, at)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), pa.array(np.diff(at)), pa.array(a), pa.array(b)], names=["id", "text", "n", "a", "b"])

    return texts.mapInArrow(digest, f"id {id_type}, text string, n bigint, a bigint, b bigint")


def one_of_each(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the document of least id; equal rows become one. Columns are unchanged.

    A null id comes after all others. Of different texts with one id in one component, that of the lesser set
    digest stays, then the lesser text. Documents without shingles are components of their own.
    """
    found = scratch(_found(docs, percent, id_col, text_col), "jaccard-found")
    ids = found.groupBy("id").agg(F.first("component_id").alias("c"), F.count("*").alias("times"))
    # An id that one row has tells the row. Rows of the others are told by their texts.
    alone = F.col("id").isNotNull() & (F.col("times") == 1)
    lesser, others = (scratch(ids.where(t).select(F.col("id").alias("_id")), "jaccard-ids") for t in (alone & (F.col("c") != F.col("id")), ~alone))
    known = F.col(id_col).eqNullSafe(F.col("_id"))
    rest = docs.join(_small(lesser), known, "left_anti")
    if not rows_of(others):
        return rest
    again = _small(others)
    firsts = found.where(F.col("n") > 0).groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n", "a", "b")).alias("k")).select("k.id", "k.n", "k.a", "k.b")
    texts = docs.join(again, known, "left_semi").select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).distinct()
    texts = scratch(_with_digests(texts), "jaccard-texts")
    stay = matched(texts, firsts, ["n", "a", "b"]).groupBy("id", "n", "a", "b").agg(F.min("text").alias("text"))
    stay = texts.where(F.col("n") == 0).select("id", "text").unionByName(stay.select("id", "text"))
    stay = stay.select(F.col("id").alias("_id"), F.col("text").alias("_text"))
    one = docs.join(again, known, "left_semi").dropDuplicates([id_col, text_col])
    return rest.join(again, known, "left_anti").unionByName(one.join(stay, known & F.col(text_col).eqNullSafe(F.col("_text")), "left_semi"))


def op6(spark, sf_dir: str) -> DataFrame:
    return components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_sql() -> str:
    """The same rows in DuckDB SQL."""
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
g AS (SELECT DISTINCT rid, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS g FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
x AS (SELECT a.rid AS p, b.rid AS q, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.rid <> b.rid GROUP BY 1, 2),
e AS (SELECT p, q FROM x JOIN n a ON a.rid = p JOIN n b ON b.rid = q WHERE 100 * c >= {PERCENT} * (a.n + b.n - c)),
r AS (SELECT rid, rid AS at FROM d UNION SELECT r.rid, e.q FROM r JOIN e ON e.p = r.at),
c AS (SELECT r.rid, min(t.doc_id) AS component_id FROM r JOIN d t ON t.rid = r.at GROUP BY r.rid)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM d JOIN c USING (rid) LEFT JOIN n USING (rid)"""
