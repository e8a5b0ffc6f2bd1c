"""Removal of long byte strings that occur more than once, by suffix arrays.

A byte goes if some string of ``length`` bytes that covers it also starts anywhere else in the
corpus. Texts are UTF-8 bytes; matches never cross documents.

1. Equal texts count as one text with copies, which is removed whole if it is long enough.
2. Anchors: each window of ``length`` bytes has one, the 32-byte string of least hash in it, at the same
   place in each occurrence. A window whose anchor is no window's anchor elsewhere in the
   corpus is unique. The others go on in pieces: runs of windows with equal anchors.
3. Pieces are dealt into shards by anchor. Equal ones are found at once, as they stream in; only
   anchors that also have a piece of their own kind go through a suffix array, refined in numpy as by
   Larsson and Sadakane: groups of equal prefixes are split by the ranks of what follows, twice as far
   each time, singletons are done. Kasai's walk, over all pieces of a shard in step, gives the common
   prefixes of neighbours.
4. Cross-shard merging: an anchor with too many pieces for one shard (or, if its count says so before, for one
   task) is split. The digests of its windows are counted when all shards are done, which gives the number of
   ranges; the shards' sorted digests are cut into these by binary search, for each range the arrays of all
   shards meet, and each shard's are searched in the others'. Runs found within a shard don't pass through it.

Digests have 64 bits, so two of 10 ** 9 different windows are taken for equal with a chance of some
3 %; within a shard the bytes themselves decide. Null and empty texts, and texts
shorter than ``length``, have nothing to remove. Repeated rows are copies of each other. Rows with a null id
are searched like others. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chained, matched, mixed, scratch, small_batches, text_of, utf8_buffers

LENGTH = 200
#: Bytes of an anchor.
ANCHOR = 32
#: Bytes whose anchors are sought at once; some 15 arrays of 8 bytes each go with a byte.
ANCHOR_BYTES = 1_000_000
SHARD_BYTES = 1_000_000
#: An anchor with so many occurrences, or with this part of all, is dealt over SPLIT tasks by its pieces.
HOT, HOT_PART, SPLIT = 20_000, 1e-4, 16
#: Windows whose digests meet in one group of the merge, on average.
RANGE_WINDOWS = 1_000_000
#: Tables of up to so many bytes are broadcast; larger ones are shuffled with the texts.
BROADCAST_BYTES = 48_000_000
#: Repeated anchors, of 8 bytes each, that are broadcast to the texts' lists of anchors.
BROADCAST_ANCHORS = 1_000_000


def packed(data: np.ndarray) -> np.ndarray:
    """Each position's next 8 bytes as a number whose order is theirs; bytes past the end count as 0."""
    wide = np.r_[data, np.zeros(8, np.uint8)].astype(np.uint64)
    n = len(data)
    two = (wide[:-1] << np.uint64(8)) | wide[1:]
    four = (two[: n + 5] << np.uint64(16)) | two[2 : n + 7]
    return (four[:n] << np.uint64(32)) | four[4 : n + 4]


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i : i + width], by doubling; shorter at the end by width - 1."""
    done, out = 1, x
    while 2 * done <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def window_anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the ANCHOR bytes from each position on, and of each window's anchor (0 where no window fits in its text)."""
    n, width = len(data), length - ANCHOR + 1
    if n < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h, done = mixed(packed(data)), 8
    while done < ANCHOR:
        h = chained(h[: len(h) - done], h[done:])
        done *= 2
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)  # bytes left in the text
    h = np.where(room[: n - ANCHOR + 1] >= ANCHOR, h[: n - ANCHOR + 1] | np.uint64(1), np.uint64(2**64 - 1))
    return h, np.where(room[: n - length + 1] >= length, _slide(h, width, np.minimum), np.uint64(0))


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the buffer and digests of all texts' anchors."""
    h, least = window_anchors(data, offsets, length)
    if not len(least):
        return np.zeros(0, np.int64), least
    width = length - ANCHOR + 1
    padded = np.r_[np.zeros(width - 1, np.uint64), least, np.zeros(len(h) - len(least), np.uint64)]
    best = _slide(padded, width, np.maximum)  # over the windows that begin at i - width + 1 to i
    at = np.flatnonzero((best == h) & (best > 0))
    return at, h[at]


def pieces_of(data: np.ndarray, offsets: np.ndarray, repeated: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with equal anchors, of those among the repeated digests: first bytes, ends, and the anchor's digest."""
    _, least = window_anchors(data, offsets, length)
    begin = np.flatnonzero(np.r_[True, least[1:] != least[:-1]]) if len(least) else np.zeros(0, np.int64)
    good = np.isin(least[begin], repeated)
    after = np.r_[begin[1:], len(least)]
    return begin[good], after[good] + length - 1, least[begin][good]


def suffix_order(data: np.ndarray, starts: np.ndarray, lasts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions with ``length`` bytes left in their stretch, sorted by them, and the ranks of their groups.

    Stretches are data[starts[i]:lasts[i]]. Each round refines the groups that aren't single yet.
    """
    n = len(data)
    room = np.zeros(n, np.int64)
    for_each = lasts - starts
    room[:] = np.repeat(lasts, for_each) - np.arange(n)
    key, depth = packed(data), 8
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    fresh = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
    first = np.flatnonzero(fresh)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, np.diff(np.r_[first, n]))
    size = np.empty(n, np.int64)  # of the group of each position
    size[order] = np.repeat(np.diff(np.r_[first, n]), np.diff(np.r_[first, n]))
    while depth < length:
        step = min(depth, length - depth)
        after = step + np.arange(n)
        able = (size > 1) & (room >= depth + step)
        p = np.flatnonzero(able)
        # Positions too near their stretch's end are in no window of this depth; they leave their groups.
        if len(p):
            second = rank[after[p]]
            o = np.lexsort((second, rank[p]))
            p, second, old = p[o], second[o], rank[p][o]
            begins = np.r_[True, old[1:] != old[:-1]]
            parts = begins | np.r_[True, second[1:] != second[:-1]]
            part_first = np.flatnonzero(parts)
            part_size = np.diff(np.r_[part_first, len(p)])
            group_first = np.maximum.accumulate(np.where(begins, np.arange(len(p)), 0))
            new = old + np.repeat(part_first, part_size) - group_first
            out = rank.copy()
            out[p] = new
            # Members that left keep a rank after all that stay, in no particular order.
            size = np.where(able, size, 1)
            size[p] = np.repeat(part_size, part_size)
            gone = np.flatnonzero(~able & (room < depth + step))
            out[gone] = n + gone
            rank = out
        depth += step
    whole = np.flatnonzero(room >= length)
    o = whole[np.argsort(rank[whole], kind="stable")]
    return o, rank[o]


def kasai(data: np.ndarray, order: np.ndarray, starts: np.ndarray, lasts: np.ndarray, length: int) -> np.ndarray:
    """Common prefix, up to ``length``, of each position of the order with the one before it.

    The walk goes through all stretches in step. From a position to the next the prefix shrinks by one byte at most,
    if the old neighbour's next position also stands before the new position; else it is counted from 0 again.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    index = np.full(n + 1, n, np.int64)  # in the order; those that aren't in it stand before none
    index[order] = np.arange(len(order))
    eight, powers = packed(data), np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)
    lcp = np.zeros(n, np.int64)
    many = lasts - starts - length + 1  # windows of each stretch
    by = np.argsort(-many, kind="stable")
    begin, many = starts[by], many[by]
    h, old = np.zeros(len(by), np.int64), np.full(len(by), -1, np.int64)
    for i in range(int(many[0]) if len(many) else 0):
        live = int(np.searchsorted(-many, -i, side="left"))  # stretches with more than i windows
        p = begin[:live] + i
        q = before[p]
        follows = (old[:live] >= 0) & (index[old[:live] + 1] < index[p])
        own = np.where(follows, np.maximum(h[:live] - 1, 0), 0)
        old[:live] = q
        run = np.flatnonzero((q >= 0) & (own < length))
        while len(run):
            x = eight[p[run] + own[run]] ^ eight[q[run] + own[run]]
            own[run] += 8 - np.searchsorted(powers, x, side="right")  # less the bytes from the first that differs on
            run = run[(x == 0) & (own[run] < length)]
        h[:live] = np.minimum(own, length)
        lcp[p] = h[:live]
    return lcp[order]


def window_digests(data: np.ndarray, length: int) -> np.ndarray:
    """64 bits for the ``length`` bytes from each position on; positions nearer to the end than that have none."""
    h, done = mixed(packed(data)), 8
    while done < length:
        step = min(done, length - done)
        h = chained(h[: len(h) - step], h[step:])
        done += step
    return h[: max(0, len(data) - length + 1)]


def _runs(tid: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (text, place) as runs (text, start, end) of the bytes they cover."""
    o = np.lexsort((at, tid))
    tid, at = tid[o], at[o]
    new = np.ones(len(at), bool)
    new[1:] = (tid[1:] != tid[:-1]) | (at[1:] > at[:-1] + length)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)] - 1 if len(at) else first
    return tid[first], at[first], at[last] + length


LISTS = ["once", "tids", "owners", "places", "several"]
NAMES = ["tid", "start", "end", *LISTS]
SCHEMA = "tid bigint, start bigint, `end` bigint, once binary, tids binary, owners binary, places binary, several binary"


def _run_rows(tid: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(tid), pa.array(start), pa.array(end), *[pa.nulls(len(tid), pa.binary())] * len(LISTS)], names=NAMES)


class Shard:
    """Collects the pieces of anchors; ``rows`` gives the runs found and the digests of the windows of split anchors."""

    def __init__(self, length: int):
        self.length = length
        self.runs: list[tuple[int, int, int]] = []
        self.start()

    def start(self) -> None:
        self.first: dict[bytes, tuple[int, int] | None] = {}  # None once a piece came twice
        self.anchors: list[list[bytes]] = []
        self.split: list[bool] = []
        self.bytes = 0

    def add(self, fresh: bool, split: bool, tid: int, start: int, piece: bytes) -> None:
        """fresh: the anchor is another one than before."""
        if fresh or not self.anchors:
            self.anchors.append([])
            self.split.append(split)
        self.split[-1] |= split
        if piece not in self.first:
            self.first[piece] = (tid, start)
            self.anchors[-1].append(piece)
            self.bytes += len(piece)
            return
        before = self.first[piece]
        for t, s in ([before] if before else []) + [(tid, start)]:
            self.runs.append((t, s, s + len(piece)))
        self.first[piece] = None

    def rows(self):
        """What was found so far; begins anew after it."""
        length, chosen = self.length, [(p, s) for own, s in zip(self.anchors, self.split) if s or any(self.first[x] for x in own) for p in own]
        tables = []
        if chosen:
            data = np.frombuffer(b"".join(p for p, _ in chosen), np.uint8)
            sizes = np.array([len(p) for p, _ in chosen])
            lasts = np.cumsum(sizes)
            starts = lasts - sizes
            twice = np.array([self.first[p] is None for p, _ in chosen])
            homes = np.array([self.first[p] or (-1, 0) for p, _ in chosen], np.int64)
            order, _ = suffix_order(data, starts, lasts, length)
            common = kasai(data, order, starts, lasts, length)
            fresh = common < length
            fresh[:1] = True
            first = np.flatnonzero(fresh)
            group = np.cumsum(fresh) - 1
            of = np.searchsorted(lasts, order, side="right")
            several = np.bincount(group, 1 + twice[of]) > 1
            hit = several[group] & ~twice[of]
            tables.append(_runs(homes[of[hit], 0], homes[of[hit], 1] + order[hit] - starts[of[hit]], length))
            across = np.array([s for _, s in chosen])[of[first]]
            if across.any():
                yield self._digests(data, order, first[across], several[across], of, homes, starts)
        t, a, b = (np.concatenate([np.array([r[k] for r in self.runs], np.int64), *(x[k] for x in tables)]) for k in range(3))
        yield _run_rows(t, a, b)
        self.runs = []
        self.start()

    def _digests(self, data, order, first, several, of, homes, starts):
        digests = window_digests(data, self.length)[order[first]]
        one, many = digests[~several], np.sort(digests[several])
        o = np.argsort(one)
        at = first[~several][o]
        # A window's text is told by its number in the shard, its place in 4 bytes.
        tids, owners = np.unique(homes[of[at], 0], return_inverse=True)
        one, owners, place = one[o], owners.astype(np.int32), (homes[of[at], 1] + order[at] - starts[of[at]]).astype(np.int32)
        none = pa.nulls(1, pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, *(pa.array([x.tobytes()], pa.binary()) for x in (one, tids.astype(np.int64), owners, place, many))], names=NAMES)


def ranges(lists: DataFrame, range_windows: int) -> DataFrame:
    """The shards' digests cut into ranges (part) of so many windows on average, as counted over all of them."""
    windows = lists.agg(F.sum(F.octet_length("once") + F.octet_length("several"))).first()[0] or 0
    parts = max(1, -(-(windows // 8) // range_windows))
    cuts = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)

    def deal(batches):
        for batch in batches:
            for row in zip(*(batch.column(c) for c in LISTS)):
                once, tids, owners, places, several = (np.frombuffer(x.as_py(), kind) for x, kind in zip(row, (np.uint64, np.int64, np.int32, np.int32, np.uint64)))
                i, j = np.r_[0, np.searchsorted(once, cuts), len(once)], np.r_[0, np.searchsorted(several, cuts), len(several)]
                out: list[tuple] = []
                for k in np.flatnonzero((np.diff(i) > 0) | (np.diff(j) > 0)).tolist():
                    own, of = np.unique(owners[i[k] : i[k + 1]], return_inverse=True)  # only the texts of the range go with it
                    out.append((k, *(x.tobytes() for x in (once[i[k] : i[k + 1]], tids[own], of.astype(np.int32), places[i[k] : i[k + 1]], several[j[k] : j[k + 1]]))))
                if out:
                    part, *columns = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], names=["part", *LISTS])

    return lists.select(*LISTS).mapInArrow(deal, "part int, once binary, tids binary, owners binary, places binary, several binary")


def merged_part(rows: list[tuple[bytes, ...]], length: int):
    """Runs of the windows that a shard has once and another shard has, too."""
    once, tids, owners, places, several = ([np.frombuffer(r[k], kind) for r in rows] for k, kind in enumerate((np.uint64, np.int64, np.int32, np.int32, np.uint64)))
    everything = np.sort(np.concatenate([*once, *several]))
    runs = []
    for mine, names, of, at in zip(once, tids, owners, places):
        found = np.searchsorted(everything, mine, side="right") - np.searchsorted(everything, mine, side="left") > 1
        runs.append((names[of[found]], at[found].astype(np.int64)))
    return _runs(np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs]), length)


def _join(texts: DataFrame, table: DataFrame, size: int, on: list[str]) -> DataFrame:
    """On the id, which may be null, and other columns. Broadcasts the table if its size, counted before, allows; else the texts are shuffled to it."""
    return matched(texts, F.broadcast(table) if size <= BROADCAST_BYTES else table, on)


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """One row per text that has any: digest (SHA-256, hexadecimal), spans (bytes, end exclusive, maximal, sorted)."""
    rows = docs.select(F.col(id_col).alias("id"), text_of(F.col(text_col)).alias("text"))
    long = rows.where(F.octet_length("text") >= length).withColumn("digest", F.sha2("text", 256))
    texts = long.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first(F.octet_length("text")).alias("n_bytes"))
    texts = scratch(texts.withColumn("tid", F.monotonically_increasing_id()), "suffix-texts")
    id_type = rows.schema["id"].dataType.simpleString()

    def find(batches):
        for whole in batches:
            for batch in small_batches(whole, most=ANCHOR_BYTES):
                data, offsets = utf8_buffers(batch.column("text"))
                at, h = anchors(data, offsets, length)
                of = np.searchsorted(offsets, at, side="right") - 1
                cuts = np.r_[0, np.cumsum(np.bincount(of, minlength=batch.num_rows))]
                lists = pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), pa.array(h.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), lists], names=["id", "digest", "h"])

    found = long.select("id", "digest", "text").mapInArrow(find, f"id {id_type}, digest string, h array<bigint>")
    # The row of the least id speaks for its text; if that row itself repeats, its anchors are counted apart.
    own = scratch(matched(found, texts.select("digest", "id", "tid"), ["digest"]).dropDuplicates(["digest", "id"]).select("tid", "h"), "suffix-own")
    each = own.select("tid", F.explode("h").alias("h"))
    # Partial counts first: an anchor that very many texts have doesn't bring them together in one task.
    several = scratch(each.groupBy("h").count().where(F.col("count") > 1), "suffix-several")
    wide = several.count() > BROADCAST_ANCHORS
    again = each.join(several.select("h") if wide else F.broadcast(several.select("h")), "h")
    places = scratch(again.groupBy("tid").agg(F.collect_set("h").alias("h")).join(texts.select("tid", "digest", "id"), "tid"), "suffix-anchors")
    size, total = places.agg(F.sum(F.size("h") * 8 + 120), F.sum(F.size("h"))).first()
    frequent = several.where(F.col("count") >= max(HOT, int(HOT_PART * (total or 0)))).agg(F.collect_list("h")).first()
    hot = np.sort(np.array(frequent[0], np.int64).view(np.uint64))  # some 1 / HOT_PART at most

    def cut_out(batches):
        for whole in batches:
            for batch in small_batches(whole, most=ANCHOR_BYTES):
                data, offsets = utf8_buffers(batch.column("text"))
                known = batch.column("h")
                first, last, anchor = pieces_of(data, offsets, np.unique(known.flatten().to_numpy().view(np.uint64)), length)
                of = np.searchsorted(offsets, first, side="right") - 1
                pieces = [data[a:b].tobytes() for a, b in zip(first.tolist(), last.tolist())]
                frequent = np.isin(anchor, hot)
                salt = [zlib.crc32(p) % SPLIT if f else -1 for p, f in zip(pieces, frequent.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(salt, pa.int32()), pa.array(batch.column("tid").to_numpy()[of], pa.int64()), pa.array(first - offsets[of]), pa.array(pieces, pa.binary())], names=["anchor", "salt", "tid", "start", "bytes"]
                )

    pieces = _join(long.select("id", "digest", "text"), places, size or 0, ["digest"]).select("tid", "h", "text").mapInArrow(cut_out, "anchor bigint, salt int, tid bigint, start bigint, bytes binary")

    def shard(batches):
        held, last = Shard(length), None
        for batch in batches:
            for anchor, salt, tid, start, piece in zip(*(batch.column(c).to_pylist() for c in ("anchor", "salt", "tid", "start", "bytes"))):
                fresh = (anchor, salt) != last
                full = held.bytes >= shard_bytes
                if full:
                    held.split[-1] |= not fresh  # the anchor goes on in another shard
                    cut = not fresh
                    yield from held.rows()
                elif fresh:
                    cut = False
                if len(held.runs) >= 100_000:
                    held.runs, runs = [], held.runs
                    yield _run_rows(*(np.array(x, np.int64) for x in zip(*runs)))
                held.add(fresh, cut or salt >= 0, tid, start, piece)
                last = (anchor, salt)
        yield from held.rows()

    sharded = scratch(pieces.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt").mapInArrow(shard, SCHEMA), "suffix-shards")

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for b in batches for row in zip(*(b.column(c).to_pylist() for c in LISTS))]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in merged_part(held, length)], names=["tid", "start", "end"])

    across = ranges(sharded.where(F.col("tid").isNull()), range_windows).groupBy("part").applyInArrow(merge, "tid bigint, start bigint, `end` bigint")
    runs = sharded.where(F.col("tid").isNotNull()).select("tid", "start", "end").unionByName(across)
    copies = texts.where(F.col("copies") > 1).select("tid", F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").cast("bigint").alias("end"))
    spans = runs.unionByName(copies).groupBy("tid").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))))).otherwise(F.array_append(acc, s)),
    )
    return scratch(spans.join(texts.select("tid", "digest"), "tid").select("digest", joined.alias("spans")), "suffix-spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """One row per document: id, n_bytes, spans removed, kept (the bytes that remain)."""
    spans = repeated_spans(docs, length, id_col, text_col, **sizes)
    size = spans.agg(F.sum(F.size("spans") * 24 + 100)).first()[0] or 0
    rows = docs.select(F.col(id_col), text_of(F.col(text_col)).alias("_text"))
    rows = rows.withColumn("digest", F.when(F.octet_length("_text") >= length, F.sha2("_text", 256)))
    joined = rows.join(F.broadcast(spans) if size <= BROADCAST_BYTES else spans, "digest", "left")
    raw = F.col("_text").cast("binary")
    kept = F.aggregate(
        "spans",
        F.struct(F.lit(b"").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(F.concat(acc["out"], F.substring(raw, acc["at"] + 1, (s["start"] - acc["at"]).cast("int"))).alias("out"), s["end"].cast("int").alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(raw, acc["at"] + 1, F.octet_length(raw))),
    )
    return joined.select(id_col, F.octet_length("_text").cast("bigint").alias("n_bytes"), F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"), F.when(F.col("spans").isNotNull(), kept).otherwise(raw).alias("kept"))


def op4(spark, sf_dir: str) -> DataFrame:
    got = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return got.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
