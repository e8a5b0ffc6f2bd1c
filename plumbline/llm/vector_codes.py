"""Product-quantised vectors: integer codebooks by rounds of nearest-entry search in kd-trees.

Components become integers, floor(1024 * x), so all sums and distances are exact and no order of rows or tasks shows in the result.
Vectors are cut into consecutive parts, each with a codebook that starts as that part of the rows of least ids. Each round
broadcasts a kd-tree for each codebook; tasks search the nearest entry by branch and bound, in whole arrays: a node is left out only if the bound
of its box is greater than the best distance so far, so nodes of an equal bound are visited and among entries at one distance that of the lowest index
wins. Tasks send one sum and count for each entry and component, Spark adds them, and entries become the floors of their means.

The driver holds the codebooks alone (``entries`` times the width, whatever the number of rows); rows are never collected, and every
round is a scan of the input, so a lost executor costs a scan of its share.

Rows whose vector is null or holds null or non-finite components are dropped, empty vectors likewise. Components beyond +-131,071 count as that, which
keeps distances within 64 bits. The width is that of the kept row of least id; vectors of another width have no distance
to the entries and are dropped. A width that isn't a multiple of the number of parts gives parts that differ in width by one (of fewer components than parts some are empty, with entry 0). Ids order ascending,
null ones after all others, equal ids by their vectors; repeated rows are rows like others. Fewer rows than entries give fewer entries, an empty table an empty result.
Only the id, the vector and columns carried on request are read; carried columns may have any name but those of the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_of, scratch

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Largest magnitude of a scaled component.
MOST = (1 << 27) - 1
#: Entries of a leaf, and vectors searched at once.
LEAF, AT_ONCE = 16, 8192
#: Largest squared distance that products of doubles give exactly.
EXACT = 1 << 52
#: Sums of labels broadcast up to so many rows; beyond that a label's rows are dealt over so many keys.
BROADCAST_ROWS, SALTS = 100_000, 32


class Tree:
    """A kd-tree over the integer entries of one codebook; nodes are numbered from 0, the children of k are 2 k + 1 and 2 k + 2."""

    def __init__(self, entries: np.ndarray, leaf: int = LEAF):
        self.entries = np.ascontiguousarray(entries, np.int64)
        self.floats = self.entries.astype(np.float64)
        self.squares = (self.floats**2).sum(1)
        self.members: dict[int, np.ndarray] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.low: dict[int, np.ndarray] = {}
        self.high: dict[int, np.ndarray] = {}
        todo = [(0, np.arange(len(entries)))]
        while todo:
            node, own = todo.pop()
            points = self.entries[own]
            self.low[node], self.high[node] = points.min(0), points.max(0)
            spread = self.high[node] - self.low[node]
            if len(own) <= leaf or not spread.any():  # a part without components has no spread
                self.members[node] = np.sort(own)
                continue
            axis = int(np.argmax(spread))
            order = own[np.argsort(points[:, axis], kind="stable")]
            half = len(order) // 2
            self.split[node] = axis, int(self.entries[order[half], axis])
            todo += [(2 * node + 1, order[:half]), (2 * node + 2, order[half:])]

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lowest index among the nearest entries of each query, and the squared distance."""
        most = int(max(np.abs(queries).max(initial=0), np.abs(self.entries).max(initial=0)))
        # Whole numbers of this size are exact in doubles, whose matrix products are faster.
        self.queried = (queries.astype(np.float64), (queries.astype(np.float64) ** 2).sum(1)) if 4 * most * most * max(queries.shape[1], 1) < EXACT else None
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.entries))
        home = self._home(queries)
        for node in np.unique(home).tolist():  # a first bound from the leaf that a query falls into
            self._compare(node, queries, np.flatnonzero(home == node), best, index)
        stack = [(0, np.arange(len(queries)))]
        while stack:
            node, at = stack.pop()
            at = at[self._bound(node, queries[at]) <= best[at]]  # equal bounds stay: a lower index may be there
            if not len(at):
                continue
            if node in self.members:
                self._compare(node, queries, at[home[at] != node], best, index)
            else:
                stack += [(2 * node + 1, at), (2 * node + 2, at)]
        return index, best

    def _home(self, queries: np.ndarray) -> np.ndarray:
        node = np.zeros(len(queries), np.int64)
        todo = [0]
        while todo:
            k = todo.pop()
            if k in self.split:
                axis, value = self.split[k]
                at = np.flatnonzero(node == k)
                node[at] = 2 * k + 1 + (queries[at, axis] >= value)
                todo += [2 * k + 1, 2 * k + 2]
        return node

    def _bound(self, node: int, queries: np.ndarray) -> np.ndarray:
        off = queries - np.clip(queries, self.low[node], self.high[node])
        return np.einsum("ij,ij->i", off, off)

    def _compare(self, node: int, queries: np.ndarray, at: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        own = self.members[node]
        if self.queried is not None:
            floats, squares = self.queried
            far = (squares[at][:, None] + self.squares[own] - 2 * (floats[at] @ self.floats[own].T)).astype(np.int64)
        else:
            off = queries[at][:, None, :] - self.entries[own][None, :, :]
            far = np.einsum("ijk,ijk->ij", off, off)
        pick = far.argmin(1)  # members ascend, so the first least one has the lowest index
        least, who = far[np.arange(len(at)), pick], own[pick]
        won = (least < best[at]) | ((least == best[at]) & (who < index[at]))
        best[at[won]], index[at[won]] = least[won], who[won]


def scaled(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -MOST, MOST).astype(np.int64)


def part_bounds(width: int, parts: int) -> list[tuple[int, int]]:
    return [(width * k // parts, width * (k + 1) // parts) for k in range(parts)]


def usable(rows: DataFrame) -> DataFrame:
    """Rows (id, vector, carried columns) whose vector is there and finite throughout."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite))


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column("vector")
    return scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width))


def _assigned(batch: pa.RecordBatch, width: int, bounds, trees: list[Tree]):
    """(vectors, entry of each part, squared distance of each part) of some rows at a time."""
    for a in range(0, batch.num_rows, AT_ONCE):
        piece = batch.slice(a, AT_ONCE)
        vectors = _vectors(piece, width)
        found = [tree.nearest(vectors[:, x:y]) for (x, y), tree in zip(bounds, trees)]
        yield piece, vectors, [f[0] for f in found], [f[1] for f in found]


def first_entries(kept: DataFrame, entries: int) -> np.ndarray:
    """The vectors of least id as integers, one a row; at most ``entries`` rows reach the driver."""
    rows = kept.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    rows = [r.vector for r in rows if len(r.vector) == len(rows[0].vector)]
    return scaled(np.array(rows, np.float64)) if rows else np.zeros((0, 0), np.int64)


def sums(kept: DataFrame, width: int, bounds, books: list[np.ndarray]) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
    """Count and componentwise sum of the parts assigned to each entry that has any."""
    shared = kept.sparkSession.sparkContext.broadcast([Tree(b) for b in books])  # entries times width

    def add(batches):
        total = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for batch in batches:
            for _, vectors, who, _ in _assigned(batch, width, bounds, shared.value):
                for k, (a, b) in enumerate(bounds):
                    order = np.argsort(who[k], kind="stable")
                    used, first, count = np.unique(who[k][order], return_index=True, return_counts=True)
                    total[k][used, :-1] += np.add.reduceat(vectors[order, a:b], first, axis=0)
                    total[k][used, -1] += count
        for k, t in enumerate(total):
            used = np.flatnonzero(t[:, -1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(list(t[used]), pa.list_(pa.int64()))], names=["part", "entry", "total"])

    partial = kept.select("vector").mapInArrow(add, "part int, entry int, total array<bigint>")
    added = partial.select("part", "entry", F.posexplode("total").alias("at", "value")).groupBy("part", "entry", "at").agg(F.sum("value").alias("value"))
    out: dict = {}
    for r in added.collect():  # as many rows as the codebooks have components
        out.setdefault((r.part, r.entry), {})[r.at] = r.value
    shared.destroy()
    return {key: (row[len(row) - 1], np.array([row[k] for k in range(len(row) - 1)], np.int64)) for key, row in out.items()}


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after all rounds, of rows with (id, vector) as ``usable`` gives them; entries that no part is assigned to stay."""
    start = first_entries(kept, entries)
    width = start.shape[1]
    bounds = part_bounds(width, parts)
    books = [start[:, a:b].copy() for a, b in bounds]
    kept = kept.where(F.size("vector") == width)
    for _ in range(rounds if len(start) else 0):
        for (k, entry), (count, total) in sums(kept, width, bounds, books).items():
            books[k][entry] = total // count  # floors, for negative sums as well
    return books


def encode(kept: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The rows without their vector, with ``code`` (an entry number for each part) and ``error``, the squared distances' sum."""
    width, others = sum(b.shape[1] for b in books), [c for c in kept.columns if c != "vector"]
    bounds = part_bounds(width, len(books))
    shared = kept.sparkSession.sparkContext.broadcast([Tree(b) for b in books] if len(books[0]) else None)

    def assign(batches):
        for batch in batches:
            for piece, _, who, far in _assigned(batch, width, bounds, shared.value):
                code = pa.array(list(np.stack(who, 1).astype(np.int32)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in others), code, pa.array(np.sum(far, 0))], names=[*others, "code", "error"])

    fields = ", ".join(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in others)
    return kept.where(F.size("vector") == width).mapInArrow(assign, f"{fields}, code array<int>, error bigint")


def with_group_sum(coded: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over rows of an equal ``group``, nulls together. No group lands in one task, however large."""
    totals = coded.groupBy(F.col(group).alias("_group")).agg(F.sum(value).alias(name))
    if rows_of(totals) <= BROADCAST_ROWS:
        return coded.join(F.broadcast(totals), F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    dealt = coded.withColumn("_salt", (F.rand(SALTS) * SALTS).cast("int"))
    spread = totals.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(spread, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_salt") == F.col("_part"))).drop("_group", "_salt", "_part")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", carry: Sequence[str] = ()) -> tuple[DataFrame, list[np.ndarray]]:
    """The coded rows (id, carried columns, code, error) as a written table, and the codebooks, one array a part."""
    clash = {"code", "error", id_col} & set(carry)
    if clash:
        raise ValueError(f"carried columns named like those of the result: {sorted(clash)}")
    inner = {c: f"_in{k}" for k, c in enumerate(carry)}
    kept = usable(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), *(F.col(f"`{c}`").alias(n) for c, n in inner.items())))
    books = train(kept, parts, entries, rounds)
    coded = encode(kept, books).select(F.col("id").alias(id_col), *(F.col(n).alias(c) for c, n in inner.items()), "code", "error")
    return scratch(coded, "vector-codes"), books


def decode(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The rows with ``approximation``, the vector that a code stands for."""
    shared = [[[float(x) / SCALE for x in row] for row in b] for b in books]
    spark = coded.sparkSession
    rows = [(k, e, row) for k, b in enumerate(shared) for e, row in enumerate(b)]
    table = spark.createDataFrame(rows, "part int, entry int, piece array<double>").agg(F.map_from_entries(F.collect_list(F.struct(F.struct("part", "entry"), "piece"))).alias("_pieces"))
    pieces = F.transform("code", lambda e, k: F.element_at("_pieces", F.struct(k.alias("part"), e.alias("entry"))))
    return coded.join(F.broadcast(table)).withColumn("approximation", F.flatten(pieces)).drop("_pieces")


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in order of part, entry and position."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def op13(spark, sf_dir: str) -> DataFrame:
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), carry=["label"])
    code = F.array_join(F.transform("code", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    return with_group_sum(coded, "label", "error", "label_error").select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op13_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """Each round as a join of all parts with all entries of their codebook; for small tables."""
    steps = [
        f"""
kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row, vec_id, label, embedding FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pieces AS MATERIALIZED (
    SELECT row, vec_id, label, p AS part, list_transform(embedding[p * len(embedding) // {parts} + 1:(p + 1) * len(embedding) // {parts}], lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS piece
    FROM kept, range({parts}) AS r(p)),
book0 AS MATERIALIZED (SELECT part, row AS entry, piece AS value FROM pieces WHERE row < {entries})"""
    ]
    for k in range(rounds + 1):
        far = "list_sum(list_transform(list_zip(piece, value), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
        steps.append(
            f"""
near{k} AS MATERIALIZED (
    SELECT row, any_value(vec_id) AS vec_id, any_value(label) AS label, part, any_value(piece) AS piece, min((far, entry)) AS best
    FROM (SELECT *, {far} AS far FROM pieces JOIN book{k} USING (part)) GROUP BY row, part)"""
        )
        if k < rounds:
            steps.append(
                f"""
means{k} AS MATERIALIZED (
    SELECT part, entry, list((total - (total % n + n) % n) // n ORDER BY pos) AS value FROM (
        SELECT part, best[2] AS entry, pos, sum(piece[pos])::BIGINT AS total, count(*) AS n FROM (SELECT *, unnest(range(1, len(piece) + 1)) AS pos FROM near{k}) GROUP BY part, entry, pos)
    GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(m.value::BIGINT[], b.value) AS value FROM book{k} AS b LEFT JOIN means{k} AS m USING (part, entry))"""
            )
    return f"""
WITH {",".join(steps)},
coded AS (
    SELECT row, any_value(vec_id) AS vec_id, any_value(label) AS label, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error FROM near{rounds} GROUP BY row)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(array_to_string(value, ','), ',' ORDER BY part, entry)) FROM book{rounds}) AS codebooks_sha256
FROM coded"""
