"""Vector codes against plain integer loops."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from plumbline.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, id int"


def plain(rows, parts, entries, rounds):
    """({row number: (code, error)}, books) by loops over Python's integers."""
    ok = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not ok:
        return [], []
    width = len(ok[0][1])
    cut = [(width * k // parts, width * (k + 1) // parts) for k in range(parts)]
    vectors = [[math.floor(1024 * x) for x in r[1]] for r in ok]
    books = [[v[a:b] for v in vectors[:entries]] for a, b in cut]

    def nearest(piece, book):
        return min((sum((x - y) ** 2 for x, y in zip(piece, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for (a, b), book in zip(cut, books):
            mine = {}
            for v in vectors:
                mine.setdefault(nearest(v[a:b], book)[1], []).append(v[a:b])
            for k, pieces in mine.items():
                book[k] = [sum(x) // len(pieces) for x in zip(*pieces)]
    coded = []
    for r, v in zip(ok, vectors):
        best = [nearest(v[a:b], book) for (a, b), book in zip(cut, books)]
        coded.append((r[0], r[2], [k for _, k in best], sum(d for d, _ in best)))
    return coded, books


def vectors(n=300, width=8, levels=None):
    r = random.Random(n)
    draw = (lambda: r.choice(levels)) if levels else (lambda: r.gauss(0, 0.2))
    rows = [(k * 7 % n, [float(np.float32(draw())) for _ in range(width)], r.choice([None, 1, 1, 1, 2]), "x", k) for k in range(n)]
    rows += [(n, None, 1, "x", 0), (n + 1, [None] + [0.0] * (width - 1), 1, None, 0), (n + 2, [float("nan")] * width, 1, None, 0), (-1, [float("inf")] + [0.0] * (width - 1), 1, None, 0), (n + 3, [], 1, None, 0)]
    return [*rows, rows[0], rows[0], (None, [0.0] * width, 2, "x", 0)]


def check(spark, rows, parts=4, entries=16, rounds=3):
    coded, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), parts, entries, rounds, carry=["label"])
    expected, expected_books = plain(rows, parts, entries, rounds)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.vec_id, r.label, list(r.code), r.error) for r in coded.collect()), key=key) == sorted(expected, key=key)
    assert [b.tolist() for b in books] == expected_books
    return coded, books


def test_against_plain_loops(spark):
    coded, books = check(spark, vectors())
    near = vector_codes.decode(coded, books).first()
    assert near.approximation == [x / 1024 for k, b in zip(near.code, books) for x in b[k].tolist()]


def test_ties_go_to_the_lower_index(spark):
    check(spark, vectors(200, levels=[-0.5, 0.0, 0.5, 1.0]))
    check(spark, vectors(60, levels=[0.25]))  # all entries alike


@pytest.mark.parametrize("n, width, parts, entries", [(5, 8, 4, 16), (80, 10, 4, 9), (80, 3, 4, 8), (50, 6, 1, 50)])
def test_few_rows_and_uneven_parts(spark, n, width, parts, entries):
    check(spark, vectors(n, width), parts, entries, 2)


def test_tree_visits_equal_bounds():
    r = np.random.default_rng(2)
    for size, width, most in ((256, 4, 4), (256, 16, 300), (7, 2, 3), (100, 1, 20), (64, 4, 1 << 26)):  # the last beyond what doubles hold
        entries, queries = r.integers(-most, most + 1, (size, width)), r.integers(-most - 2, most + 3, (500, width))
        far = ((queries[:, None, :] - entries[None]) ** 2).sum(2)
        for leaf in (1, 3, 16, 400):
            index, best = vector_codes.Tree(entries, leaf).nearest(queries)
            assert (index == far.argmin(1)).all() and (best == far.min(1)).all()


def test_other_widths_large_values_and_empty_tables(spark):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    coded, books = vector_codes.compress(make([(2, [1e30] * 4, 1, "", 0), (1, [0.5] * 4, 1, "", 0), (3, [0.5] * 8, 1, "", 0)]), 2, 4, 1)
    assert sorted(r.vec_id for r in coded.collect()) == [1, 2] and max(abs(b).max() for b in books) <= vector_codes.MOST
    for rows in ([], [(1, None, 1, "", 0)]):
        coded, books = vector_codes.compress(make(rows), carry=["label"])
        assert coded.count() == 0 and coded.columns == ["vec_id", "label", "code", "error"] and vector_codes.digest(books) == hashlib.sha256(b"").hexdigest()
        assert vector_codes.with_group_sum(coded, "label", "error", "label_error").count() == 0
    with pytest.raises(ValueError, match="carried columns"):
        vector_codes.compress(make([]), carry=["code"])
    both, _ = vector_codes.compress(make([(1, [0.5] * 4, 1, "x", 9)]), carry=["id"])  # a name of the operator's own
    assert both.first().id == 9


@pytest.mark.parametrize("broadcast", [vector_codes.BROADCAST_ROWS, 0])
def test_group_sums(spark, monkeypatch, broadcast):
    monkeypatch.setattr(vector_codes, "BROADCAST_ROWS", broadcast)
    rows = [(k, [None, 1, 2][k % 3], k) for k in range(90)]
    got = vector_codes.with_group_sum(spark.createDataFrame(rows, "k int, g int, v long"), "g", "v", "s").collect()
    assert sorted((r.k, r.s) for r in got) == [(k, sum(v for _, h, v in rows if h == g)) for k, g, _ in rows]


def test_query_and_sql(spark, tmp_path):
    rows = [(k, v, label) for k, v, label, *_ in vectors(400, 16) if v is None or len(v)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, vector_codes.op13(spark, str(tmp_path)).collect()), key=key) == sorted(con.sql(vector_codes.op13_sql()).fetchall(), key=key)
