"""Batches stored against a loop that takes one row after another, components, and counters."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import components, merge
from plumbline.streaming import steps

from .test_maps import metres

SCHEMA = "id long, name string, lat double, lng double, category string, phone string, google_place_id string, source_url string, is_active boolean"
COMING = SCHEMA.replace("id long", "seq long", 1).replace(", is_active boolean", "")


def loop(stored, incoming, reach=100.0):
    """(table as dicts, {seq: outcome}) of a store that looks, updates or inserts row by row, with unique place ids and urls."""
    table, outcome = [dict(r) for r in stored], {}
    for row in sorted(incoming, key=lambda r: r["seq"]):
        found = None
        for key in ("google_place_id", "source_url"):
            if found is None and row[key]:
                found = next((t for t in table if t["is_active"] and t[key] == row[key]), None)
        if found is None and row["name"]:
            near = lambda t: reach is None or metres(row["lat"], row["lng"], t["lat"], t["lng"]) <= reach
            found = next((t for t in sorted(table, key=lambda t: t["id"]) if t["is_active"] and t["name"] and t["name"].lower() == row["name"].lower() and near(t)), None)
        if any(row[k] and t is not found and t[k] == row[k] for k in ("google_place_id", "source_url") for t in table):
            outcome[row["seq"]] = "rejected"
        elif found is not None:
            found.update(category=row["category"], phone=row["phone"], source_url=row["source_url"] or found["source_url"], google_place_id=row["google_place_id"] or found["google_place_id"])
            outcome[row["seq"]] = "updated"
        else:
            table.append({"id": max([t["id"] for t in table], default=0) + 1, **{k: v for k, v in row.items() if k != "seq"}, "google_place_id": row["google_place_id"] or None, "source_url": row["source_url"] or None, "is_active": True})
            outcome[row["seq"]] = "inserted"
    return table, outcome


def batch(r, n, key, first):
    rows, names = [], ["Bar", "bar", "Café", "Hotel", None]
    for k in range(n):
        rows.append({
            key: first + k, "name": r.choice(names), "lat": -25 + r.randrange(12) * 0.0004, "lng": -57 + r.randrange(3) * 0.0006, "category": f"c{first + k}", "phone": r.choice([None, f"t{k}"]),
            "google_place_id": r.choice([None, None, "", f"p{r.randrange(12)}"]), "source_url": r.choice([None, None, f"u{r.randrange(12)}"]),
        })
    return rows


def unique(rows):
    seen, out = set(), []
    for row in rows:
        for k in ("google_place_id", "source_url"):
            if not row[k] or (k, row[k]) in seen:
                row[k] = None
            seen.add((k, row[k]))
        out.append(row)
    return out


def plain(rows):
    return sorted((tuple(r[c] for c in ("id", "name", "lat", "lng", "category", "phone", "google_place_id", "source_url", "is_active")) for r in rows), key=lambda r: r[0])


@pytest.mark.parametrize("seed, reach", [(1, 100.0), (2, 100.0), (3, None), (4, 60.0), (5, 100.0)])
def test_a_batch_equals_the_loop(spark, seed, reach):
    r = random.Random(seed)
    stored = [{**row, "is_active": r.random() < 0.8} for row in unique(batch(r, 15, "id", 1))]
    incoming = batch(r, 60, "seq", 0)
    expected, outcome = loop(stored, incoming, reach)
    assert len(set(outcome.values())) == 3 or seed == 3
    left = spark.createDataFrame([tuple(x[c.split()[0]] for c in SCHEMA.split(", ")) for x in stored], SCHEMA)
    right = spark.createDataFrame([tuple(x[c.split()[0]] for c in COMING.split(", ")) for x in incoming], COMING).repartition(3)
    got = {x.seq: x.outcome for x in merge.resolve(left, right, metres=reach).collect()}
    assert got == outcome
    assert plain(x.asDict() for x in merge.upsert(left, right, metres=reach).collect()) == plain(expected)


def test_rows_of_one_batch_meet(spark):
    empty = spark.createDataFrame([], SCHEMA)
    rows = [(1, "A", 1.0, 1.0, "x", None, "p1", None), (2, "B", 2.0, 2.0, "y", None, "p1", "u1"), (3, "C", 3.0, 3.0, "z", None, None, "u1"), (4, "a", 1.0, 1.0, "w", None, None, None)]
    got = merge.upsert(empty, spark.createDataFrame(rows, COMING)).collect()
    assert [(x.id, x.name, x.category, x.google_place_id, x.source_url, x.is_active) for x in got] == [(1, "A", "w", "p1", "u1", True)]
    assert merge.upsert(empty, spark.createDataFrame([], COMING)).count() == 0


def test_inactive_rows_match_nothing(spark):
    stored = spark.createDataFrame([(1, "A", 1.0, 1.0, None, None, "p1", "u1", False)], SCHEMA)
    rows = spark.createDataFrame([(1, "A", 1.0, 1.0, None, None, None, None), (2, "B", 1.0, 1.0, None, None, "p1", None)], COMING)
    assert merge.match_tiers(stored, rows).count() == 0
    assert {x.seq: x.outcome for x in merge.resolve(stored, rows).collect()} == {1: "inserted", 2: "rejected"}


def test_components(spark):
    r = random.Random(7)
    edges = [(k, k + 1) for k in range(100, 160)] + [(1000, k) for k in range(1001, 1040)] + [(r.randrange(2000, 2060), r.randrange(2000, 2060)) for _ in range(50)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    got = {x.node: x.root for x in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got.keys() == linked and len({(root(x), got[x]) for x in linked}) == len({root(x) for x in linked}) == len(set(got.values()))
    assert components.connected(spark.createDataFrame([(5, 5)], "a long, b long")).count() == 0


def test_stored_with_counts(spark, tmp_path):
    r = random.Random(11)
    stored = [{**row, "is_active": True} for row in unique(batch(r, 10, "id", 1))]
    incoming = batch(r, 40, "seq", 0)
    spark.createDataFrame([tuple(x[c.split()[0]] for c in SCHEMA.split(", ")) for x in stored], SCHEMA).write.parquet(f"{tmp_path}/t")
    rows = spark.createDataFrame([tuple(x[c.split()[0]] for c in COMING.split(", ")) for x in incoming], COMING)
    expected, outcome = loop(stored, [x for x in incoming if x["name"]])
    counts = merge.store_batch(spark, f"{tmp_path}/t", f"{tmp_path}/bad", rows)
    of = lambda kind: sum(o == kind for o in outcome.values())
    assert counts == {"inserted": of("inserted"), "updated": of("updated"), "quarantined": of("rejected") + sum(not x["name"] for x in incoming)}
    assert plain(x.asDict() for x in spark.read.parquet(f"{tmp_path}/t").collect()) == plain(expected)
    reasons = {x.reason: x.n for x in spark.read.parquet(f"{tmp_path}/bad").groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {k: v for k, v in {"no name": sum(not x["name"] for x in incoming), merge.CONFLICT: of("rejected")}.items() if v}
