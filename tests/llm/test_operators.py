"""Each operator on a table of awkward rows, on an empty table, and against brute force."""

import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, jaccard_join, line_dedup, mixing, pii, quality_model, quality_rules, secrets, suffix_dedup, token_counts

from . import cases

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(cases.rows(), cases.SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], cases.SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(cases.BENCH, "item_id bigint, text string")


def pairs():
    return [(r[0], r[1]) for r in cases.rows()]


def key(row):
    return tuple((x is not None, x) for x in row)


def same(got, expected):
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", pairs())
    return con


def test_quality_rules(docs, empty, duck):
    got = quality_rules.quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    same(got.collect(), duck.sql(quality_rules.op1_sql()).fetchall())
    assert quality_rules.quality_rules(empty).count() == 0
    assert {r.doc_id for r in got.where("kept").collect()} >= {6}  # a filter on the verdict works, too; 10 has no stop words


def test_repeated_words_by_hand(spark):
    text = "a b c d e f g h x a b c d e f g h i"
    row = quality_rules.statistics(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert (row.n_words, row.n_repeat_words) == (18, 16)


def test_secrets(docs, empty, duck):
    findings, ledger = secrets.secret_scan(docs)
    of = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("findings", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    got = findings.select("doc_id", *map(of, secrets.BASE_KINDS), F.sha2(secrets.joined(base), 256), secrets.joined(F.col("findings")))
    same(got.collect(), duck.sql(secrets.op5_sql()).fetchall())
    assert secrets.secret_scan(empty)[0].count() == 0


def test_ledger_scans_only_what_is_new(spark):
    make = lambda rows: spark.createDataFrame(rows, "doc_id string, text string")
    first, ledger = secrets.secret_scan(make([("a", "password=abcdefgh1"), ("b", "nothing")]))
    again, more = secrets.secret_scan(make([("a", "password=abcdefgh1"), ("c", "token=12345678"), ("d", "password=abcdefgh1")]), ledger)
    assert more.count() == 1
    assert {r.doc_id: len(r.findings) for r in again.collect()} == {"a": 1, "c": 1, "d": 1}
    assert secrets.secret_scan(make([("a", "x")]), ledger, rule_version="other")[1].count() == 1


@pytest.mark.parametrize("broadcast", [secrets.BROADCAST_ROWS, 0])
def test_ledger_over_several_runs(docs, monkeypatch, broadcast):
    monkeypatch.setattr(secrets, "BROADCAST_ROWS", broadcast)
    scanned = []
    scan = secrets.scan
    monkeypatch.setattr(secrets, "scan", lambda blobs, rules: scanned.append(blobs.count()) or scan(blobs, rules))
    at_once, _ = secrets.secret_scan(docs)
    runs = [docs.where("row % 3 = 0"), docs.where("row % 3 = 1"), docs.where("row % 3 = 2 or row is null"), docs]
    got = secrets.scan_history(runs[:3]).withColumn("findings", F.to_json("findings"))
    same(got.collect(), [tuple(r) for r in at_once.withColumn("findings", F.to_json("findings")).collect()])
    scanned.clear()
    secrets.scan_history(runs)
    assert scanned[-1] == 0  # all is in the ledger by then


def test_line_dedup(docs, empty, duck):
    got = line_dedup.repeated_lines(docs)
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    same(got.select("doc_id", "n_lines", F.size("removed").cast("bigint"), spans).collect(), duck.sql(line_dedup.op3_sql()).fetchall())
    kept = {r.doc_id: r.text for r in line_dedup.remove_repeated_lines(docs).collect()}
    assert kept[20] == "line one of five words\nshort\n"  # the line feed after a removed line goes with it
    assert {r.doc_id: r.text for r in line_dedup.remove_repeated_lines(docs, min_words=5).collect()}[20] == "line one of five words\nshort\nshort"
    assert line_dedup.repeated_lines(empty).count() == 0 and line_dedup.remove_repeated_lines(docs).columns == docs.columns


@pytest.mark.parametrize("length, sizes, hot", [(200, {}, None), (40, {}, None), (60, {"shard_bytes": 3000, "range_windows": 500}, 3)])
def test_suffix_dedup(docs, monkeypatch, length, sizes, hot):
    if hot:
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        monkeypatch.setattr(suffix_dedup, "HOT_PART", 0)
    got = suffix_dedup.remove_repeats(docs, length, **sizes)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    same(got.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect(), cases.without_repeats(pairs(), length))


def test_suffix_dedup_empty(empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_dedup_of_rows_without_id(spark):
    rows = cases.null_id_rows()
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    same(got.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect(), cases.without_repeats(rows, 200))


def test_suffix_merge_is_dealt_without_hot_anchors(spark, monkeypatch):
    ranges, sizes = suffix_dedup.ranges, []

    def counted(lists, range_windows):
        got = ranges(lists, range_windows)
        sizes.extend(r.n for r in got.groupBy("part").agg((F.sum(F.octet_length("once") + F.octet_length("several")) / 8).alias("n")).collect())
        return got

    monkeypatch.setattr(suffix_dedup, "ranges", counted)
    r = np.random.default_rng(4)
    word = lambda: "".join(map(chr, r.integers(97, 123, 8)))
    passage = " ".join(word() for _ in range(8))
    # Repeats of one passage in other surroundings, in many texts and within one: cut by shards, far from hot.
    rows = [(k, " ".join([word() for _ in range(9)] + [passage] + [word() for _ in range(9)])) for k in range(60)]
    rows += [(60, " ".join(" ".join([word() for _ in range(9)] + [passage]) for _ in range(40))), (61, rows[0][1] + " end"), (62, "start " + rows[1][1])]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 100, shard_bytes=2000, range_windows=500)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    same(got.select("doc_id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect(), cases.without_repeats(rows, 100))
    assert len(sizes) > 5 and max(sizes) < 1500


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    lasts = np.array([1500, 1600, 4000])
    starts = np.array([0, 1500, 1600])
    order, rank = suffix_dedup.suffix_order(data, starts, lasts, 24)
    raw = data.tobytes()
    windows = [raw[i : i + 24] for i in order]
    assert windows == sorted(windows) and len(order) == 4000 - 3 * 23
    common = suffix_dedup.kasai(data, order, starts, lasts, 24)
    for i in range(1, len(order)):
        n = next((k for k in range(24) if windows[i][k] != windows[i - 1][k]), 24)
        assert common[i] == n and (rank[i] == rank[i - 1]) == (n == 24)


@pytest.mark.parametrize("bits", [jaccard_join.FILTER_BITS, 15])
def test_jaccard_components(docs, monkeypatch, bits):
    monkeypatch.setattr(jaccard_join, "FILTER_BITS", bits)  # with few bits all shingles pass the filter
    got = jaccard_join.components(docs)
    same(got.collect(), cases.component_ids(pairs()))


def test_jaccard_chains_and_crowds(spark):
    words = [f"w{i}" for i in range(400)]
    chain = [(i, " ".join(words[6 * i : 6 * i + 100])) for i in range(40)]  # each links with the next one only
    crowd = [(100 + i, " ".join(words[:50] + [f"v{i}"] + words[50:100])) for i in range(60)]
    rows = chain + crowd + [(500, "a b c d e f"), (501, "g h i j k l")]
    got = jaccard_join.components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    same(got.collect(), cases.component_ids(rows))


def test_jaccard_components_of_rows_without_id(spark):
    rows = cases.null_id_rows()
    got = jaccard_join.components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    same(got.collect(), cases.component_ids(rows))


def test_one_of_each(docs, empty):
    kept = jaccard_join.one_of_each(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and ids.count(6) == 1 and 7 not in ids and 8 not in ids and {0, 1, 2, 10} <= set(ids)
    assert jaccard_join.components(empty).count() == 0


def test_one_of_each_tells_rows_of_one_id_apart(spark):
    words = [f"w{i}" for i in range(300)]
    a, b, c, d = (" ".join(words[k : k + 70]) for k in (0, 70, 140, 210))
    rows = [(1, a), (2, a + " end"), (2, b), (2, b), (None, a + " more"), (None, c), (None, c + " end"), (None, c), (3, d), (3, d.replace(" ", "  ")), (3, None), (3, ""), (None, ""), (None, None), (None, None)]
    kept = [tuple(r) for r in jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    long = [r for r in kept if r[1]]
    same([r for r in kept if not r[1]], [(3, None), (3, ""), (None, ""), (None, None)])
    assert len(long) == 4 and {(1, a), (2, b)} < set(long)
    assert [k for k, t in long if t in (c, c + " end")] == [None] and [k for k, t in long if t.split() == d.split()] == [3]


@pytest.mark.parametrize("most", [decontaminate.AUTOMATON_WORDS, 8])
def test_contamination(docs, benchmark, most):
    got = decontaminate.contamination(docs, benchmark, most=most).select("doc_id", "n_words", "n_hit", "items")
    items = [r for r in cases.BENCH]
    same([(r.doc_id, r.n_words, r.n_hit, tuple(r.items)) for r in got.collect()], cases.contamination(pairs(), items))


def test_contamination_by_items_without_id_or_repeated(spark, docs):
    rows = [(None, "one two three four five six seven eight nine ten eleven twelve"), (7, "short item"), (7, "short item"), (8, "short item"), (9, "wörds äre words")]
    got = decontaminate.contamination(docs, spark.createDataFrame(rows, "item_id bigint, text string"))
    by_id = {r.doc_id: (r.n_hit, r["items"]) for r in got.collect()}
    assert by_id[18] == (11, [None]) and by_id[19] == (5, ["7", "8", "9"]) and by_id[10] == (0, [])


def test_benchmark_parts_are_bounded(spark):
    rows = [(k, " ".join(["ab"] * 50)) for k in range(60)] + [(100, "x " * 400)]
    parts = list(decontaminate.benchmark_parts(spark.createDataFrame(rows, "item_id bigint, text string"), "item_id", "text", 300))
    assert sorted(int(i) for p in parts for i, _ in p) == [*range(60), 100]
    assert all(len(p) == 1 or sum(len(t.split()) for _, t in p) <= 300 for p in parts)


def test_decontaminate_cuts_spans(docs, benchmark, empty):
    out = decontaminate.decontaminate(docs, benchmark)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns
    assert texts[10] == cases.texts()[10] and 18 not in texts and texts[0] is None
    cut = decontaminate.decontaminate(docs, benchmark, max_coverage=1.0)
    assert {r.doc_id: r.text for r in cut.collect()}[18] == "start  end"
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert decontaminate.contamination(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    got = token_counts.token_counts(docs, TOKENIZER, limit=100)
    expected = [(k, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 100) for k, t in pairs()]
    same(got.collect(), expected)
    assert token_counts.token_counts(empty, TOKENIZER).count() == 0


def test_token_counts_of_any_characters(spark):
    from tokenizers import Tokenizer

    library, r = Tokenizer.from_file(TOKENIZER), np.random.default_rng(8)
    odd = [c for c in (0x558, 0xC5C, 0x1F642, 0x1FAE0, 0x2EBF0, 0x323AF, 0x10D4A, 0xA0, 0x3000, 0x200B, 0xE0041, 0x301, 0xFFFD)]
    text = lambda: "".join(chr(c) for c in np.where(r.random(300) < 0.2, r.choice(odd, 300), r.choice([*range(32, 127), 10, 233, 0x4E2D], 300)))
    rows = [(k, text()) for k in range(40)] + [(40, "a <|endoftext|>" + chr(0x558) * 3 + " b" * 5), (41, "word " * 400_000)]
    got = token_counts.token_counts(spark.createDataFrame(rows, "doc_id bigint, text string"), TOKENIZER)
    expected = [(k, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > token_counts.LIMIT) for k, t in rows]
    same(got.collect(), expected)


def test_proven_strings_are_single_tokens():
    from tokenizers import Tokenizer

    library, proven = Tokenizer.from_file(TOKENIZER), token_counts.prove(TOKENIZER)
    assert len(proven) > 45_000
    assert all(len(e.ids) == 1 for e in library.encode_batch(list(proven), add_special_tokens=False))


def test_quality_model(spark, docs, empty):
    labels = spark.createDataFrame([(k, int(k not in (13, 14)), 0) for k in range(21)] + [(6, 1, 0), (None, 1, 0), (7, None, 0)], "doc_id bigint, quality int, toxic int")
    model = quality_model.train(docs, labels)
    got = quality_model.score(docs, model)
    assert got.count() == docs.count() and got.where("score between 0 and 1").count() == docs.count()
    assert quality_model.keep_good(docs, model).columns == docs.columns
    nothing = quality_model.train(docs, labels.limit(0))
    assert {r.score for r in quality_model.score(docs, nothing).collect()} == {0.5}
    assert quality_model.score(empty, nothing).count() == 0


def test_trees_learn_held_out(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_model.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_quality_model_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    got = quality_model.op9(spark, d).where("held_out").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").toPandas()
    assert (got.predicted == got.quality).mean() > 0.9 and got[got.quality == 1].predicted.mean() > 0.98


def test_pii_base_and_model(docs, empty):
    got = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    text = cases.texts()[17]
    base = [(s["kind"], text[s["start"] : s["end"]]) for s in got[17] if s["base"]]
    assert base == [("email", "a.b@mail.example.com"), ("ip", "1.2.3.4"), ("card", "4539 1488 0343 6467"), ("phone", "+1 (555) 123-4567")]
    assert got[0] == got[1] == []
    out = pii.redact(docs)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns and texts[17].startswith("mail [EMAIL] or x@y, [IP] 300.1.1.1 card [CARD] and [PHONE] end") and texts[10] == cases.texts()[10]
    assert pii.find_pii(empty).count() == 0


def test_pii_base_is_the_contracts_patterns():
    r = np.random.default_rng(6)
    parts = ["1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "0001.2.3.4", "4539 1488 0343 6467", "4539148803436467", "4539-1488 03436467 12", "+1 (555) 123-4567", "+49 30", "+1 (826) 555-4081 190.137.2.3", "a.b@c.de", "@x.y", "a@b", "a@b.c@d.e", "é@x.com", "..@..", "a@-.-", " ", "-", ".", "12", "+", "(", "1" * 25, "9" * 16, "\n", "𝟙𝟚", "٣٤"]
    for _ in range(3000):
        text = "".join(r.choice(parts, 6)) if r.random() < 0.5 else " ".join(r.choice(parts, 6))
        assert pii.base_spans(text) == cases.base_pii(text), text


def test_op2_on_whole_documents(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    name = lambda spans: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
    count = lambda spans, k: sum(x[1] == k for x in spans)
    base = {r.doc_id: cases.base_pii(r.text) for r in docs}
    got = pii.op2(spark, d).collect()
    same([r[:6] for r in got], [(k, *(count(s, i) for i in range(4)), hashlib.sha256(name(s).encode()).hexdigest()) for k, s in base.items()])
    for r in got:
        assert set(filter(None, name(base[r.doc_id]).split(","))) <= set(r.spans.split(","))


def test_tagger_on_formats_that_it_never_saw_and_its_gradient():
    for lines, spans in (pii.labelled(200, 99), pii.held_out(200, 98)):
        found = pii.model_spans(lines, pii.trained())
        truth = {(n, *s) for n, own in enumerate(spans) for s in own}
        got = {(n, *s[:3]) for n, own in enumerate(found) for s in own}
        assert len(truth & got) / len(got) > 0.97 and len(truth & got) / len(truth) > 0.9
    lines, spans = pii.labelled(3, 97)
    text = "Call 555-123-4567 or 0171 1234567, write to jane.doe (at) mail.example.com; order 2024-05-06, pages 1990-1995, 9807915762804490."
    assert [(pii.KINDS[k], text[a:b]) for a, k, b, _ in pii.model_spans([text], pii.trained())[0]] == [("phone", "555-123-4567"), ("phone", "0171 1234567"), ("email", "jane.doe (at) mail.example.com")]
    tagger = pii.Tagger(1)
    ids, tags = (x[:3].T for x in pii.training_windows(lines[:3], spans[:3]))
    _, gradient = tagger.loss_and_gradient(ids, tags)
    for name, value in tagger.p.items():
        at = np.unravel_index(np.abs(gradient[name]).argmax(), value.shape)
        old, step, loss = value[at], 1e-3, []  # bends too much over larger steps
        for v in (old + step, old - step):
            value[at] = v
            loss.append(tagger.loss_and_gradient(ids, tags)[0])
        value[at] = old
        assert abs((loss[0] - loss[1]) / (2 * step) - gradient[name][at]) < 0.02 * abs(gradient[name][at]) + 0.02


def water(sizes: dict, weights=(1, 2, 3), cap=3) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in names if x not in full) for s in names if s not in full}
        over = {s for s in share if share[s] > cap * sizes[s]}
        if not over:
            return share | {s: cap * sizes[s] for s in full}
        full |= over


def test_mix(docs, empty, spark):
    rows = [(k, " ".join(["w"] * (k % 37)), ["a", "b", None, "z"][k % 4] if k % 20 else "rare") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(df).toPandas()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    expected = water(size)
    for s, want in expected.items():
        own = got[got.source.isna()] if s is None else got[got.source == s]
        assert abs(own.target.iloc[0] - want) < 1e-6 * max(1, want)
        assert abs(own.taken.sum() - want) <= 0.01 * want + 20
    assert (got.taken <= 3 * got["size"]).all()
    again = mixing.mix(df.repartition(5)).toPandas()
    assert sorted(zip(got.doc_id, got.taken)) == sorted(zip(again.doc_id, again.taken))
    assert mixing.mix(docs).count() == docs.count() and mixing.mix(empty).count() == 0


def test_digest_of_nothing_is_that_of_the_empty_string(docs, benchmark):
    assert hashlib.sha256(b"").hexdigest() == secrets.secret_scan(docs)[0].select(F.sha2(F.lit(""), 256)).first()[0]
