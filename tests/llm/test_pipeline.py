"""The pipeline's stages, each on its own input, against plain Python; and the whole run."""

import pytest

import corpus_pipeline
from plumbline.llm import quality_model

from . import cases


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Tables with awkward rows: nulls, repeated rows, extra columns with names of the operators' own."""
    where = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(cases.rows(), cases.SCHEMA).repartition(3).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(cases.BENCH, "item_id bigint, text string").write.parquet(f"{where}/benchmark.parquet")
    spark.createDataFrame([(k, int(k not in (13, 14)), 0) for k in range(21)] + [(7, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    return where


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").persist()


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_quality_keeps_what_the_model_accepts(spark, docs, sf):
    model = quality_model.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good = {(r.doc_id, r.text) for r in quality_model.score(docs, model, carry=("text",)).where("score >= 0.3").collect()}
    assert rows(corpus_pipeline.quality(spark, docs, sf)) == [r for r in rows(docs) if (r[0], r[1]) in good]


def test_near_duplicates_keep_one_of_each_component(spark, docs, sf):
    kept = rows(corpus_pipeline.near_duplicates(spark, docs, sf))
    pairs = [(r[0], r[1]) for r in cases.rows()]
    stay = {(k, t) for (k, t), (_, n, c) in zip(pairs, cases.component_ids(pairs)) if n == 0 or k == c}
    # Without an id a row stays only where no row of its component has one.
    linked = {c for _, n, c in cases.component_ids(pairs) if n and c is not None}
    assert {(r[0], r[1]) for r in kept} == stay | {(k, t) for (k, t), (_, n, c) in zip(pairs, cases.component_ids(pairs)) if k is None and c not in linked}
    assert len(kept) == len(set(kept)) and set(kept) <= set(rows(docs))


def test_benchmark_free_cuts_every_hit_word(spark, docs, sf):
    got = {r.doc_id: r for r in corpus_pipeline.benchmark_free(spark, docs, sf).collect()}
    pairs = [(r[0], r[1]) for r in cases.rows()]
    for (k, t), (_, n, hit, _) in zip(pairs, cases.contamination(pairs, cases.BENCH)):
        if k is None:
            continue
        assert (k in got) == (hit <= 0.5 * n)
        if k in got and not hit:
            assert got[k].text == t
    left = [(r.doc_id, r.text) for r in got.values()]
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())
    assert not any(hit for _, _, hit, _ in cases.contamination(left, cases.BENCH))


def test_personal_data_gives_way_to_its_kind(spark, docs, sf):
    got = {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, sf).collect()}
    names = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")
    for k, t in ((r[0], r[1]) for r in cases.rows()):
        spans, out, at = cases.base_pii(t), "", 0
        for a, rank, b in spans:
            if a >= at:
                out, at = out + t[at:a] + names[rank], b
        if spans:
            assert got[k] == out + t[at:]
        elif t is None or not any(c.isdigit() or c == "@" for c in t):
            assert got[k] == t
    assert corpus_pipeline.personal_data(spark, docs, sf).columns == docs.columns


def test_mixture_and_run(spark, docs, sf):
    mixed = corpus_pipeline.mixture(spark, docs, sf).collect()
    assert len(mixed) == docs.count() and all(r.taken == r.copies * r["size"] and 0 <= r.copies <= 3 for r in mixed)
    sizes = sorted((r[0] is not None, r[0], len(cases.WORD.findall(r[1] or ""))) for r in rows(docs))
    assert sorted((r.doc_id is not None, r.doc_id, r["size"]) for r in mixed) == sizes
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, sf).collect(), cases.SCHEMA)
    assert rows(corpus_pipeline.run(spark, sf)) == rows(corpus_pipeline.STAGES[-1][1](spark, now, sf))


def test_stages_on_empty_tables(spark, docs, sf, tmp_path):
    for t in ("benchmark", "labels"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    assert corpus_pipeline.benchmark_free(spark, docs, str(tmp_path)).count() == docs.count()
