"""Every operator on a text of more than a million characters, its copy, its near copy, and short texts beside them."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, jaccard_join, line_dedup, mixing, pii, quality_model, quality_rules, secrets, suffix_dedup, token_counts


@pytest.fixture(scope="module")
def long():
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(r.randrange(2, 10))) for _ in range(20_000)]
    lines = [" ".join(r.choice(words) for _ in range(12)) for _ in range(15_000)]
    text = "\n".join(lines)
    assert len(text) > 1_000_000
    return text


@pytest.fixture(scope="module")
def docs(spark, long):
    at = len(long) // 2
    near = long[:at] + " password=abcdefgh12345 call +1 (555) 123-4567 one two three four five six seven eight nine ten " + long[at:]
    rows = [(1, long, "a"), (2, long, "a"), (3, near, "b"), (4, long[at : at + 3000], None), (5, "short", "b"), (None, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3).persist()


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_rules_and_quality(spark, docs, long):
    got = by_id(quality_rules.quality_rules(docs))
    assert got[1].n_words == len(long.split()) and got[1].word_chars == sum(map(len, long.split())) and got[1].n_dup_lines == 0
    scored = by_id(quality_model.score(docs, quality_model.train(docs, spark.createDataFrame([(1, 1), (5, 0)], "doc_id int, quality int"))))
    assert scored[1].score == scored[2].score and len(scored) == 6


def test_personal_data_and_secrets(docs):
    found = by_id(pii.find_pii(docs))
    assert [s["kind"] for s in found[3].spans if s["base"]] == ["phone"] and found[1].spans == []
    secret = by_id(secrets.secret_scan(docs)[0])
    assert [s["kind"] for s in secret[3].findings] == ["assign"] and secret[1].findings == []


def test_repeats(docs, long):
    lines = by_id(line_dedup.repeated_lines(docs))
    assert lines[1].removed == [] and len(lines[2].removed) == 15_000 and 14_900 < len(lines[3].removed) < 15_000
    spans = by_id(suffix_dedup.remove_repeats(docs))
    size = len(long.encode())
    assert [(s.start, s.end) for s in spans[1].spans] == [(0, size)] and bytes(spans[1].kept) == b""
    assert bytes(spans[3].kept).decode() == " password=abcdefgh12345 call +1 (555) 123-4567 one two three four five six seven eight nine ten "
    assert bytes(spans[4].kept) == b"" and bytes(spans[5].kept) == b"short"


def test_components(docs):
    assert {k: r.component_id for k, r in by_id(jaccard_join.components(docs)).items()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, None: None}


def test_contamination(spark, docs):
    items = spark.createDataFrame([(7, "ONE two three four five six seven eight nine ten eleven")], "item_id int, text string")
    assert {k: r.n_hit for k, r in by_id(decontaminate.contamination(docs, items)).items()} == {1: 0, 2: 0, 3: 10, 4: 0, 5: 0, None: 0}


def test_tokens_and_mixture(docs, long):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert by_id(token_counts.token_counts(docs, path))[1].n_tokens == len(Tokenizer.from_file(path).encode(long, add_special_tokens=False).ids)
    mixed = mixing.mix(docs).agg(F.sum("taken").alias("n"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).first()
    assert mixed.n > 0 and mixed.over <= 0
