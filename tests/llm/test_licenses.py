"""The license scan against plain loops and an edit-distance table."""

import random
import re

import pytest

from plumbline.llm import licenses

from . import cases

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def base(text):
    """(number of words, [(first word, label)]) of the contract's phrases."""
    w = WORDS.findall((text or "").translate(LOWER))
    hits = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    return len(w), sorted(hits)


def least_edits(needle: str, text: str) -> int:
    """Fewest edits between the needle and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(needle, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(last + (c != d), row[j] + 1, row[j - 1] + 1)
    return min(row)


def edited(r: random.Random, text: str, n: int) -> str:
    out = list(text)
    for _ in range(n):
        at = r.randrange(len(out))
        kind = r.randrange(3)
        out[at : at + (kind != 1)] = [] if kind == 0 else [r.choice("abcdefgz ")]
    return "".join(out)


def texts():
    r = random.Random(3)
    prose = lambda n: " ".join(r.choice(["software", "the", "license", "général", "free", "public", "gnu", "word"]) for _ in range(n))
    out = [None, "", "MIT License", "mit\n\nLICENSE mit license", "the GNU General, Public (License) v3", "xmit license", "mit licenses", "apache", "license apache", "General public", "mit license " * 200]
    for notice in licenses.NOTICES:
        for n in range(notice.most_edits + 3):
            out.append(prose(r.randrange(12)) + "\n# " + edited(r, notice.words, n) + " ... " + prose(r.randrange(12)))
    return out


@pytest.fixture(scope="module")
def found(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return rows, {r.doc_id: r for r in licenses.license_scan(docs).collect()}


def test_base_places(found):
    for k, text in found[0]:
        got, (n, hits) = found[1][k], base(text)
        assert got.n_words == n and sorted((p.word, p.label) for p in got.places) == hits
        for p in got.places:
            assert WORDS.findall(text[p.start : p.end].translate(LOWER)) == p.phrase.split()


def test_notices_are_those_within_the_edits(found):
    hits = 0
    for k, text in found[0]:
        plain = " ".join(WORDS.findall((text or "").translate(LOWER)))
        expected = {n.words for n in licenses.NOTICES if least_edits(n.words.encode().decode("latin-1"), plain.encode().decode("latin-1")) <= n.most_edits}
        assert {x.notice for x in found[1][k].notices} == expected, text
        hits += len(expected)
    assert hits > 40


def test_spans_hold_what_is_reported(found):
    for k, text in found[0]:
        for x in found[1][k].notices:
            stretch = " ".join(WORDS.findall(text[x.start : x.end].translate(LOWER)))
            assert least_edits(x.notice, stretch) <= x.edits <= next(n.most_edits for n in licenses.NOTICES if n.words == x.notice)


def test_awkward_rows_and_empty_tables(spark):
    docs = spark.createDataFrame(cases.rows(), cases.SCHEMA)
    got = licenses.license_scan(docs)
    assert got.columns == ["doc_id", "n_words", "places", "notices"] and got.count() == len(cases.rows())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_words) for r in got.collect()) == sorted((k is not None, k or 0, base(t)[0]) for k, t, *_ in cases.rows())
    assert licenses.license_scan(docs.limit(0)).count() == 0


def test_a_long_text_and_own_notices(spark):
    filler = "lörem ipsum dolor " * 80_000
    text = filler + "Redistribution and  use in sourze and binary forms, with or without modification " + filler + "mit license"
    docs = spark.createDataFrame([(1, text), (1, "own notize here")], "doc_id int, text string")
    row = max(licenses.license_scan(docs).collect(), key=lambda r: r.n_words)
    assert [(x.label, x.edits, text[x.start : x.start + 14]) for x in row.notices] == [("bsd", 1, "Redistribution")] and [p.start for p in row.places] == [len(text) - 11]
    own = licenses.license_scan(docs, notices=[("mine", "own notice here", 1)], phrases=[])
    assert sorted([x.label for x in r.notices] for r in own.collect()) == [[], ["mine"]]
    assert all(not r.notices for r in licenses.license_scan(docs, notices=[]).collect())


def test_a_notice_needs_more_characters_than_edits():
    with pytest.raises(ValueError, match="more characters"):
        licenses.Scanner((), [licenses.Notice("x", "abc", 3)])
