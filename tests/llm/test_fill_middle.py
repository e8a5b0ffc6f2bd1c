"""Fill-in-middle against plain Python, and its exact round trip."""

import hashlib
import random
import re

import pytest

from plumbline.llm import fill_middle

from . import cases


def expected(key, text, unit=r"[^\n]*\n|[^\n]+", rate=100, suffix_first=50, seed=7):
    text = text or ""
    units = re.findall(unit, text, re.S if unit == "." else 0)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return key, len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    first = h[3] % 100 < suffix_first
    return key, len(units), "spm" if first else "psm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}" if first else f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    r = random.Random(4)
    out = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "a\nb", "a\r\nb\r\n", "has <P> a mark", "<S", "<M\nM>\n<", "é\nü\n🙂🙂\nß", "x" * 500 + "\n" + "y" * 500]
    out += ["".join(r.choice("ab é🙂\n\n<>PSM") for _ in range(r.randrange(300))) for _ in range(150)]
    return out


@pytest.mark.parametrize("chunk", [1, 7, 64, fill_middle.CHUNK])
@pytest.mark.parametrize("unit, pattern", [("line", r"[^\n]*\n|[^\n]+"), ("character", ".")])
def test_against_plain_python(spark, chunk, unit, pattern):
    rows = list(enumerate(texts()))
    got = fill_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), unit=unit, chunk=chunk)
    assert sorted(map(tuple, got.collect())) == [expected(k, t, pattern) for k, t in rows]


def test_rates_and_seed(spark):
    rows = [(f"id{k}", f"a{k}\nb\nc\nd") for k in range(300)]
    got = fill_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id string, text string"), rate=60, suffix_first=20, seed=3)
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(k, t, rate=60, suffix_first=20, seed=3) for k, t in rows), key=str)
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}


def test_awkward_rows_round_trip_and_empty_tables(spark):
    docs = spark.createDataFrame(cases.rows(), cases.SCHEMA).repartition(3)
    got = fill_middle.fill_in_middle(docs)
    key = lambda r: (r[0] is not None, r[0] or 0, r[5])
    assert sorted(map(tuple, got.collect()), key=key) == sorted((expected(k, t) for k, t, *_ in cases.rows()), key=key)
    back = got.select("doc_id", fill_middle.restored(got["form"], got["output"]).alias("text")).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(k), t or "") for k, t, *_ in cases.rows())
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="unit is one of"):
        fill_middle.fill_in_middle(docs, unit="word")


def test_a_long_text(spark):
    r = random.Random(1)
    text = "".join("wörd " * r.randrange(9) + "\n" for _ in range(120_000))
    assert len(text) > 2_000_000
    rows = [(1, text), (2, text[:-1]), (3, text.replace("\n", " "))]
    got = fill_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id int, text string"))
    assert sorted(map(tuple, got.collect())) == [expected(k, t) for k, t in rows]
