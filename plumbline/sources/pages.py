"""Rows out of web pages and reports."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, href) of each link."""
    return pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"'), F.lit(1))).alias("pos", "href"))


def titles(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.nullif(F.trim(F.regexp_extract("html", r"(?s)<title[^>]*>(.*?)</title>", 1)), F.lit("")).alias("title"))


def embedded_points(pages: DataFrame, key: str = "page_id", text: str = "html") -> DataFrame:
    """(key, pos, lng, lat, type, cat, name) of the {"coordinates":"POINT(..)","type",…} records in a report's text."""
    pattern = r'\{"coordinates":"POINT ?\((-?[0-9.]+) (-?[0-9.]+)\)","type":"((?:[^"\\]|\\.)*)","cat":"((?:[^"\\]|\\.)*)","name":"((?:[^"\\]|\\.)*)"'
    groups = F.arrays_zip(*(F.regexp_extract_all(text, F.lit(pattern), F.lit(k)).alias(n) for k, n in enumerate(("lng", "lat", "type", "cat", "name"), 1)))
    rows = pages.select(key, F.posexplode(groups).alias("pos", "g"))
    plain = lambda c: F.from_json(F.concat(F.lit('{"v":"'), c, F.lit('"}')), "v string")["v"]
    return rows.select(key, "pos", F.col("g.lng").try_cast("double").alias("lng"), F.col("g.lat").try_cast("double").alias("lat"), *(plain(F.col(f"g.{n}")).alias(n) for n in ("type", "cat", "name")))


#: Strings as a whole, with their escapes, or a single bracket.
_TOKENS = re.compile(r'"(?:[^"\\]|\\.)*"|[\[\]]', re.S)


def bracketed(text: str | None, marker: str) -> str | None:
    """The balanced [...] after a marker; brackets in double-quoted strings don't count."""
    start = -1 if text is None else text.find(marker)
    start = text.find("[", start) if start >= 0 else -1
    if start < 0:
        return None
    depth = 0
    for token in _TOKENS.finditer(text, start):
        depth += {"[": 1, "]": -1}.get(token.group(), 0)
        if not depth:
            return text[start : token.end()]
    return None


def script_array(html: Column, marker: str, schema: str) -> Column:
    """The array that a page's script assigns after ``marker``, as array<struct>; null if there is none."""
    # Rows reach a plain function by the hundred; an Arrow batch would hold ten thousand pages of any size at once.
    cut = F.udf(lambda page: bracketed(page, marker), "string", useArrow=False)
    return F.from_json(cut(html), f"array<struct<{schema}>>")


def wiki_districts(text: DataFrame, column: str = "text") -> DataFrame:
    """(pos, name) of the first cell links in a wiki table's lines, first spelling of each name; file and header lines are skipped."""
    from ..operators.dedup import first_by

    lines = text.select(F.posexplode(F.split(column, "\n")).alias("pos", "line")).where(F.col("line").startswith("|") & ~F.col("line").contains("colspan") & ~F.col("line").contains("Archivo:"))
    name = F.trim(F.regexp_replace(F.regexp_extract("line", r"\[\[(?:[^\]|]*\|)?([^\]|]+)\]\]", 1), r"\s*\([^)]*\)", ""))
    return first_by(lines.select("pos", name.alias("name")).where(F.col("name") != ""), [F.lower("name")], ["pos"])
