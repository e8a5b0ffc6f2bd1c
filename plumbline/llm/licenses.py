"""License scans: base phrases as runs of words, and short notices with a bounded number of edits.

A text is normalised to its words (letters, digits and all characters beyond ASCII; A-Z lower-cased) with one blank between
them. A notice of at most k edits is split into k + 1 pieces; wherever it occurs, one piece at least is unchanged. The exact
pieces of all notices are found together, each names a window of the text, overlapping windows of one notice are merged, and
the ``regex`` library's bounded-error matching verifies them and tells the span and the edits. So a notice is reported
in a text exactly if some stretch of it is within k insertions, deletions and substitutions of characters.

The scan is one pass over the rows without a shuffle; a text is scanned whole, whatever its length, and memory follows the
size of a batch. Null texts are read as empty: no words, no labels, score 0. Repeated rows and ids are judged each. Columns
other than the id and the text are not read, so their names can't clash. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, small_batches, utf8_buffers
from .decontaminate import word_bytes

#: Base phrases and their labels (fixed values of the contract).
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


class Notice(NamedTuple):
    label: str
    words: str
    most_edits: int


#: Short notices; the edits allowed are fewer than what tells a notice from the like wording of another license.
NOTICES = (
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 3),
    Notice("mit", "released under the mit license", 1),
    Notice("apache", "licensed under the apache license version 2 0", 3),
    Notice("gpl", "licensed under the gnu general public license", 3),
    Notice("gpl", "this program is free software you can redistribute it and or modify", 3),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("agpl", "gnu affero general public license", 3),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 3),
    Notice("mpl", "subject to the terms of the mozilla public license", 3),
    Notice("cc-by", "licensed under cc by", 1),
    Notice("cc", "licensed under a creative commons attribution", 3),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 3),
)

FOUND = "array<struct<label:string,phrase:string,start:bigint,end:bigint,word:bigint>>"
NEAR = "array<struct<label:string,notice:string,start:bigint,end:bigint,edits:bigint>>"


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice in edits + 1 pieces of nearly one length, each with its offset."""
    cuts = [len(notice) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


class Scanner:
    """What a task needs to scan texts."""

    def __init__(self, phrases: Sequence[tuple[str, str]], notices: Sequence[Notice]):
        import ahocorasick
        import regex

        for n in notices:
            if len(n.words) <= n.most_edits:
                raise ValueError(f"a notice needs more characters than edits: {n}")
        self.notices, self.is_word = notices, word_bytes()
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.hasher = WordHasher(self.is_word)
        self.phrases = []
        for words, label in phrases:
            raw = np.frombuffer(words.encode(), np.uint8)
            self.phrases.append((words, label, self.hasher(raw, np.array([0, len(raw)]))[3]))
        self.patterns = [regex.compile(f"(?e)(?:{regex.escape(n.words)}){{e<={n.most_edits}}}") for n in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(notices):
            for offset, piece in pieces(n.words, n.most_edits):
                seeds.setdefault(piece, []).append((k, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, owners in seeds.items():
            self.seeds.add_word(piece, (len(piece), owners))
        if seeds:
            self.seeds.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each notice the merged stretches of a normalised text in which it may stand."""
        found: dict[int, list[list[int]]] = {}
        if not len(self.seeds):
            return found
        for last, (length, owners) in self.seeds.iter(text):
            for k, offset in owners:
                most = self.notices[k].most_edits
                a = last + 1 - length - offset - most
                b = a + len(self.notices[k].words) + 2 * most
                found.setdefault(k, []).append([max(a, 0), b])
        for k, spans in found.items():
            spans.sort()
            merged = spans[:1]
            for a, b in spans[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            found[k] = merged
        return found

    def near(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) in a normalised text, without overlaps within a notice."""
        out = []
        for k, spans in sorted(self.windows(text).items()):
            for a, b in spans:
                out += [(k, m.start(), m.end(), sum(m.fuzzy_counts)) for m in self.patterns[k].finditer(text, a, b)]
        return out

    def places(self, data: np.ndarray, words: tuple) -> list[tuple[int, int, int, int]]:
        """(phrase, first word, first byte, end) of every place of every phrase in a batch."""
        first, end, text, h = words
        out = []
        for k, (phrase, _, wanted) in enumerate(self.phrases):
            m = len(wanted)
            if not m or len(h) < m:
                continue
            at = np.flatnonzero(h[: len(h) - m + 1] == wanted[0])
            for j in range(1, m):
                at = at[(h[at + j] == wanted[j]) & (text[at + j] == text[at])]
            for i in at.tolist():
                read = b" ".join(self.lower[data[first[i + j] : end[i + j]]].tobytes() for j in range(m))
                if read == phrase.encode():  # hashes only propose
                    out.append((k, i, int(first[i]), int(end[i + m - 1])))
        return out

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8_buffers(batch.column("text"))
        words = self.hasher(data, offsets)
        n = len(offsets) - 1
        first_word = np.searchsorted(words[2], np.arange(n + 1))
        found: list[list] = [[] for _ in range(n)]
        near: list[list] = [[] for _ in range(n)]
        points: dict[int, np.ndarray] = {}

        def code_points(doc: int, at: int) -> int:
            if doc not in points:  # only texts with findings pay for it
                points[doc] = np.concatenate([[0], np.cumsum((data[offsets[doc] : offsets[doc + 1]] & 0xC0) != 0x80)])
            return int(points[doc][at - offsets[doc]])

        for k, i, a, b in sorted(self.places(data, words), key=lambda p: (p[1], p[0])):
            doc, (phrase, label, _) = int(words[2][i]), self.phrases[k]
            found[doc].append({"label": label, "phrase": phrase, "start": code_points(doc, a), "end": code_points(doc, b), "word": i - int(first_word[doc])})
        inside = self.is_word[data]
        keep = inside.copy()
        keep[1:] |= inside[:-1]  # the first blank or mark after a word stands for all up to the next one
        origin = np.flatnonzero(keep)
        plain = np.where(inside, self.lower[data], 32)[keep].astype(np.uint8)
        cuts = np.searchsorted(origin, offsets)
        for doc in range(n):
            c = int(cuts[doc])
            for k, a, b, edits in self.near(plain[c : cuts[doc + 1]].tobytes().decode("latin-1")):
                if b > a:
                    start, stop = int(origin[c + a]), int(origin[c + b - 1]) + 1
                    while data[start] & 0xC0 == 0x80:  # an edit may have cut a character
                        start -= 1
                    while stop < offsets[doc + 1] and data[stop] & 0xC0 == 0x80:
                        stop += 1
                    notice = self.notices[k]
                    near[doc].append({"label": notice.label, "notice": notice.words, "start": code_points(doc, start), "end": code_points(doc, stop), "edits": edits})
        columns = [batch.column("id"), pa.array(np.diff(first_word).astype(np.int64)), pa.array(found, _ARROW_FOUND), pa.array(near, _ARROW_NEAR)]
        return pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "places", "notices"])


def _arrow(*fields: tuple[str, pa.DataType]) -> pa.DataType:
    return pa.list_(pa.struct([pa.field(n, t) for n, t in fields]))


_ARROW_FOUND = _arrow(("label", pa.string()), ("phrase", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("word", pa.int64()))
_ARROW_NEAR = _arrow(("label", pa.string()), ("notice", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64()))


def license_scan(docs: DataFrame, notices: Sequence[Notice] = NOTICES, phrases: Sequence[tuple[str, str]] = PHRASES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, ``places`` of base phrases (code points, end exclusive, and the first word's number)
    and near ``notices`` with their spans and edits, both in order."""
    notices, phrases = tuple(Notice(*n) for n in notices), tuple(phrases)

    def scan(batches):
        scanner = Scanner(phrases, notices)
        for whole in batches:
            for batch in small_batches(whole):
                yield scanner(batch)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scanned = rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, n_words bigint, places {FOUND}, notices {NEAR}")
    return scanned.withColumnRenamed("id", id_col)


def score(notices: Column, places: Column) -> Column:
    """1 for a base phrase, else the best notice's share of unchanged characters, else 0."""
    best = F.array_max(F.transform(notices, lambda s: 1 - s["edits"] / F.length(s["notice"])))
    return F.when(F.size(places) > 0, 1.0).otherwise(F.greatest(F.coalesce(best, F.lit(0.0)), F.lit(0.0)))


def op11(spark, sf_dir: str) -> DataFrame:
    scanned = license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    starts, base = F.transform("places", lambda s: s["word"]), F.transform("places", lambda s: s["label"])
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), listed(base).alias("base_labels"),
        listed(F.concat(base, F.transform("notices", lambda s: s["label"]))).alias("labels"), score(F.col("notices"), F.col("places")).alias("score"), F.to_json("notices").alias("notices"),
    )
