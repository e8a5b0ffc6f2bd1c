"""Token counts with a whole-token shortcut.

Offline, before any text is read, each string of the vocabulary is tried: those that the
splitting pattern keeps whole and the merges turn into a single token are proven. Pieces of
text that are proven strings count 1 by a lookup; only the rest goes through the merges,
and their counts are remembered up to a bound. Each code point is also tried: a text that has one which the
library's splitter takes for another kind of character than ours is split by the library's, and its pieces
are counted like all others.

The tokenizer is a byte-level BPE file of the ``tokenizers`` library; its path is a parameter
and must be readable on every executor. Strings of special tokens inside a text count as
that one token, which is the library's default. Null texts are read as empty: 0 bytes and 0
tokens. Texts are cut into pieces lazily, so very long ones need no long lists. Repeated rows
are counted each. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import functools
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

LIMIT = 1024
#: Pieces whose counts a task remembers, and the longest of them.
REMEMBERED, LONGEST = 400_000, 64
#: Texts up to so many characters are cut at once.
AT_ONCE = 1_000_000
#: How byte-level BPE of this family splits texts (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if visible in Latin-1, else the next one from U+0100 on."""
    visible = [33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 for b in range(256)]
    spare = iter(range(256, 512))
    return [chr(b) if v else chr(next(spare)) for b, v in enumerate(visible)]


class Counter(dict):
    """Tokens of a piece; proven strings are there from the start."""

    def __init__(self, path: str, proven=()):
        from tokenizers import Tokenizer

        super().__init__(dict.fromkeys(proven, 1))
        self.room = len(self) + REMEMBERED
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = {b: x for b, x in enumerate(byte_letters())}

    def merge(self, piece: str) -> int:
        return len(self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters)))

    def __missing__(self, piece: str) -> int:
        n = self.merge(piece)
        if len(piece) <= LONGEST and len(self) < self.room:
            self[piece] = n
        return n


#: Code points outside these ranges are private or unassigned, in planes that no splitter knows.
ASSIGNED = ((0, 0xD800), (0xE000, 0x40000), (0xE0000, 0xE1000))


@functools.lru_cache(2)
def disputed(path: str) -> str:
    """A pattern of the code points that the library's splitter takes for another kind (letter, number, blank, other) than ours; it may be empty."""
    import regex
    from tokenizers import Tokenizer

    theirs, ours, step = Tokenizer.from_file(path).pre_tokenizer, regex.compile(PATTERN), 4000
    codes, found = [c for a, b in ASSIGNED for c in range(a, b)], []
    for i in range(0, len(codes), step):
        own = codes[i : i + step]
        tried = "".join(f" a{chr(c)}1!{chr(c)}!" for c in own)  # each kind is cut in another way
        other = {at for _, (at, _) in theirs.pre_tokenize_str(tried)} ^ {m.start() for m in ours.finditer(tried)}
        found += [own[k] for k in sorted({at // 7 for at in other})]
    runs = ([c for _, c in g] for _, g in groupby(enumerate(found), lambda x: x[1] - x[0]))
    body = "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)
    return f"[{body}]" if body else ""


@functools.lru_cache(4)
def specials(path: str):
    import regex
    from tokenizers import Tokenizer

    found = [t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()]
    return regex.compile("|".join(map(regex.escape, sorted(found, key=len, reverse=True)))) if found else None


@functools.lru_cache(4)
def prove(path: str) -> tuple[str, ...]:
    """The vocabulary strings that are one piece and one token by themselves."""
    import regex
    from tokenizers import Tokenizer

    counter, whole = Counter(path), regex.compile(PATTERN)
    back = {ord(x): b for b, x in enumerate(byte_letters())}
    added = {t.content for t in counter.tokenizer.get_added_tokens_decoder().values()}
    proven = []
    for entry in Tokenizer.from_file(path).get_vocab():
        try:
            text = bytes(back[ord(x)] for x in entry).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if entry not in added and whole.findall(text) == [text] and counter.merge(text) == 1:
            proven.append(text)
    return tuple(sorted(proven))


def count_text(text: str, counter: Counter, pattern, special, odd) -> int:
    parts = special.split(text) if special else [text]
    total = len(parts) - 1
    for part in parts:
        if odd and not part.isascii() and odd.search(part):
            total += sum(counter[part[a:b]] for _, (a, b) in counter.tokenizer.pre_tokenizer.pre_tokenize_str(part))
        elif len(part) <= AT_ONCE:
            total += sum(map(counter.__getitem__, pattern.findall(part)))
        else:
            total += sum(counter[m.group()] for m in pattern.finditer(part))
    return total


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit."""
    shared = docs.sparkSession.sparkContext.broadcast((prove(path), disputed(path)))  # as many strings as the vocabulary has, at most

    def count(batches):
        import regex

        proven, odd = shared.value
        counter, pattern, special, odd = Counter(path, proven), regex.compile(PATTERN), specials(path), regex.compile(odd) if odd else None
        for whole in batches:
            for batch in small_batches(whole):
                texts = batch.column("text")
                n = np.fromiter((count_text(t.as_py() or "", counter, pattern, special, odd) for t in texts), np.int64, len(texts))
                size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id"), size, pa.array(n)], names=["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(count, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op8(spark, sf_dir: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    import public_tokenizers

    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path(tokenizer))
