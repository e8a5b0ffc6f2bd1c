"""Result cards of a map's search page: rows, and how often a category was found.

A page is read once by the standard library's parser into the few elements that matter; pages go through in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import coordinates, place_id

#: Ratings, labels of review counts and counts in brackets (fixed patterns).
STARS, COUNTED, BRACKETED = r"\d+[.,]?\d*", "reseñas|opiniones", r"\((\d[\d,.]*)\s*(?:reseñas?|opiniones?|reviews?)?\)"
#: Marks of the page's elements (fixed values).
FEED, PLACE_LINK, CONTAINER, CARD, RATING = "feed", "/maps/place/", "Nv2PK", "hfpxzc", "ZkP5Je"
#: Currency marks, notes of no opinions, and the beginnings of an opening state (fixed values).
PRICES, NO_OPINIONS, STATES = ("₲", "PYG"), ("No hay opiniones", "No hay reseñas"), ("Abierto", "Cerrado", "Cierra", "Abre")
SITE = "https://www.google.com"
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Element:
    def __init__(self, name: str, attributes: dict, parent: Element | None):
        self.name, self.attributes, self.parent, self.children = name, attributes, parent, []

    def has_class(self, name: str) -> bool:
        return name in self.attributes.get("class", "").split()

    def all(self) -> Iterator[Element]:
        """The elements within, in the order of the page; long chains don't recurse."""
        rest = [c for c in reversed(self.children) if isinstance(c, Element)]
        while rest:
            one = rest.pop()
            yield one
            rest += [c for c in reversed(one.children) if isinstance(c, Element)]

    def texts(self) -> list[str]:
        out, rest = [], list(reversed(self.children))
        while rest:
            one = rest.pop()
            if isinstance(one, Element):
                rest += reversed(one.children)
            elif one.strip():
                out.append(one.strip())
        return out

    @property
    def text(self) -> str:
        return " ".join(self.texts())

    def up(self) -> Iterator[Element]:
        at = self.parent
        while at is not None:
            yield at
            at = at.parent


class Tree(HTMLParser):
    def __init__(self, html: str):
        super().__init__()
        self.root = self.at = Element("", {}, None)
        self.feed(html)
        self.close()

    def handle_starttag(self, name, attributes):
        new = Element(name, {k: v or "" for k, v in attributes}, self.at)
        self.at.children.append(new)
        if name not in VOID:
            self.at = new

    def handle_startendtag(self, name, attributes):
        self.at.children.append(Element(name, {k: v or "" for k, v in attributes}, self.at))

    def handle_endtag(self, name):
        opened = next((e for e in (self.at, *self.at.up()) if e.name == name), None)
        if opened is not None and opened.parent is not None:
            self.at = opened.parent

    def handle_data(self, data):
        self.at.children.append(data)


def _figure(text: str) -> bool:
    """Digits only, but for separators."""
    return re.sub(r"[.,· ]", "", text).isdigit()


def details(box: Element | None, name: str) -> tuple[str, str, float | None, int | None]:
    """Category, address, rating and number of reviews in a card's container."""
    if box is None:
        return "", "", None, None
    inside = list(box.all())
    rating = reviews = None
    starred = next((e for e in inside if e.name == "span" and e.has_class(RATING)), None)
    if starred is not None and (m := re.search(STARS, starred.attributes.get("aria-label") or starred.text)):
        rating = float(m.group().replace(",", "."))
    labelled = any(e.name == "span" and re.search(COUNTED, e.attributes.get("aria-label", "")) for e in inside)
    if not labelled and (m := re.search(BRACKETED, box.text, re.I)):
        reviews = int(re.sub("[,.]", "", m.group(1)))
    category, address = _dotted(inside) or (_lone(inside, name), "")
    for state in STATES:
        if (at := address.find(state)) > 0:
            address = address[:at].strip()
            break
    return category, address, rating, reviews


def _dotted(inside: list[Element]) -> tuple[str, str] | None:
    """From the first text like "category · address" that is no price, figure or rating."""
    for e in inside:
        text = e.text
        if "·" not in text or any(p in text for p in PRICES) or _figure(text) or re.search(r"\(\d+", text):
            continue
        parts = [p.strip() for p in text.split("·")]
        if len(parts[0]) > 1:
            # A mark of one or two characters may stand between them.
            return parts[0], parts[1] if len(parts[1]) > 2 else (parts[2] if len(parts) > 2 else "")
    return None


def _lone(inside: list[Element], name: str) -> str:
    """The first short text that is neither the name, a figure, an icon, a price nor a rating."""
    for e in inside:
        text = e.text
        if e.name not in ("div", "span") or not text or len(text) > 60 or re.sub(r"[., ]", "", text).isdigit() or any(ord(c) > 0xE000 for c in text) or any(p in text for p in (*PRICES, *NO_OPINIONS)):
            continue
        if name and text.startswith(name):
            text = text[len(name) :].strip()
        if len(text) >= 2 and not re.search(r"\d[.,]\d", text):
            return text
    return ""


def read_cards(html: str | None) -> Iterator[tuple]:
    """(pos, name, category, address, href, rating, reviews) of a page's cards; the first of each name."""
    seen: set[str] = set()
    for link in Tree(html or "").root.all():
        href, name = link.attributes.get("href", ""), link.attributes.get("aria-label", "")
        if link.name != "a" or PLACE_LINK not in href or not name or name in seen or not any(e.name == "div" and e.attributes.get("role") == FEED for e in link.up()):
            continue
        seen.add(name)
        box = next((e for e in link.up() if e.name == "div" and e.has_class(CONTAINER)), None)
        category, address, rating, reviews = details(box, name)
        yield len(seen) - 1, name.strip(), category, address, href, rating, reviews


def result_cards(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """A row for each card: key, pos, name, lat, lng (0 without a place), category, address, source_url, google_place_id, rating, review_count."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [key, "pos", "name", "category", "address", "href", "rating", "review_count"]
        for frame in frames:
            rows = [(k, *card) for k, text in zip(frame[key], frame[html]) for card in read_cards(text)]
            out = pd.DataFrame(rows, columns=names).astype({"rating": "float64", "review_count": "Int64"})
            yield out

    kind = pages.schema[key].dataType.simpleString()
    cards = pages.select(key, html).mapInPandas(read, f"`{key}` {kind}, pos int, name string, category string, address string, href string, rating double, review_count bigint")
    at, href = coordinates(F.col("href")), F.col("href")
    url = F.when(href.startswith("/"), F.concat(F.lit(SITE), href)).otherwise(href)
    return cards.select(key, "pos", "name", F.coalesce(at["lat"], F.lit(0.0)).alias("lat"), F.coalesce(at["lng"], F.lit(0.0)).alias("lng"), "category", "address", url.alias("source_url"), place_id(href).alias("google_place_id"), "rating", "review_count")


def extraction_rates(pages: DataFrame, cards: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """For each page: links of cards, different results, results with and without a category, and the share with one in per cent."""
    links = pages.select(key, F.regexp_count(F.coalesce(html, F.lit("")), F.lit(rf'<a\b[^>]*class="[^"]*\b{CARD}\b')).cast("bigint").alias("total_cards"))
    counts = cards.groupBy(key).agg(F.count("*").alias("unique_results"), F.count_if(F.col("category") != "").alias("with_category"))
    both = links.join(counts, key, "left").na.fill(0, ["unique_results", "with_category"])
    rate = F.round(F.col("with_category") / F.greatest("unique_results", F.lit(1)) * 100)
    return both.withColumn("without_category", F.col("unique_results") - F.col("with_category")).withColumn("success_rate", rate)


def extraction_report(pages: DataFrame, cards: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``extraction_rates`` with a line for all pages together (``overall``, without a key), both out of one rollup."""
    each = extraction_rates(pages, cards, key, html)
    sums = ("total_cards", "unique_results", "with_category", "without_category")
    both = each.rollup(key).agg((F.grouping(key) == 1).alias("overall"), *(F.sum(c).alias(c) for c in sums))
    return both.withColumn("success_rate", F.round(F.col("with_category") / F.greatest("unique_results", F.lit(1)) * 100))
