"""Cleaning of names, categories, addresses and links, in built-in functions only."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Letters with marks that the stored function norm() replaces, and their plain forms (fixed values).
MARKED = "ÁÀÄÂÃÉÈËÊÍÌÏÎÓÒÖÔÕÚÙÜÛÑáàäâãéèëêíìïîóòöôõúùüûñ"
PLAIN = "AAAAAEEEEIIIIOOOOOUUUUNaaaaaeeeeiiiiooooouuuun"


def plain(x: Column) -> Column:
    return F.translate(x, MARKED, PLAIN)


def norm(x: Column) -> Column:
    """Lower case without the marks of MARKED, blanks collapsed and trimmed; null instead of nothing."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(plain(x)), r"\s+", " ")), F.lit(""))


def create_norm(spark: SparkSession, name: str = "norm") -> None:
    """Makes ``norm`` a temporary function of the session, for use in SQL texts."""
    spark.sql(rf"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS STRING RETURN nullif(trim(regexp_replace(lower(translate(coalesce(t, ''), '{MARKED}', '{PLAIN}')), r'\s+', ' ')), '')""")


def stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def _letters() -> tuple[str, str]:
    """All Latin letters whose canonical decomposition is one letter and marks, and those letters."""
    plain_of = {chr(c): "".join(x for x in unicodedata.normalize("NFD", chr(c)) if unicodedata.category(x) != "Mn") for a, b in ((0xC0, 0x250), (0x1E00, 0x1F00)) for c in range(a, b)}
    pairs = [(x, y) for x, y in plain_of.items() if len(y) == 1 and x != y]
    return "".join(x for x, _ in pairs), "".join(y for _, y in pairs)


def unaccented(x: Column) -> Column:
    """Lower case, trimmed, without any marks; an empty text for null."""
    marked, bare = _letters()
    return F.regexp_replace(F.translate(F.lower(stripped(F.coalesce(x, F.lit("")))), marked, bare), r"\p{Mn}", "")


def same_name(a: Column, b: Column) -> Column:
    """Equal but for case, accents and outer blanks; false if either is missing or empty."""
    return F.coalesce((F.nullif(unaccented(a), F.lit("")) == unaccented(b)), F.lit(False))


def norm_alnum(x: Column) -> Column:
    """Only a-z and 0-9 of the lower-cased text; letters with marks go."""
    return F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]", "")


def clean_name(x: Column) -> Column:
    """Trimmed, blanks collapsed, one quotation mark off each end."""
    return F.regexp_replace(F.trim(F.regexp_replace(x, r"\s+", " ")), "^[\"']|[\"']$", "")


def coordinates(url: Column) -> Column:
    """struct(lat, lng) of a map link: /@lat,lng,NNz first, then !3dlat!4dlng; null fields if neither is there."""
    number = r"(-?[0-9]+\.[0-9]+)"
    pair = lambda pattern: F.struct(*(F.regexp_extract(url, pattern, k).try_cast("double").alias(n) for k, n in ((1, "lat"), (2, "lng"))))
    view, pin = pair(f"/@{number},{number},[0-9]+z"), pair(f"!3d{number}!4d{number}")
    return F.when(view["lat"].isNotNull() & view["lng"].isNotNull(), view).otherwise(pin)


def place_id(url: Column) -> Column:
    """What follows data= to the end; else what follows the last slash (closing ones aside) if it has neither = nor @."""
    data = F.nullif(F.regexp_extract(url, "data=(.+)$", 1), F.lit(""))
    tail = F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)
    return F.coalesce(data, F.when((tail != "") & ~tail.contains("=") & ~tail.contains("@"), tail))


#: Parts of raw categories and the categories they mean, tried in this order (fixed values).
CATEGORY_PARTS = (
    ("restaurante", "restaurante"),
    ("restaurant", "restaurante"),
    ("supermercado", "supermercado"),
    ("supermarket", "supermercado"),
    ("farmacia", "farmacia"),
    ("pharmacy", "farmacia"),
    ("estacion de servicio", "estacion de servicio"),
    ("gas station", "estacion de servicio"),
    ("hotel", "hotel"),
    ("hospital", "hospital"),
    ("clinica", "clinica"),
    ("colegio", "colegio"),
    ("school", "colegio"),
    ("universidad", "universidad"),
    ("university", "universidad"),
    ("banco", "banco"),
    ("bank", "banco"),
    ("mecanico", "mecanico"),
    ("tienda de ropa", "tienda de ropa"),
    ("clothing store", "tienda de ropa"),
    ("ferreteria", "ferreteria"),
    ("hardware store", "ferreteria"),
    ("veterinaria", "veterinaria"),
    ("gimnasio", "gimnasio"),
    ("gym", "gimnasio"),
    ("peluqueria", "peluqueria"),
    ("panaderia", "panaderia"),
    ("bakery", "panaderia"),
    ("carniceria", "carniceria"),
    ("verduleria", "verduleria"),
    ("libreria", "libreria"),
    ("bookstore", "libreria"),
)


def category_by_part(x: Column, table: tuple[tuple[str, str], ...] = CATEGORY_PARTS, missing: str = "sin categoria", empty: str = "Sin categoria") -> Column:
    """The value of the first key that the lower-cased, trimmed text contains; else that text."""
    low = stripped(F.lower(F.coalesce(x, F.lit(missing))))
    out = F.when(low == "", empty)
    for key, value in table:
        out = out.when(low.contains(key), value)
    return out.otherwise(low)


def distinct_join(*parts: Column) -> Column:
    """Different non-empty parts in their order, joined by comma and space; null if there are none."""
    given = F.filter(F.array(*(F.trim(p) for p in parts)), lambda p: p.isNotNull() & (p != ""))
    return F.nullif(F.array_join(F.array_distinct(given), ", "), F.lit(""))


#: What stands before the category in a card's raw text (fixed values).
RATED, UNRATED = r"\d\.\d\s+(.*)$", r"(?i)no hay opiniones\s+(.*)$"


def rating_category(x: Column) -> Column:
    """What follows a rating like 4.5, else what follows the note that there are no opinions; null if neither is there."""
    tail = lambda pattern: stripped(F.regexp_extract(x, pattern, 1))
    return F.when(x.rlike(RATED), tail(RATED)).when(x.rlike(UNRATED), tail(UNRATED))


def maps_url(lat: Column, lng: Column, zoom: Column, query: Column) -> Column:
    return F.concat(F.lit("https://www.google.com/maps/search/"), F.replace(F.url_encode(query), F.lit("+"), F.lit("%20")), F.lit("/@"), F.format_string("%.6f", lat), F.lit(","), F.format_string("%.6f", lng), F.lit(","), zoom.cast("string"), F.lit("z"))


def decimal_of(x: Column) -> Column:
    return x.try_cast("decimal(18,4)")


def double_of(x: Column) -> Column:
    return x.try_cast("double")


def date_of_epoch(x: Column) -> Column:
    return F.to_date(F.timestamp_seconds(x))


def timestamp_of_epoch(x: Column) -> Column:
    """Null for a missing or zero time."""
    return F.when(x != 0, F.timestamp_seconds(x))


def tolerant_json(x: Column, schema: str) -> Column:
    """The record of a JSON text; a record without fields for a text that is none, and for null."""
    got = F.from_json(x, schema, {"mode": "PERMISSIVE"})
    return F.coalesce(got, F.from_json(F.lit("{}"), schema))


def short_url(links: Column, language: str) -> Column:
    """The first link of an array of struct(lang, url) in the language."""
    return F.get(F.filter(links, lambda x: x["lang"] == language), 0)["url"]
