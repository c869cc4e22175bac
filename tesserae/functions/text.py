"""Text functions as native column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_or_empty(x: Column | str) -> Column:
    return F.coalesce(_c(x), F.lit(""))


def list_or_empty(x: Column | str) -> Column:
    return F.coalesce(_c(x), F.array().cast("array<string>"))


def strip(x: Column | str) -> Column:
    """Unicode white space cut from both ends (Spark's trim cuts blanks alone)."""
    return F.regexp_replace(_c(x), r"(?U)^\s+|\s+$", "")


def clean(x: Column | str) -> Column:
    """White space collapsed and stripped; null as empty."""
    return F.trim(F.regexp_replace(text_or_empty(x), r"(?U)\s+", " "))


def or_null(x: Column | str) -> Column:
    """Null where empty."""
    return F.nullif(_c(x), F.lit(""))


def first_text(*xs: Column | str) -> Column:
    """The first that is neither null nor empty, else empty."""
    return F.coalesce(*[or_null(x) for x in xs], F.lit(""))


def doi_norm(x: Column | str) -> Column:
    return F.replace(F.replace(F.lower(_c(x)), F.lit("/"), F.lit("_")), F.lit(" "), F.lit(""))


def canonical_term(x: Column | str) -> Column:
    return F.replace(F.lower(strip(x)), F.lit(" "), F.lit("_"))


def lookup(x: Column, table: dict[str, str]) -> Column:
    """The table's value for ``x``, else ``x``."""
    return F.coalesce(F.try_element_at(literal_map(table), x), x)


def literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for kv in table.items() for v in kv])


def any_of(x: Column, parts: Iterable[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | x.contains(p)
    return out


def first_case(cases: list[tuple[Column, Column | str]], otherwise: Column | str) -> Column:
    """An ordered CASE."""
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    out = F.when(cases[0][0], lit(cases[0][1]))
    for test, value in cases[1:]:
        out = out.when(test, lit(value))
    return out.otherwise(lit(otherwise))


def escape_html(x: Column | str) -> Column:
    """A text for a page: ampersands, angle brackets and double quotes as entities; null as an empty text."""
    out = text_or_empty(x)
    for c, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(c), F.lit(entity))
    return out


def two_decimals(x: Column) -> Column:
    """A non-negative double to two decimals, rounded by its exact binary value, exact ties to even.

    Twice the hundredths, x * 200, are compared with the odd number between two results; the product's
    rounding error comes from splitting x into two halves of 26 bits, so the comparison is exact.
    """
    low = F.floor(x * 100)
    high_half = x * 134217729.0 - (x * 134217729.0 - x)
    product = x * 200.0
    error = (high_half * 200.0 - product) + (x - high_half) * 200.0
    side = (product - (low * 2 + 1).cast("double")) + error
    n = F.when((side > 0) | ((side == 0) & (low % 2 == 1)), low + 1).otherwise(low)
    return F.format_string("%d.%02d", F.floor(n / 100), F.pmod(n, F.lit(100)))


# Species spellings.
SPECIES = {
    "h2": "H2", "hydrogen": "H2", "h₂": "H2",
    "co": "CO", "carbon monoxide": "CO",
    "co2": "CO2", "carbon dioxide": "CO2", "co₂": "CO2",
    "h2o": "H2O", "water": "H2O", "steam": "H2O",
    "ch4": "CH4", "methane": "CH4",
    "ch3oh": "CH3OH", "methanol": "CH3OH",
    "o2": "O2", "oxygen": "O2",
    "n2": "N2", "nitrogen": "N2",
    "nh3": "NH3", "ammonia": "NH3",
    "no": "NO", "no2": "NO2", "nox": "NOx",
}


def species(x: Column | str) -> Column:
    """Sorted distinct canonical species of a list."""
    table = literal_map(SPECIES)
    named = F.filter(list_or_empty(x), lambda s: s != "")
    return F.array_sort(F.array_distinct(F.transform(named, lambda s: F.coalesce(F.try_element_at(table, F.lower(strip(s))), F.lower(strip(s))))))


# Words that a slug leaves out.
STOPWORDS = ["the", "a", "an", "of", "in", "on", "for", "and", "with", "by", "to", "from", "at", "is", "are", "was", "were"]


@cache
def _folding() -> tuple[str, str]:
    """Each character whose canonical decomposition begins with an ASCII letter or digit, and that letter or digit."""
    bases = {chr(c): unicodedata.normalize("NFD", chr(c))[0] for c in range(128, 0x30000) if not 0xD800 <= c < 0xE000}
    kept = {c: b for c, b in bases.items() if b.isascii() and b.isalnum()}
    return "".join(kept), "".join(kept.values())


def slug(x: Column | str, words: int = 5) -> Column:
    """The first meaningful words of a title: tags cut, accents folded, other characters dropped."""
    plain = F.translate(F.regexp_replace(text_or_empty(x), "<[^>]+>", ""), *_folding())
    ascii_only = F.regexp_replace(plain, r"[^a-zA-Z0-9\s]", "")
    all_words = F.filter(F.split(F.trim(ascii_only), r"\s+"), lambda w: w != "")
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    kept = F.filter(all_words, lambda w: ~F.array_contains(stop, F.lower(w)))
    return F.array_join(F.slice(F.when(F.size(kept) > 0, kept).otherwise(all_words), 1, words), "_")


def pdf_filename(year: Column | str, authors: Column | str, title: Column | str) -> Column:
    """``{year}_{last name of the first author}_{slug}.pdf``, at most 120 characters; a null year prints ``None``."""
    first = F.get(list_or_empty(authors), F.lit(0))
    name = F.regexp_extract(F.trim(F.substring_index(F.coalesce(first, F.lit("")), ",", 1)), r"(\S+)$", 1)
    last = F.when(first.isNull() | (first == ""), "Unknown").otherwise(name)
    whole = F.concat_ws("_", F.coalesce(_c(year).cast("string"), F.lit("None")), last, F.concat(slug(title), F.lit(".pdf")))
    return F.when(F.length(whole) > 120, F.concat(F.substring(whole, 1, 116), F.lit(".pdf"))).otherwise(whole)


def staged(df: DataFrame, *steps: dict[str, Column]) -> DataFrame:
    """One projection after the other, each of which may use the columns of those before."""
    for step in steps:
        df = df.withColumns(step)
    return df
