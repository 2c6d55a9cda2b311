"""Postal addresses as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dossier.functions.names import word_tokens
from dossier.functions.text import squeeze

#: Fixed values.
STREET_SHORT = {
    "street": "st", "avenue": "ave", "boulevard": "blvd", "road": "rd", "lane": "ln", "drive": "dr", "court": "ct", "place": "pl", "square": "sq", "trail": "trl", "parkway": "pkwy", "circle": "cir", "way": "way", "terrace": "ter",
}
TOKEN_SHORT = STREET_SHORT | {
    "highway": "hwy", "expressway": "expy", "freeway": "fwy", "suite": "ste", "building": "bldg", "floor": "fl", "apartment": "apt",
    "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw",
}
SKIPPED_TOKENS = ["usa", "united", "states", "ste", "suite", "apt", "unit", "bldg", "building", "fl", "floor"]


def _lookup(table: dict[str, str], word: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[word]


def parse_address(text: Column) -> Column:
    """struct<address_line1, address_line2, city, state, zip> of one written address; null for null or blank.

    ", Town[,] ST [ZIP]" at the end gives town (in title case), state and zip; the first two comma parts before it are the lines, with the
    street types of the first in short form.
    """
    clean = F.regexp_replace(squeeze(text), r",\s*", ", ")
    tail = r"(?i),\s*([A-Za-z][A-Za-z\s]*?),?\s+([A-Za-z]{2})(?:\s+(\d{5}(?:-\d{4})?))?$"
    city = F.initcap(F.trim(F.regexp_extract(clean, tail, 1)))
    lines = F.filter(F.transform(F.split(F.regexp_replace(clean, tail, ""), ","), lambda x: F.trim(x)), lambda x: x != "")
    line1 = F.array_join(F.transform(F.split(F.get(lines, F.lit(0)), " "), lambda w: F.coalesce(_lookup(STREET_SHORT, F.lower(w)), w)), " ")
    empty = lambda c: F.nullif(c, F.lit(""))
    return F.when(
        clean != "",
        F.struct(
            F.when(F.size(lines) > 0, line1).alias("address_line1"),
            F.get(lines, F.lit(1)).alias("address_line2"),
            empty(city).alias("city"),
            empty(F.upper(F.regexp_extract(clean, tail, 2))).alias("state"),
            empty(F.regexp_extract(clean, tail, 3)).alias("zip"),
        ),
    )


def address_tokens(text: Column) -> Column:
    """Words of an address in postal short form, without unit words and country."""
    skipped = F.array(*[F.lit(w) for w in SKIPPED_TOKENS])
    return F.transform(F.filter(word_tokens(text), lambda w: ~F.array_contains(skipped, w)), lambda w: F.coalesce(_lookup(TOKEN_SHORT, w), w))


def is_street_address(text: Column) -> Column:
    """Two words or more, one of them with a figure and one that is not only figures."""
    tokens = word_tokens(text)
    return (F.size(tokens) >= 2) & F.exists(tokens, lambda w: w.rlike("[0-9]")) & F.exists(tokens, lambda w: w.rlike("[a-z]"))


def address_similarity(street: Column, written: Column) -> Column:
    """0..1: overlap of a street line with a written address: the larger of the Jaccard of the street parts and 0.85 times the share of the
    line's words found anywhere; 0 without a street or when the first house number is missing."""
    own = address_tokens(street)
    theirs_street, theirs = address_tokens(F.substring_index(written, ",", 1)), address_tokens(written)
    a, b, c = F.array_distinct(own), F.array_distinct(theirs_street), F.array_distinct(theirs)
    numbers = F.filter(own, lambda w: w.rlike("^[0-9]+$"))
    lacks = (F.size(numbers) > 0) & ~F.array_contains(theirs, F.get(numbers, F.lit(0)))
    jaccard = F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    coverage = F.size(F.array_intersect(a, c)) / F.size(a)
    usable = F.coalesce(is_street_address(street), F.lit(False)) & (F.length(written) > 0) & (F.size(own) > 0) & (F.size(theirs_street) > 0)
    return F.when(usable & ~lacks, F.greatest(jaccard, coverage * 0.85)).otherwise(0.0)
