"""Keys, phones, dates, scores and JSON values as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dossier.functions.names import match_key
from dossier.functions.text import squeeze


# --- keys ----------------------------------------------------------------------------------------------------------
def bar_key(bar: Column) -> Column:
    """A licence number for comparison: one "#" in front goes, white space is squeezed, lower case; "" for null. Leading zeros stay."""
    return F.lower(squeeze(F.regexp_replace(squeeze(F.coalesce(bar, F.lit(""))), "^#", "")))


def stored_bar(bar: Column) -> Column:
    """The same in its own letter case; null where nothing is left."""
    return F.nullif(squeeze(F.regexp_replace(squeeze(bar), "^#", "")), F.lit(""))


def profile_fingerprint(bar: Column, state: Column) -> Column:
    """SHA-256 of licence number and state. Rows of a state without a number share one fingerprint."""
    return F.sha2(F.trim(F.concat_ws(" ", bar_key(bar), F.lower(F.trim(F.coalesce(state, F.lit("")))))), 256)


def place_fingerprint(name: Column, city: Column, state: Column) -> Column:
    """SHA-256 of name, city and state, trimmed and in lower case."""
    part = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.sha2(F.concat_ws("|", part(name), part(city), part(state)), 256)


def directory_fingerprint(number: Column, name: Column, city: Column, state: Column) -> Column:
    """SHA-256 of a directory's own number, or without one of name, town and state by their ``match_key``."""
    # The prefix is a fixed value: digests must be the known ones.
    return F.sha2(F.coalesce(F.concat(F.lit("avvo:"), F.nullif(number, F.lit(""))), F.concat_ws("|", match_key(name), match_key(city), match_key(state))), 256)


# --- phones --------------------------------------------------------------------------------------------------------
def normalize_phone(text: Column) -> Column:
    """+1 and ten figures where the text can be read so, else the squeezed text; null for blank.

    Read so: the figures, with a leading +1 or 1 or without, are ten; or ten figures stand together somewhere as 3-3-4 (an extension behind them).
    A text with a + elsewhere keeps it, as one of its signs.
    """
    signs = F.regexp_replace(text, "[^0-9+]", "")
    rescued = F.regexp_replace(F.regexp_extract(text, r"\(?(\d{3})\)?[\s\-.]?(\d{3})[\s\-.]?(\d{4})", 0), "[^0-9]", "")
    local = F.regexp_extract(signs, "^(?:[+]1(?=.{10}$)|1(?=.{10}$)|(?=[0-9]{10}$))(.+)$", 1)
    whole = F.concat(F.lit("+1"), F.coalesce(F.nullif(local, F.lit("")), F.when(F.length(rescued) == 10, rescued)))
    return F.when(squeeze(text) != "", F.coalesce(whole, squeeze(text)))


def strict_phone(text: Column) -> Column:
    """+1 and ten figures, or null."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    return F.when(F.length(digits) == 10, F.concat(F.lit("+1"), digits)).when((F.length(digits) == 11) & digits.startswith("1"), F.concat(F.lit("+"), digits))


# --- dates ---------------------------------------------------------------------------------------------------------
def year_start(year: Column) -> Column:
    return F.make_date(year, F.lit(1), F.lit(1))


def coerce_date(text: Column) -> Column:
    """A date written yyyy, yyyy-M, yyyy-M-d or M/d/yyyy; else null."""
    t = F.trim(text)
    iso = F.when(t.rlike(r"^\d{4}$"), F.concat(t, F.lit("-1-1"))).when(t.rlike(r"^\d{4}-\d{1,2}$"), F.concat(t, F.lit("-1"))).when(t.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), t)
    us = F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.regexp_replace(t, r"^(\d+)/(\d+)/(\d+)$", "$3-$1-$2"))
    parts = F.split(F.coalesce(iso, us), "-")
    y, m, d = (F.get(parts, F.lit(i)).cast("int") for i in range(3))
    last = F.day(F.last_day(F.make_date(y, F.when(m.between(1, 12), m), F.lit(1))))
    return F.when(m.between(1, 12) & (d >= 1) & (d <= last), F.make_date(y, m, d))


# --- scores --------------------------------------------------------------------------------------------------------
def popularity(rating: Column, reviews: Column) -> Column:
    """0..100: 20 a star and 0.3 a review (40 at most), over 140."""
    raw = F.coalesce(rating, F.lit(0.0)) * 20.0 + F.least(F.coalesce(reviews, F.lit(0)) * 0.3, F.lit(40.0))
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw / 140.0 * 100.0))


def practice_points(n: Column) -> Column:
    """Points for n practice areas: 4 each up to 2, 3 each up to 5, 2 each beyond; 12 at most."""
    return F.least(F.lit(12), F.when(n <= 2, n * 4).when(n <= 5, n * 3).otherwise(n * 2))


# --- lists and JSON ------------------------------------------------------------------------------------------------
def ordered_union(*lists: Column) -> Column:
    """Items of all lists in order, those that differ only in case and outer white space once."""
    joined = F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists])
    start = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, item: Column) -> Column:
        key = F.lower(F.trim(item))
        new = ~F.coalesce(F.array_contains(acc["seen"], key), F.lit(False))
        return F.struct(F.when(new, F.array_append(acc["seen"], key)).otherwise(acc["seen"]).alias("seen"), F.when(new, F.array_append(acc["kept"], item)).otherwise(acc["kept"]).alias("kept"))

    return F.aggregate(joined, start, step, lambda acc: acc["kept"])


def list_overlap(a: Column, b: Column) -> Column:
    """Jaccard of two lists of texts regardless of case; 0 if both are empty."""
    low = lambda x: F.array_distinct(F.transform(x, F.lower))
    union = F.size(F.array_union(low(a), low(b)))
    return F.when(union > 0, F.size(F.array_intersect(low(a), low(b))) / union).otherwise(0.0)


def json_flag(document: Column, path: str) -> Column:
    """A boolean of a JSON text; false where it is missing or no boolean."""
    return F.coalesce(F.get_json_object(document, path).try_cast("boolean"), F.lit(False))


def overlay(old: Column, new: Column) -> Column:
    """Map ``old`` with the entries of ``new`` over it; a null map counts as empty."""
    return F.coalesce(F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new), old, new)


def pruned(fields: Column) -> Column:
    """Map of values, as ``from_json`` gives them as texts, without null, empty text, [] and {}."""
    return F.map_filter(fields, lambda _, v: v.isNotNull() & ~v.isin("", "[]", "{}"))


def says_nothing(fields: Column, address_key: str) -> Column:
    """Whether a map is empty or has nothing but its own address."""
    return F.size(F.map_filter(fields, lambda k, _: k != address_key)) == 0


def stable_json(document: Column) -> Column:
    """The JSON text with its keys in order, so that equal documents hash alike; null if it is none."""
    return F.to_json(F.try_parse_json(document))


def unfenced(text: Column) -> Column:
    """A JSON answer without the code fence around it; null if what is left is no JSON."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"(?i)^```(?:json)?\s*", ""), r"\s*```$", "")
    return F.when(F.try_parse_json(bare).isNotNull(), bare)


def appended(items: Column, item: Column) -> Column:
    """The list with the item behind it, unless it is in already; a null list counts as empty."""
    return F.array_union(F.coalesce(items, F.array().cast("array<string>")), F.array(item))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, rounded."""
    return F.round(F.unix_micros(end.cast("timestamp")) / 1e6 - F.unix_micros(start.cast("timestamp")) / 1e6).cast("long")
