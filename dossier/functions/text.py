"""Text functions on columns: white space and letter case as directories print them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stay in upper case. Fixed values.
ALWAYS_UPPER = ["LLC", "LLP", "PC", "PA", "PLLC", "PLC", "LTD", "LP", "LLLP", "RLLP", "JR", "SR", "II", "III", "IV", "V", "VI", "ESQ", "USA", "US"]


def squeeze(text: Column) -> Column:
    """Runs of white space (any Unicode space) become one blank; the ends are cut."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def nonblank(text: Column) -> Column:
    """The text, or null where it has no visible character."""
    return F.when(squeeze(text) != "", text)


def words(text: Column) -> Column:
    """The words between white space; an empty array for blank text."""
    return F.filter(F.split(squeeze(text), " "), lambda w: w != "")


def capitalize(word: Column) -> Column:
    """First character in upper case, all others in lower case."""
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, F.lit(2), F.length(word))))


def _is_upper_word(word: Column) -> Column:
    return F.upper(word).isin(ALWAYS_UPPER)


def _ordinal(word: Column) -> Column:
    return word.rlike(r"(?i)^\d+(st|nd|rd|th)$")


def _simple_word(word: Column) -> Column:
    """A word without hyphens: an apostrophe capitalises both sides once, Mc and Mac the letter behind them."""
    left = F.regexp_extract(word, r"^([^']*)'", 1)
    right = F.regexp_extract(word, r"^[^']*'(.*)$", 1)
    # A prefix counts only with two letters or more behind it.
    celtic = F.concat(capitalize(F.regexp_extract(word, r"(?i)^(mc|mac)", 1)), capitalize(F.regexp_replace(word, r"(?i)^(mc|mac)", "")))
    return (
        F.when(_is_upper_word(word), F.upper(word))
        .when(_ordinal(word), F.lower(word))
        .when(word.contains("'"), F.concat(capitalize(left), F.lit("'"), capitalize(right)))
        .when(word.rlike(r"(?i)^(mc|mac)[a-z]."), celtic)
        .otherwise(capitalize(word))
    )


def title_word(word: Column) -> Column:
    whole = F.when(_is_upper_word(word), F.upper(word)).when(_ordinal(word), F.lower(word))
    hyphened = F.array_join(F.transform(F.split(word, "-"), _simple_word), "-")
    return F.coalesce(whole, F.when(word.contains("-"), hyphened).otherwise(_simple_word(word)))


def _each_word(text: Column, change) -> Column:
    """Change every word; null and blank texts stay as they are."""
    return F.when(text.isNull() | (squeeze(text) == ""), text).otherwise(F.array_join(F.transform(words(text), change), " "))


def title_name(text: Column) -> Column:
    """A personal name in title case: ``JOHN O'BRIEN JR`` gives ``John O'Brien JR``."""
    return _each_word(text, title_word)


def title_firm(text: Column) -> Column:
    """A firm name in title case; entity suffixes stay in upper case, commas and points at the end of a word stay."""

    def change(word: Column) -> Column:
        core = F.regexp_replace(word, r"[,.]+$", "")
        tail = F.regexp_extract(word, r"([,.]*)$", 1)
        return F.concat(F.when(_is_upper_word(core), F.upper(core)).otherwise(capitalize(core)), tail)

    return _each_word(text, change)


def title_address_line(text: Column) -> Column:
    """A street line in title case: figures stay, ordinals are in lower case."""
    return _each_word(text, lambda w: F.when(_ordinal(w), F.lower(w)).otherwise(capitalize(w)))


def title_city(text: Column) -> Column:
    return _each_word(text, capitalize)


def title_law_school(text: Column) -> Column:
    """A school in title case; white space between words and punctuation around them stay."""

    def change(piece: Column) -> Column:
        lead, tail = F.regexp_extract(piece, "^([^A-Za-z0-9]*)", 1), F.regexp_extract(piece, "([^A-Za-z0-9]*)$", 1)
        core = F.regexp_replace(F.regexp_replace(piece, "^[^A-Za-z0-9]+", ""), "[^A-Za-z0-9]+$", "")
        return F.when(core == "", piece).otherwise(F.concat(lead, title_word(core), tail))

    pieces = F.split(F.trim(text), r"(?<=\s)(?=\S)|(?<=\S)(?=\s)")
    return F.when(text.isNull() | (F.trim(text) == ""), text).otherwise(F.array_join(F.transform(pieces, change), ""))
