"""Personal names as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dossier.functions.text import squeeze

#: Fixed values.
PREFIXES = ["mr", "mrs", "ms", "dr", "prof", "hon", "judge"]
SUFFIXES = ["jr", "sr", "ii", "iii", "iv", "v", "vi", "esq", "esquire", "md", "phd", "jd", "llm"]
ADDRESS_WORDS = ["suite", "ste", "floor", "fl", "apt", "blvd", "ave", "st", "rd", "dr", "#"]
MATCH_PREFIXES = ["mr", "mrs", "ms", "miss", "dr", "prof", "hon", "judge", "attorney", "lawyer"]
FIRM_WORDS = (
    "law firm firms office offices group llc pc pllc pa inc llp ltd co corp corporation company associates associate partners partner attorney attorneys lawyer lawyers legal services service center centre practice "
    "counsel counselor counselors professional the of and at in for a an by pl plc apc lpa psc chtd chartered immigration criminal family personal injury defense litigation"
).split()


def parse_name(full: Column) -> Column:
    """struct<first_name, middle_name, last_name, suffix> of a written name; null for null or blank.

    A comma turns the name round unless a figure or an address word follows it; one title in front and one suffix behind are cut; a
    single word is a first name.
    """
    text = F.trim(full)
    before, after = F.trim(F.regexp_extract(text, "^([^,]*),", 1)), F.trim(F.regexp_extract(text, "(?s)^[^,]*,(.*)$", 1))
    flips = text.contains(",") & ~after.rlike(r"\d") & ~F.arrays_overlap(F.split(F.lower(after), r"\s+"), F.array(*[F.lit(w) for w in ADDRESS_WORDS]))
    text = F.when(flips, F.concat(after, F.lit(" "), before)).otherwise(text)
    text = F.regexp_replace(text, rf"(?i)^(?:{'|'.join(PREFIXES)})\.?\s+", "")
    suffix_pattern = rf"(?i)\s+((?:{'|'.join(SUFFIXES)})\.?)\s*$"
    suffix = F.regexp_replace(F.regexp_extract(text, suffix_pattern, 1), r"\.+$", "")
    rest = F.trim(F.regexp_replace(text, suffix_pattern, ""))
    parts = F.filter(F.split(rest, r"\s+"), lambda w: w != "")
    n = F.size(parts)
    return F.when(
        text != "",
        F.struct(
            F.when(n >= 2, F.element_at(parts, 1)).otherwise(rest).alias("first_name"),
            F.when(n > 2, F.array_join(F.slice(parts, F.lit(2), n - 2), " ")).alias("middle_name"),
            F.when(n >= 2, F.element_at(parts, -1)).alias("last_name"),
            F.nullif(suffix, F.lit("")).alias("suffix"),
        ),
    )


def normalize_name(full: Column) -> Column:
    """struct<full_name, first_name, middle_name, last_name, suffix>; the full name is first and last name if there are both."""
    clean = squeeze(full)
    p = parse_name(clean)
    both = F.concat_ws(" ", p["first_name"], p["last_name"])
    whole = F.when(p["last_name"].isNotNull() & (p["first_name"] != ""), both).otherwise(F.nullif(clean, F.lit("")))
    return F.struct(whole.alias("full_name"), p["first_name"].alias("first_name"), p["middle_name"].alias("middle_name"), p["last_name"].alias("last_name"), p["suffix"].alias("suffix"))


def split_last_space(full: Column) -> Column:
    """struct<first_name, last_name>: the last word and all before it; nulls for fewer than two words."""
    clean = squeeze(full)
    two = clean.contains(" ")
    return F.struct(F.when(two, F.regexp_extract(clean, "^(.*) [^ ]+$", 1)).alias("first_name"), F.when(two, F.regexp_extract(clean, "([^ ]+)$", 1)).alias("last_name"))


def word_tokens(text: Column) -> Column:
    """Runs of a-z and 0-9 in the lower-cased text; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1)), F.array().cast("array<string>"))


def name_tokens(name: Column) -> Column:
    """Tokens of a name for matching: one comma turns it round unless suffixes or firm words follow; titles in front and suffixes behind go."""
    one_comma = (F.length(name) - F.length(F.replace(name, F.lit(","), F.lit("")))) == 1
    after = F.substring_index(name, ",", -1)
    late = word_tokens(after)
    person = (F.size(late) > 0) & ~F.arrays_overlap(late, F.array(*[F.lit(w) for w in [*SUFFIXES, *FIRM_WORDS]]))
    turned = F.when(one_comma & person, F.concat(after, F.lit(" "), F.substring_index(name, ",", 1))).otherwise(name)
    joined = F.array_join(word_tokens(turned), " ")
    joined = F.regexp_replace(joined, rf"^(?:(?:{'|'.join(MATCH_PREFIXES)})(?: |$))+", "")
    joined = F.regexp_replace(joined, rf"(?:(?:^| )(?:{'|'.join(SUFFIXES)}))+$", "")
    return F.filter(F.split(F.coalesce(joined, F.lit("")), " "), lambda w: w != "")


def firm_tokens(firm: Column) -> Column:
    """Distinct words of three letters or more of a firm that are no generic word, title or suffix."""
    common = F.array(*[F.lit(w) for w in [*FIRM_WORDS, *MATCH_PREFIXES, *SUFFIXES]])
    return F.array_distinct(F.filter(word_tokens(firm), lambda w: (F.length(w) >= 3) & ~F.array_contains(common, w)))


#: Fixed values.
ENTITY_SUFFIXES = ["llp", "llc", "pc", "p.c.", "pllc", "inc", "corp", "co."]
FIRM_PHRASES = ["law group", "legal services", "law office", "law offices", "attorneys at law", "associates", "partners", "trial lawyers", "injury lawyers"]


def is_firm(name: Column) -> Column:
    """Whether a listing names a firm: no name, an entity suffix, a firm phrase, or names strung together with "&"."""
    low = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    ends = [low.endswith(s) for s in ENTITY_SUFFIXES]
    holds = [low.contains(p) for p in FIRM_PHRASES]
    strung = low.contains("&") & (low.contains(",") | (F.size(F.regexp_extract_all(low, F.lit(r"(\b[a-z]{3,}\b)"), F.lit(1))) >= 3))
    result = low == ""
    for test in [*ends, *holds, strung]:
        result = result | test
    return result


def is_individual(name: Column) -> Column:
    """Not a firm, and first and last name of two letters or more."""
    p = parse_name(name)
    return F.coalesce(~is_firm(name) & (F.length(p["first_name"]) >= 2) & (F.length(p["last_name"]) >= 2), F.lit(False))


def strip_honorific(name: Column) -> Column:
    """The name without one title in front."""
    return F.trim(F.regexp_replace(F.trim(name), r"(?i)^(?:(?:Mr|Mrs|Ms|Dr|Prof|Hon)\.|Judge|Sir|Lady)\s+", ""))


def match_key(text: Column) -> Column:
    """Letters a-z, figures and blanks of the lower-cased text, ends cut; white space inside stays. "" for null."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9 ]", ""))


def last_token(text: Column) -> Column:
    """The last word, "" if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"(\S+)\s*$", 1), F.lit("")), F.lit(""))


def completed_names(full: Column, first: Column, last: Column) -> Column:
    """struct<full_name, first_name, last_name>: what a source left out made from what it sent; a single word is not split."""
    said = lambda c: F.nullif(F.trim(c), F.lit(""))
    none = said(first).isNull() & said(last).isNull()
    halves = split_last_space(full)
    return F.struct(
        F.when(said(full).isNull(), F.nullif(F.concat_ws(" ", said(first), said(last)), F.lit(""))).otherwise(full).alias("full_name"),
        F.when(none, halves["first_name"]).otherwise(first).alias("first_name"),
        F.when(none, halves["last_name"]).otherwise(last).alias("last_name"),
    )
