"""Completeness of a record: four different formulas, all one row expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dossier.functions.values import practice_points

#: Field -> points. Fixed values.
RECORD_POINTS = {"license_status": 10, "photo_url": 8, "bar_number": 8, "phone": 6, "law_school": 5, "admission_date": 5, "firm_name": 5, "website_url": 3, "email": 2}
TIER_POINTS = {"bar_number": ("must", 15), "license_state": ("must", 15), "full_name": ("must", 15), "address": ("must", 15), "practice_areas": ("high", 10), "bio": ("high", 10), "photo_url": ("high", 10), "phone": ("medium", 5), "email": ("medium", 5)}
WEIGHTS = {"full_name": 10, "bar_number": 10, "license_state": 5, "license_status": 5, "firm_name": 5, "address_line1": 8, "city": 5, "state": 5, "zip": 3, "phone": 8, "email": 8, "website_url": 5, "practice_areas": 10, "bio": 8, "photo_url": 5}


def there(value: Column) -> Column:
    """Not null and not empty."""
    return F.coalesce(value.cast("string") != "", F.lit(False))


def real_text(value: Column) -> Column:
    """Not null, not empty and not the text "None"."""
    return F.coalesce(~value.cast("string").isin("", "None"), F.lit(False))


def points(test: Column, n: int) -> Column:
    return F.when(F.coalesce(test, F.lit(False)), n).otherwise(0)


def _sum(parts: list[Column]) -> Column:
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def record_score(fields: dict[str, Column], areas: Column, has_address: Column) -> Column:
    """0..100: practice areas up to 12, name longer than 2 and bio longer than 20 letters 10 each, an address 16, and ``RECORD_POINTS``."""
    parts = [points(there(fields[f]), n) for f, n in RECORD_POINTS.items()]
    parts += [F.coalesce(practice_points(F.greatest(F.size(areas), F.lit(0))), F.lit(0)), points(F.length(fields["full_name"]) > 2, 10), points(F.length(fields["bio"]) > 20, 10), points(has_address, 16)]
    return F.least(F.lit(100), _sum(parts))


def tier_tests(fields: dict[str, Column], areas: Column, has_address: Column) -> dict[str, Column]:
    tests = {f: real_text(fields[f]) for f in TIER_POINTS if f not in ("address", "practice_areas")}
    return tests | {"address": F.coalesce(has_address, F.lit(False)), "practice_areas": F.coalesce(F.size(areas) > 0, F.lit(False))}


def tier_score(tests: dict[str, Column]) -> Column:
    """0..100: four fields of 15, three of 10, two of 5 points."""
    return _sum([points(tests[f], n) for f, (_, n) in TIER_POINTS.items()])


def tier_breakdown(tests: dict[str, Column]) -> Column:
    """array<struct<field, tier, weight, present>>, to be exploded."""
    return F.array(*[F.struct(F.lit(f).alias("field"), F.lit(tier).alias("tier"), F.lit(n).alias("weight"), tests[f].alias("present")) for f, (tier, n) in TIER_POINTS.items()])


def weighted_score(present: dict[str, Column], weights: dict[str, int] | None = None) -> Column:
    """The weight of what is there over the sum of all weights, in percent, cut to a whole number."""
    weights = weights or WEIGHTS
    return F.floor(_sum([points(present[f], n) for f, n in weights.items()]) * 100 / F.lit(sum(weights.values()))).cast("int")
