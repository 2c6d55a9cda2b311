"""Practice areas of a fixed taxonomy: by rule where one fits, by a classifier that the caller brings where none does."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The taxonomy. Fixed values.
CANONICAL = (
    "personal-injury criminal-defense family-law real-estate business-law immigration bankruptcy employment estate-planning medical-malpractice civil-litigation intellectual-property tax-law social-security workers-compensation "
    "traffic-violations environmental-law elder-law juvenile-law military-law civil-rights appellate-law construction-law consumer-protection corporate-law education-law entertainment-law health-care-law insurance-law "
    "international-law media-law municipal-law non-profit-law securities-law sports-law agriculture-law aviation-law banking-law energy-law maritime-law native-american-law"
).split()
#: Area -> raw terms that mean it, in the order in which they are tried. Fixed values.
TERMS = [
    ("personal-injury", "personal injury; injury law; accident law; car accident; auto accident; wrongful death; slip and fall"),
    ("criminal-defense", "criminal law; criminal; dui; dwi; drug crimes; white collar; felony; misdemeanor"),
    ("family-law", "divorce; child custody; child support; spousal support; alimony; adoption; domestic violence; prenuptial"),
    ("real-estate", "real estate; property law; landlord tenant; foreclosure; zoning"),
    ("business-law", "business"),
    ("corporate-law", "corporate"),
    ("business-law", "startup; llc; mergers and acquisitions; contract law"),
    ("immigration", "immigration; visa; green card; deportation; citizenship; asylum"),
    ("employment", "employment; labor law; workplace; discrimination; sexual harassment; wrongful termination"),
    ("estate-planning", "estate planning; wills; trusts; probate; power of attorney"),
    ("intellectual-property", "intellectual property; ip; patent; trademark; copyright"),
    ("tax-law", "tax; irs; tax controversy"),
]
RULES = [(term.strip(), area) for area, terms in TERMS for term in terms.split(";")]


def canonical_area(raw: Column) -> Column:
    """The area of a raw text: its own term, an area of the taxonomy itself, else the first term that holds it or is held by it; else null."""
    text = F.lower(F.trim(raw))
    rules = F.array(*[F.struct(F.lit(term).alias("term"), F.lit(area).alias("area")) for term, area in RULES])
    first = lambda test: F.get(F.filter(rules, test), F.lit(0))["area"]
    own = first(lambda r: r["term"] == text)
    near = first(lambda r: text.contains(r["term"]) | r["term"].contains(text))
    return F.when(F.length(raw) > 0, F.coalesce(own, F.when(text.isin(CANONICAL), text), near))


def canonical_areas(raw: Column) -> Column:
    """The distinct areas of a list, in order; an empty list for null."""
    return F.array_distinct(F.array_compact(F.transform(F.coalesce(raw, F.array().cast("array<string>")), canonical_area)))


def classify_rest(values: DataFrame, cache: DataFrame, classify: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(raw, area, how): each distinct ``values(raw)`` by rule, then from ``cache(raw, area)``, then by ``classify`` (raw -> raw, area), if given.

    Areas outside the taxonomy are no answers. What nobody can say has no area. Only what the rules leave over meets the cache, and only
    what it leaves over is classified.
    """
    one = values.where("trim(raw) <> ''").select("raw").distinct().withColumn("area", canonical_area(F.col("raw")))
    ruled, rest = one.where("area is not null"), one.where("area is null").select("raw")
    known = rest.join(cache.where(F.col("area").isin(CANONICAL)).dropDuplicates(["raw"]), "raw")
    open_ = rest.join(known, "raw", "left_anti")
    answered = classify(open_).where(F.col("area").isin(CANONICAL)).select("raw", "area") if classify else None
    told = known.select("raw", "area", F.lit("cache").alias("how"))
    if answered is not None:
        told, open_ = told.unionByName(answered.withColumn("how", F.lit("model"))), open_.join(answered, "raw", "left_anti")
    return ruled.select("raw", "area", F.lit("rule").alias("how")).unionByName(told).unionByName(open_.select("raw", F.lit(None).cast("string").alias("area"), F.lit("none").alias("how")))
