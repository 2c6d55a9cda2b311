"""Best representative of each duplicate group: iterative truth discovery over the claims of all rows.

Sources vote for field values; a source's reliability is the mean confidence of what it claims, a value's support is the sum of
the reliabilities behind it, and both are estimated in turn until they settle. Among the rows of a group the value
comes from the most trusted one: curated by hand, then newest, then best supported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.llm.people import licence_number, real
from dossier.session import cut_lineage, drop_cut

FIELDS = ["phone", "email", "website_url", "firm_name", "law_school"]
#: Rounds that are always taken; more follow until no reliability moves by ``SETTLED``, and ``MOST_ROUNDS`` without that are an error.
ROUNDS, SETTLED, MOST_ROUNDS = 8, 0.01, 200

_VALUES = ", ".join(f"{f}:string" for f in FIELDS)
_DOCUMENT = f"{', '.join(f'{f} string' for f in FIELDS)}, _broken string"
_PAYLOADS = f"map<string, struct<data:struct<{_VALUES}>>>"


def licence_groups(profiles: DataFrame) -> DataFrame:
    """(group_id, id) of the rows of each licence (state and number, however noted) that two rows or more have."""
    rows = profiles.where("id is not null").select("id", F.nullif(F.upper(F.trim("license_state")), F.lit("")).alias("state"), licence_number(F.col("bar_number")).alias("bar")).where("state is not null and bar is not null")
    groups = rows.groupBy("state", "bar").agg(F.min("id").alias("group_id"), F.count("*").alias("n")).where("n > 1")
    return rows.join(groups, ["state", "bar"]).select("group_id", "id")


def claims(profiles: DataFrame) -> DataFrame:
    """(group_id, id, field, source, value, offered, curated, updated_at): what each source of a row says.

    Only real values are claims. The value of the merged document is offered by the row; a source's value is offered where the
    document (absent, broken or without a real one) has none, the sources in order of their names. Null payloads claim nothing.
    """
    doc = F.from_json("merged_data", _DOCUMENT, {"columnNameOfCorruptRecord": "_broken"})
    rows = profiles.select("id", doc.alias("m"), F.from_json("raw_data_by_source", _PAYLOADS).alias("raw"), "manually_curated_fields", "updated_at").join(licence_groups(profiles), "id")
    whole = F.col("m._broken").isNull()
    told = lambda field: F.array_sort(F.transform(F.map_entries("raw"), lambda e: F.struct(e["key"].alias("source"), real(e["value"]["data"][field]).alias("value"))))

    def of(field: str):
        merged = F.when(whole, real(F.col(f"m.{field}")))
        sources = F.filter(F.coalesce(told(field), F.array().cast("array<struct<source:string,value:string>>")), lambda x: x["value"].isNotNull())
        offer = F.coalesce(merged, F.get(sources, F.lit(0))["value"])
        votes = F.when(merged.isNull() | F.exists(sources, lambda x: x["value"] == merged), sources).otherwise(F.concat(sources, F.array(F.struct(F.lit("merged").alias("source"), merged.alias("value")))))
        return F.struct(F.lit(field).alias("field"), offer.alias("offer"), votes.alias("votes"), F.coalesce(F.array_contains("manually_curated_fields", field), F.lit(False)).alias("curated"))

    each = rows.select("group_id", "id", "updated_at", F.explode(F.array(*[of(f) for f in FIELDS])).alias("f")).where("f.offer is not null")
    one = each.select("group_id", "id", "f.field", "f.offer", "f.curated", "updated_at", F.explode("f.votes").alias("v"))
    return one.select("group_id", "id", "field", F.col("v.source").alias("source"), F.col("v.value").alias("value"), (F.col("v.value") == F.col("offer")).alias("offered"), "curated", "updated_at")


def compared(value):
    return F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}@.]+", "")


def discover_truth(votes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((group_id, field, said, confidence), (source, reliability)) of ``votes(group_id, field, said, source, n)``.

    Votes are pre-aggregated, so a group of any size is as many rows as it has different (value, source); all steps are
    aggregates and joins on (group, field, value). Reliabilities start equal.
    """
    sources = cut_lineage(votes.groupBy("source").agg(F.lit(0.8).alias("reliability")))
    for done in range(1, MOST_ROUNDS + 1):
        support = votes.join(sources, "source").groupBy("group_id", "field", "said").agg(F.sum(F.col("reliability") * F.log1p("n")).alias("support"))
        total = support.groupBy("group_id", "field").agg(F.sum("support").alias("total"))
        confidence = support.join(total, ["group_id", "field"]).select("group_id", "field", "said", (F.col("support") / F.col("total")).alias("confidence"))
        new = votes.join(confidence, ["group_id", "field", "said"]).groupBy("source").agg((F.sum(F.col("confidence") * F.col("n")) / F.sum("n")).alias("new"))
        moved = cut_lineage(sources.join(new, "source").select("source", F.col("new").alias("reliability"), F.abs(F.col("new") - F.col("reliability")).alias("moved")))
        if done >= ROUNDS and (moved.agg(F.max("moved")).first()[0] or 0.0) < SETTLED:
            return confidence, moved.select("source", "reliability")
        drop_cut(sources)
        sources = moved
    raise RuntimeError(f"reliabilities did not settle in {MOST_ROUNDS} rounds")


def ranked_claims(profiles: DataFrame) -> DataFrame:
    """The claims of all groups with the confidence of their value."""
    all_claims = cut_lineage(claims(profiles).withColumn("said", compared(F.col("value"))))
    votes = cut_lineage(all_claims.groupBy("group_id", "field", "said", "source").agg(F.count("*").alias("n")))
    confidence, _ = discover_truth(votes)
    return all_claims.join(confidence, ["group_id", "field", "said"])


def best_rows(profiles: DataFrame) -> DataFrame:
    """(group_id, column_name, from_id, value, confidence): the row that supplies each field of each group.

    Curated rows come first, then the larger ``updated_at`` (null last), then the better supported value, then the smaller id.
    A field that no row of the group offers has no row. The pick is a partial aggregate.
    """
    order = F.struct("curated", "updated_at", "confidence", -F.col("id"))
    best = F.max_by(F.struct("id", "value", "confidence"), order)
    picked = ranked_claims(profiles).where("offered").groupBy("group_id", "field").agg(best.alias("best"))
    return picked.select("group_id", F.col("field").alias("column_name"), F.col("best.id").alias("from_id"), F.col("best.value").alias("value"), F.col("best.confidence").alias("confidence"))


def most_supported(profiles: DataFrame) -> DataFrame:
    """(group_id, column_name, value, confidence): the value of highest support per field, whatever row it is from (ties, to nine
    digits: the last in order of its letters)."""
    sure = F.round("confidence", 9)
    best = F.max_by(F.struct("value", sure.alias("confidence")), F.struct(sure, F.col("said"), F.col("value")))
    picked = ranked_claims(profiles).groupBy("group_id", "field").agg(best.alias("best"))
    return picked.select("group_id", F.col("field").alias("column_name"), F.col("best.value").alias("value"), F.col("best.confidence").alias("confidence"))
