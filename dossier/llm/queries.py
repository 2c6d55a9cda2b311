"""Queries of this subpackage: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm import canonical, golden, linkage, mixing, packing, people, places, subjects, templates, tokens, topn
from dossier.llm.sql import ORACLES
from dossier.session import cut_lineage, prepare, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.residue_values(table(prepare(spark), sf_dir, "lawyer_enrichment")).select("id", "column_name")


def p1_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates, wordings and values by verdict."""
    return templates.template_report(table(prepare(spark), sf_dir, "lawyer_enrichment"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = cut_lineage(people.persons(table(spark, sf_dir, "lawyer_enrichment"), table(spark, sf_dir, "parsed_name")))
    return people.linked_pairs(rows, people.resolve(rows))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, lawyer, rows): the class of every profile and how many rows it has; copies are not expanded into pairs."""
    prepare(spark)
    rows = cut_lineage(people.persons(table(spark, sf_dir, "lawyer_enrichment"), table(spark, sf_dir, "parsed_name")))
    classes = cut_lineage(people.resolve(rows))
    return classes.join(classes.groupBy("lawyer").agg(F.count("*").alias("rows")), "lawyer").select("id", "lawyer", "rows")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden.best_rows(table(prepare(spark), sf_dir, "lawyer_enrichment")).select("group_id", "column_name", "from_id")


def p3_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-supported value of each field, by truth discovery alone."""
    return golden.most_supported(table(prepare(spark), sf_dir, "lawyer_enrichment"))


def p4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every accepted link with its confidence."""
    prepare(spark)
    rows = cut_lineage(people.persons(table(spark, sf_dir, "lawyer_enrichment"), table(spark, sf_dir, "parsed_name")))
    return linkage.link_rows(rows, table(spark, sf_dir, "discovery_candidate"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_links(spark, sf_dir).select("id", "candidate_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return places.address_pairs(*[table(spark, sf_dir, name) for name in ("google_places", "lawyer_enrichment", "discovery_candidate")])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.best_places(table(prepare(spark), sf_dir, "google_discovery")).select("state", "city", "google_place_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return canonical.map_typed_values(*[table(spark, sf_dir, name) for name in ("google_discovery", "lawyer_enrichment", "practice_area_ref", "city_ref")])


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens) of all documents, counted once."""
    return cut_lineage(tokens.count_tokens(table(prepare(spark), sf_dir, "documents").select("doc_id", "source", "text")))


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_sized(spark, sf_dir), table(spark, sf_dir, "container_spec"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p8_packed(spark, sf_dir))


def p9_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sized(spark, sf_dir), table(spark, sf_dir, "mix_target"))


def p8_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of ``p8_packed``: every token of every text once, no text cut without need, no container over its capacity, and the
    containers filled to 95 of 100 in all."""
    items = _sized(spark, sf_dir)
    packed = cut_lineage(packing.pack(items, table(spark, sf_dir, "container_spec")))
    there = items.agg(F.sum("n_tokens").alias("tokens"))
    of_doc = packed.groupBy("container_kind", "capacity", "doc_id").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("n")).withColumn("needless", (F.col("pieces") > F.ceil(F.col("n") / F.col("capacity"))).cast("long"))
    docs = of_doc.groupBy("container_kind", "capacity").agg(F.count("*").alias("documents"), F.sum("n").alias("tokens_in"), F.sum("needless").alias("split_without_need"))
    boxes = packed.groupBy("container_kind", "capacity", "container_id").agg(F.sum("n_tokens").alias("n"))
    full = boxes.groupBy("container_kind", "capacity").agg(F.count_if(F.col("n") > F.col("capacity")).alias("over_capacity"), (F.sum("n") >= 0.95 * F.count("*") * F.first("capacity")).alias("well_filled"))
    return docs.join(full, ["container_kind", "capacity"]).crossJoin(there).select("container_kind", "capacity", "documents", (F.col("tokens") - F.col("tokens_in")).alias("missing_tokens"), "split_without_need", "over_capacity", "well_filled")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares asked for and reached at the largest budget that reaches the targets (exponent 1)."""
    return mixing.shares(_sized(spark, sf_dir), table(spark, sf_dir, "mix_target"))


def p9_tempered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixture larger than the targets allow, so the exponent is bisected to the repetition limits."""
    return mixing.mix(_sized(spark, sf_dir), table(spark, sf_dir, "mix_target"), mixing.BEYOND)


def p9_tempered_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(_sized(spark, sf_dir), table(spark, sf_dir, "mix_target"), mixing.BEYOND)


def p9_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of both mixtures: no document used too often, the target shares reached to 0.02, full budgets used, and an exponent
    strictly between 0 and 1 for the larger one."""
    items, targets = _sized(spark, sf_dir), table(spark, sf_dir, "mix_target")
    exact, large = mixing.shares(items, targets), mixing.shares(items, targets, mixing.BEYOND)
    few = lambda c: F.col(c) <= F.col("max_repeats")
    used = F.abs(F.col("share") - F.col("weight")) < 0.02
    larger = large.select("source", few("most_uses").alias("tempered_within_repeats"), ((F.col("exponent") > 0) & (F.col("exponent") < 1)).alias("exponent_between"), used.alias("used_whole"))
    return exact.select("source", few("most_uses").alias("within_repeats"), (F.abs(F.col("share") - F.col("target_share")) < 0.02).alias("share_reached")).join(larger, "source")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return subjects.document_subjects(*[table(spark, sf_dir, name) for name in ("documents", "doc_subject_label", "subject_ref")])


def p10_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(subject, documents, share of all documents) of the corpus."""
    total = table(prepare(spark), sf_dir, "documents").count()
    found = p10_found(spark, sf_dir).groupBy("subject").agg(F.count("*").alias("documents"))
    return found.withColumn("share", F.col("documents") / F.lit(total))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_templates": p1_templates,
        "p2_found": p2_found,
        "p2_classes": p2_classes,
        "p3_found": p3_found,
        "p3_truth": p3_truth,
        "p4_found": p4_found,
        "p4_links": p4_links,
        "p5_found": p5_found,
        "p6_found": p6_found,
        "p7_found": p7_found,
        "p8_packed": p8_packed,
        "p8_fill": p8_fill,
        "p8_checks": p8_checks,
        "p9_mixed": p9_mixed,
        "p9_shares": p9_shares,
        "p9_tempered": p9_tempered,
        "p9_tempered_shares": p9_tempered_shares,
        "p9_checks": p9_checks,
        "p10_found": p10_found,
        "p10_composition": p10_composition,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
