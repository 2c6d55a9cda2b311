"""Same postal address written differently.

Street names are bags of character bigrams weighted by inverse document frequency. Candidates come from an inverted
index on (house number, bigram) over each bag's prefix of rarest bigrams, as long as a bag can still reach the cosine without
them; pairs are verified by cosine, house number, street type, side and town. A typing error changes so many bigrams of a short
street that it falls short of the cosine, so streets of one house number also meet by the segment join of spellings.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.llm.addresses import Place, join_parts, parse_place, same_town
from dossier.llm.people import spelling_keys
from dossier.session import cut_lineage, drop_cut

#: Least cosine of two street names that are no spellings of each other.
COSINE = 0.7

PARSED = "rec string, number string, street string, kind string, side string, town string, state string, zip string"


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for r in batch.itertuples(index=False):
            place = parse_place(r.text if r.text else join_parts(r.line1, r.line2, r.city, r.state, r.zip))
            if place.number and (place.street or place.number.startswith("box")):
                rows.append((r.rec, *place))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in PARSED.split(", ")])


def address_records(places: DataFrame, profiles: DataFrame, candidates: DataFrame) -> DataFrame:
    """(rec, number, street, ...): the records of the three tables that name a street and number or a box.

    Null, blank and broken texts, and texts that name a town only, are no records.
    """
    text = lambda df, key, ident, column: df.select(F.concat(F.lit(f"{key}:"), F.col(ident)).alias("rec"), F.col(column).alias("text"), *[F.lit(None).cast("string").alias(c) for c in ("line1", "line2", "city", "state", "zip")])
    m = F.from_json("merged_data", "address struct<line1:string, line2:string, city:string, state:string, zip:string>")
    split = profiles.select("id", m.alias("m")).select(F.concat(F.lit("prof:"), F.col("id")).alias("rec"), F.lit(None).cast("string").alias("text"), *[F.col(f"m.address.{c}").alias(c) for c in ("line1", "line2", "city", "state", "zip")])
    union = text(places, "place", "scrape_id", "formatted_address").unionByName(split).unionByName(text(candidates, "cand", "candidate_id", "location"))
    return union.where("rec is not null and (text rlike '[0-9]' or line1 rlike '[0-9]' or line2 rlike '[0-9]')").mapInPandas(_parse, PARSED)


def bigrams(column: str):
    padded = F.concat(F.lit("^"), F.col(column), F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2))))


SIDE = ["number", "street", "kind", "side", "town", "state", "zip"]


def compatible(a: Place, b: Place) -> bool:
    """House number, street type, side and town of two records can be one place (streets are compared before)."""
    if a.number != b.number or (a.kind and b.kind and a.kind != b.kind) or (a.side and b.side and a.side != b.side):
        return False
    return same_town(a, b)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = len(SIDE)
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[2:]]
        keep = [compatible(a, b) for a, b in zip(map(Place._make, zip(*columns[:n])), map(Place._make, zip(*columns[n:])))]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def alike_streets(streets: DataFrame) -> DataFrame:
    """(a, b), a < b: distinct addresses of one house number whose streets reach ``COSINE``."""
    grams = streets.select("place", "number", F.explode(bigrams("street")).alias("gram"))
    # The alphabet bounds the number of bigrams (at most 38 * 38), so their counts may be broadcast.
    counts = grams.groupBy("gram").agg(F.count("*").alias("df"))
    total = F.lit(streets.count())
    weighted = grams.join(F.broadcast(counts), "gram").withColumn("w2", F.pow(F.log(1 + total / F.col("df")), 2))
    bag = Window.partitionBy("place")  # a bag has at most as many rows as its street has letters
    weighted = weighted.withColumns({"norm2": F.sum("w2").over(bag), "behind": F.sum("w2").over(bag.orderBy(F.col("w2").desc(), "gram").rowsBetween(0, Window.unboundedFollowing))})
    weighted = cut_lineage(weighted.select("place", "number", "gram", "w2", "norm2", "behind"))
    # What is behind the prefix weighs less than COSINE of the whole, so a bag that shares no prefix gram stays below it.
    prefix = weighted.where(F.col("behind") >= F.lit(COSINE**2) * F.col("norm2")).select("place", "number", "gram")
    x, y = prefix.alias("x"), prefix.alias("y")
    met = x.join(y, F.expr("x.number = y.number and x.gram = y.gram and x.place < y.place")).select(F.col("x.place").alias("a"), F.col("y.place").alias("b")).distinct()
    bags = weighted.groupBy("place").agg(F.collect_list(F.struct("gram", "w2")).alias("bag"), F.first("norm2").alias("norm2"))
    side = lambda s: bags.select(F.col("place").alias(s), F.col("bag").alias(f"{s}_bag"), F.col("norm2").alias(f"{s}_norm2"))
    dot = F.aggregate(F.array_intersect("a_bag", "b_bag"), F.lit(0.0), lambda s, g: s + g["w2"])
    return met.join(side("a"), "a").join(side("b"), "b").where(dot >= COSINE * F.sqrt(F.col("a_norm2") * F.col("b_norm2"))).select("a", "b")


def spelt_streets(streets: DataFrame) -> DataFrame:
    """(a, b), a < b: distinct addresses of one house number whose streets are spellings of each other, one or two edits apart."""
    names = streets.groupBy(F.col("number").alias("scope"), F.col("street").alias("name")).agg(F.count("*").alias("n")).withColumn("double", F.lit(False))
    near = spelling_keys(names).where("name <> key").select(F.col("scope").alias("number"), "name", "key")
    side = lambda street, s: streets.select("number", F.col("street").alias(street), F.col("place").alias(s))
    met = near.join(side("name", "x"), ["number", "name"]).join(side("key", "y"), ["number", "key"])
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def same_boxes(boxes: DataFrame) -> DataFrame:
    """(a, b), a < b: distinct boxes of one number and state; a box without a state meets those of its number in all states."""
    x, y = boxes.alias("x"), boxes.alias("y")
    ends = lambda met: met.select(F.least("x.place", "y.place").alias("a"), F.greatest("x.place", "y.place").alias("b"))
    in_state = ends(x.join(y, F.expr("x.number = y.number and x.state = y.state and x.place < y.place")))
    return in_state.unionByName(ends(boxes.where("state = ''").alias("x").join(boxes.where("state <> ''").alias("y"), F.expr("x.number = y.number"))))


def same_places(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs (a, b) of distinct addresses at one place, members (rec, place)); a < b.

    Records written alike after parsing are one distinct address, named by its first record, so copies never meet pairwise.
    """
    records = cut_lineage(records)
    firsts = cut_lineage(records.groupBy(*SIDE).agg(F.min("rec").alias("place")))
    streets, boxes = firsts.where("street <> ''"), firsts.where("street = ''")
    met = cut_lineage(alike_streets(streets).unionByName(spelt_streets(streets)).unionByName(same_boxes(boxes)).distinct())
    side = lambda s: firsts.select(F.col("place").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in SIDE])
    pairs = cut_lineage(met.join(side("a"), "a").join(side("b"), "b").select("a", "b", *[f"a_{c}" for c in SIDE], *[f"b_{c}" for c in SIDE]).mapInArrow(_verify, "a string, b string"))
    members = cut_lineage(records.join(firsts, SIDE).select("rec", "place"))
    drop_cut(met, records, firsts)
    return pairs, members


def address_pairs(places: DataFrame, profiles: DataFrame, candidates: DataFrame) -> DataFrame:
    """(rec_a, rec_b), rec_a < rec_b in byte order: every pair of records at one street address or box, as many as there are."""
    pairs, members = same_places(address_records(places, profiles, candidates))
    a = members.select(F.col("rec").alias("ra"), F.col("place").alias("a"))
    b = members.select(F.col("rec").alias("rb"), F.col("place").alias("b"))
    other = pairs.join(a, "a").join(b, "b").select("ra", "rb")
    alike = a.join(b, F.expr("a = b and ra < rb")).select("ra", "rb")
    return other.unionByName(alike).select(F.least("ra", "rb").alias("rec_a"), F.greatest("ra", "rb").alias("rec_b"))
