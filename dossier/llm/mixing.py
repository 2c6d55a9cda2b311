"""Mixing sources to target weights, by temperature and budgeted block permutations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sources of a mixture, at most: the driver reads one row a source.
MOST_SOURCES = 100_000
#: Blocks that a source is permuted in.
BLOCKS = 1_024
SEED = 17
#: A budget halfway between the largest that reaches the targets and all that the repetition limits allow.
BEYOND = "beyond"


def bisect(low: float, high: float, good, rounds: int = 60) -> float:
    """The largest value of low..high that is ``good``, which holds at low and stops holding once."""
    if good(high):
        return high
    for _ in range(rounds):
        middle = (low + high) / 2
        low, high = (middle, high) if good(middle) else (low, middle)
    return low


def tempered(natural: dict[str, float], targets: dict[str, float], exponent: float) -> dict[str, float]:
    """natural^(1 - e) * target^e, normalised: each source's weight relative to its natural share, softened by the exponent.

    0 gives the natural shares, 1 the targets; with even targets it is the plain temperature, natural^(1 - e).
    """
    raised = {s: natural[s] * (targets[s] / natural[s]) ** exponent for s in natural}
    total = sum(raised.values())
    return {s: r / total for s, r in raised.items()}


def mixture(sizes: dict[str, int], targets: dict[str, float], repeats: dict[str, int], budget: int | str | None = None) -> tuple[dict[str, float], float, int]:
    """(weights, exponent, budget in tokens).

    The weights are natural^(1 - e) * target^e, normalised: at e = 0 the shares of the tokens that the sources may give (their tokens
    times their repeats), the targets at e = 1. The exponent is the largest at which no source needs more than it may give. Without a budget it
    is the largest that reaches the targets themselves, so e = 1; ``BEYOND`` is more, so e is less. Sources without tokens or target have
    weight 0, and the others share theirs.
    """
    usable = [s for s in targets if sizes.get(s, 0) > 0 and targets[s] > 0 and repeats.get(s, 0) > 0]
    if not usable:
        return {}, 1.0, 0
    total = sum(targets[s] for s in usable)
    wanted = {s: targets[s] / total for s in usable}
    room = {s: sizes[s] * repeats[s] for s in usable}
    reached = int(min(room[s] / wanted[s] for s in usable))
    if budget is None:
        budget = reached
    elif budget == BEYOND:
        budget = (reached + sum(room.values())) // 2
    whole = sum(room.values())
    natural = {s: room[s] / whole for s in usable}
    weights = lambda e: tempered(natural, wanted, e)
    fits = lambda e: all(weights(e)[s] * budget <= room[s] + 1e-6 for s in usable)
    if not fits(0.0):
        budget = int(min(budget, sum(room.values())))
    exponent = bisect(0.0, 1.0, fits)
    return weights(exponent), exponent, budget


def source_sizes(items: DataFrame) -> DataFrame:
    """(source, docs, tokens) of each source; rows without a source, id or tokens are in no mixture."""
    return items.where("source is not null and doc_id is not null and n_tokens > 0").groupBy("source").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))


def plan(items: DataFrame, targets: DataFrame, budget: int | str | None = None) -> tuple[list[tuple], float]:
    """((source, tokens there, target share, weight, tokens to use) of each target source, exponent); one row a source on the driver.

    ``budget``: see ``mixture``.
    """
    sizes = source_sizes(items)
    rows = targets.where("source is not null").select("source", "target_share", "max_repeats").join(sizes, "source", "left").orderBy("source").limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    weights, exponent, budget = mixture({r.source: r.tokens or 0 for r in rows}, {r.source: r.target_share or 0.0 for r in rows}, {r.source: r.max_repeats or 0 for r in rows}, budget)
    return [(r.source, r.tokens or 0, r.target_share, weights.get(r.source, 0.0), min(weights.get(r.source, 0.0) * budget, float((r.tokens or 0) * (r.max_repeats or 0)))) for r in rows], exponent


def mix(items: DataFrame, targets: DataFrame, budget: int | str | None = None, blocks: int = BLOCKS) -> DataFrame:
    """(source, doc_id, use, n_tokens, at): every use of every document; ``at`` orders the mixture (a hash, so sources interleave).

    A source is used whole as often as its budget allows; the last, partial pass takes documents in the order of a
    permutation of its blocks and of the documents within a block, until the budget is spent. Prefix sums are taken over
    block totals first, so only the block in which the budget ends is summed row by row. Documents are never cut; the last
    one is left out if it exceeds the budget.
    """
    spark = items.sparkSession
    schema = T.StructType([T.StructField("source", T.StringType()), T.StructField("there", T.LongType()), T.StructField("target_share", T.DoubleType()), T.StructField("weight", T.DoubleType()), T.StructField("tokens_to_use", T.DoubleType())])
    chosen = F.broadcast(spark.createDataFrame(plan(items, targets, budget)[0], schema).where("tokens_to_use > 0"))
    used = items.where("source is not null and doc_id is not null and n_tokens > 0").select("doc_id", "source", "n_tokens").join(chosen, "source")
    used = used.withColumn("passes", F.floor(F.col("tokens_to_use") / F.col("there")).cast("int")).withColumn("rest", F.col("tokens_to_use") - F.col("passes") * F.col("there"))
    whole = used.where("passes > 0").select("source", "doc_id", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("passes"))).alias("use"))
    order = F.xxhash64(F.lit(SEED), "source", "doc_id")
    last = used.where("rest >= 1").select("source", "doc_id", "n_tokens", "passes", "rest", order.alias("order")).withColumn("block", F.pmod("order", F.lit(blocks)))
    sums = last.groupBy("source", "block", "rest").agg(F.sum("n_tokens").alias("in_block"))
    before = F.sum("in_block").over(Window.partitionBy("source").orderBy(F.xxhash64(F.lit(SEED), "block"), "block")) - F.col("in_block")
    sums = sums.withColumn("before", before).withColumn("inside", F.col("before") + F.col("in_block") <= F.col("rest"))
    kept = sums.where("before < rest").select("source", "block", "before", "inside")
    placed = last.join(kept, ["source", "block"])
    running = F.sum("n_tokens").over(Window.partitionBy("source", "block").orderBy("order", "doc_id"))
    edge = placed.where("not inside").withColumn("upto", F.col("before") + running).where("upto <= rest")
    part = placed.where("inside").select("source", "doc_id", "n_tokens", (F.col("passes") + 1).alias("use")).unionByName(edge.select("source", "doc_id", "n_tokens", (F.col("passes") + 1).alias("use")))
    return whole.unionByName(part).withColumn("at", F.xxhash64(F.lit(SEED + 1), "source", "doc_id", "use")).select("source", "doc_id", "use", "n_tokens", "at")


def shares(items: DataFrame, targets: DataFrame, budget: int | str | None = None) -> DataFrame:
    """(source, docs_there, tokens_there, target_share, max_repeats, weight, exponent, uses, tokens_used, most_uses, share) of ``mix``: what
    was asked for and what was reached."""
    chosen, exponent = plan(items, targets, budget)
    asked = items.sparkSession.createDataFrame([(source, weight, exponent) for source, _, _, weight, _ in chosen], "source string, weight double, exponent double")
    there = source_sizes(items).select("source", F.col("docs").alias("docs_there"), F.col("tokens").alias("tokens_there"))
    got = mix(items, targets, budget).groupBy("source").agg(F.count("*").alias("uses"), F.sum("n_tokens").alias("tokens_used"), F.max("use").alias("most_uses"))
    joined = targets.select("source", "target_share", "max_repeats").join(there, "source", "left").join(got, "source", "left").join(asked, "source", "left").withColumn("total", F.sum("tokens_used").over(Window.partitionBy()))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return joined.select("source", zero("docs_there"), zero("tokens_there"), "target_share", "max_repeats", "weight", "exponent", zero("uses"), zero("tokens_used"), zero("most_uses"), (F.coalesce("tokens_used", F.lit(0)) / F.col("total")).alias("share"))
