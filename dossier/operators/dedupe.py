"""Best row per key, duplicate groups, and rewriting tables around the survivors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.values import bar_key


def best_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row of each key with the largest ``order`` (a struct that ends in something unique). Rows with a null key stay as they are.

    An aggregate rather than a window: every task keeps one row a key before the shuffle, so hot keys are no hot partitions.
    """
    keyed = " and ".join(f"{k} is not null" for k in keys)
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.where(keyed).groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(F.max_by(row, order).alias("row")).select("row.*")
    return best.unionByName(df.where(f"not ({keyed})"))


def dedupe_by_licence(df: DataFrame, score: str = "completeness_score", position: str = "id") -> DataFrame:
    """Rows of one licence (number and state) become the one of the highest score, the earlier on a tie; rows without a number all stay."""
    keyed = df.withColumns({"_bar": F.nullif(bar_key(F.col("bar_number")), F.lit("")), "_state": F.coalesce(F.lower(F.trim("license_state")), F.lit(""))})
    return best_per_key(keyed, ["_bar", "_state"], F.struct(F.coalesce(F.col(score), F.lit(0)), -F.col(position))).drop("_bar", "_state")


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of the keys, null ones left out, that more than one row has."""
    return df.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def survivors(df: DataFrame, keys: list[str], order: Column, ident: str = "id") -> DataFrame:
    """(keys, winner, loser) for every row that gives way to the best of its group."""
    best = df.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys).agg(F.max_by(ident, order).alias("winner"), F.count("*").alias("n")).where("n > 1").drop("n")
    return df.join(best, keys).where(F.col(ident) != F.col("winner")).select(*keys, "winner", F.col(ident).alias("loser"))


def repoint_children(children: DataFrame, moves: DataFrame, parent: str, child_key: str) -> DataFrame:
    """Children of losers go to the winner unless it has one with that key already, which then is dropped; others stay."""
    moved = children.join(moves.select(F.col("loser").alias(parent), "winner"), parent, "left")
    own = moved.where("winner is null").select(F.col(parent).alias("winner"), child_key).distinct()
    free = moved.where("winner is not null").join(own, ["winner", child_key], "left_anti").drop(parent).withColumnRenamed("winner", parent)
    # Several losers may bring the same key; one of them stays.
    first = best_per_key(free, [parent, child_key], F.struct(*[F.col(c) for c in free.columns]))
    return moved.where("winner is null").drop("winner").unionByName(first.select(*children.columns))
