"""Ranking with quotas from a table, ordered distinct lists, early stops and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Parts of a group that are ranked apart before what is left of them is ranked together.
SALTS = 64


def rank_with_quota(df: DataFrame, group: str, order: list[Column], quotas: DataFrame, rank: str = "rank", salts: int = SALTS) -> DataFrame:
    """The first ``quota`` rows of each group of ``quotas(group, quota)``; groups without a positive quota go.

    ``order`` must end in a unique column. Groups without a quota are dropped by the join, which the planner broadcasts if the table is small. A hot
    group is ranked in ``salts`` parts first, so no task sees more of it than a part and the winners of all parts.
    """
    kept = df.join(quotas.where("quota > 0"), group).withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
    first = kept.withColumn("_part", F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order))).where(F.col("_part") <= F.col("quota"))
    return first.drop("_salt", "_part").withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col(rank) <= F.col("quota")).drop("quota")


def concat_ranked(ranked: DataFrame, group_order: Column, limit: int, rank: str = "rank") -> DataFrame:
    """The first ``limit`` rows of the groups laid end to end."""
    return ranked.orderBy(group_order, rank).limit(limit)


def stop_after(df: DataFrame, partition: list[str], order: list[Column], size: Column, budget: int) -> DataFrame:
    """Whole rows (pages) until the sum of ``size`` before a row reaches ``budget``: the last may overshoot."""
    spent = F.coalesce(F.sum(size).over(Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("_spent", spent).where(F.col("_spent") < budget).drop("_spent")


def ordered_distinct(df: DataFrame, keys: list[str], value: str, position: str) -> DataFrame:
    """(keys, values): the different values of a group in the order of their first position. Repeats go before the lists are gathered."""
    first = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(position).alias("_at"))
    pairs = F.array_sort(F.collect_list(F.struct("_at", value)))
    return first.groupBy(*keys).agg(F.transform(pairs, lambda x: x[value]).alias("values"))
