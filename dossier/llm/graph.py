"""Connected components of a graph kept in a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.session import cut_lineage, drop_cut


def _shuffled(vertex: Column, level: int) -> Column:
    """Another name for a vertex, one to one (shifts and exclusive or), so that the order of names is no order of the data."""
    x = vertex.bitwiseXOR(F.lit(0x9E3779B97F4A7 * (level + 1)))
    x = x.bitwiseXOR(F.shiftleft(x, 13))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 7))
    return x.bitwiseXOR(F.shiftleft(x, 17))


def connected_components(edges: DataFrame, most_levels: int = 60) -> DataFrame:
    """(id, component) of every vertex of ``edges(a, b)`` (longs); the component is its smallest vertex.

    Each level lets every vertex follow the smallest of its neighbours and itself, in an order that is shuffled anew, and
    draws those that follow the same one together. Only edges between different groups go on, so a level is a fraction of the one before
    and a path of n vertices takes about log n levels. Labels are pre-aggregated, nothing is gathered; the driver sees one
    number a level. At the end the levels are joined, the smallest first. Null ends and loops are dropped; no edges give an
    empty result.
    """
    edges = cut_lineage(edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct())
    levels: list[DataFrame] = []
    while not edges.isEmpty() or not levels:
        if len(levels) == most_levels:
            raise RuntimeError(f"components did not settle in {most_levels} levels")
        level = len(levels)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("id")).agg(F.min(_shuffled(F.col("b"), level)).alias("near"))
        labels = cut_lineage(nearest.select("id", F.least("near", _shuffled(F.col("id"), level)).alias("root")))
        levels.append(labels)
        end = lambda side: labels.select(F.col("id").alias(side), F.col("root").alias(f"r{side}"))
        crossing = edges.join(end("a"), "a").join(end("b"), "b").where("ra <> rb")
        rest = cut_lineage(crossing.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        drop_cut(edges)
        edges = rest
    drop_cut(edges)
    roots = levels[-1]
    for labels in reversed(levels[:-1]):
        above = roots.select(F.col("id").alias("root"), F.col("root").alias("further"))
        roots = labels.join(above, "root", "left").select("id", F.coalesce("further", "root").alias("root"))
    if len(levels) > 1:
        roots = cut_lineage(roots)
        drop_cut(*levels)
    smallest = roots.groupBy("root").agg(F.min("id").alias("component"))
    return roots.join(smallest, "root").select("id", "component")
