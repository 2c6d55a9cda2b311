"""Top N items within every group, by two-stage salted ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 32


def top_n_per_group(df: DataFrame, groups: list[str], order: list[Column], item: str, n: int, salts: int = SALTS) -> DataFrame:
    """The ``n`` first rows of each group in ``order``, with ``rank`` (1-based).

    Stage one ranks within (group, hash of the item) and keeps ``n`` of each subgroup, so that a group of any size is
    spread over ``salts`` tasks; stage two ranks the at most ``n * salts`` survivors of each group. ``order`` must end in
    a unique column to be deterministic. An empty input gives an empty result; a group with fewer rows keeps them all; null
    group values form a group of their own.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(item)), F.lit(salts)).cast("int"))
    first = Window.partitionBy(*groups, "_salt").orderBy(*order)
    survivors = salted.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n).drop("rank", "_salt")
    last = Window.partitionBy(*groups).orderBy(*order)
    return survivors.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= n)


def latest_rated_places(hits: DataFrame) -> DataFrame:
    """One row per (state, city, place): its rated hit of the latest ``discovered_at``, then largest ``discovery_id``.

    The state is trimmed and in upper case. Rows without a state (null or blank), rating (null or NaN), city or place do
    not count. The pick is a partial aggregate before the shuffle, so hot places are reduced where they are read.
    """
    state = F.upper(F.trim("state"))
    rated = hits.where((state != "") & F.col("google_rating").isNotNull() & ~F.isnan("google_rating") & F.col("city").isNotNull() & F.col("google_place_id").isNotNull())
    newest = F.max_by(
        F.struct("google_rating", "google_review_count"),
        F.struct("discovered_at", "discovery_id"),
    )
    return (
        rated.groupBy(state.alias("state"), "city", "google_place_id")
        .agg(newest.alias("hit"))
        .select("state", "city", "google_place_id", "hit.google_rating", "hit.google_review_count")
    )


def best_places(hits: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` best-rated places of each (state, city): rating, then review count (null last), then smallest place id."""
    order = [F.col("google_rating").desc(), F.col("google_review_count").desc_nulls_last(), F.col("google_place_id").asc()]
    return top_n_per_group(latest_rated_places(hits), ["state", "city"], order, "google_place_id", n)
