"""Filling fixed-capacity containers with items, by the sum of squares.

An item goes where the sum over gaps of the squared number of open containers with that gap becomes smallest, which keeps
all gaps in stock and so leaves little room. Items are spread over blocks of bounded size by a hash; each block is
packed alone, so no task sees more than about ``BLOCK`` items whatever the table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.session import cut_lineage

#: Items of a block, about. The loss at its end is a few containers a block.
BLOCK = 20_000
#: Kinds of containers, at most: the specification is a small fixed table that the driver reads.
MOST_KINDS = 1_000


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container number of each item, in the order given; sizes are in 1..capacity."""
    count = np.zeros(capacity + 1, dtype=np.int64)  # open containers by gap; gaps 0 and capacity stay 0
    stock: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), dtype=np.int64)
    made = 0
    for k, size in enumerate(sizes.tolist()):
        gaps = np.flatnonzero(count[size:]) + size
        # Change of the sum when a container with this gap takes the item; a full container counts nothing.
        left = gaps - size
        change = np.where(left > 0, 2 * count[left] + 1, 0) - 2 * count[gaps] + 1
        fresh = 2 * count[capacity - size] + 1 if size < capacity else 0
        at = int(change.argmin()) if len(gaps) else -1
        if at >= 0 and change[at] <= fresh:
            gap = int(gaps[at])
            box = stock[gap].pop()
            count[gap] -= 1
        else:
            gap, box = capacity, made
            made += 1
        gap -= size
        if gap:
            stock[gap].append(box)
            count[gap] += 1
        out[k] = box
    return out


def pieces(items: DataFrame, capacities: list[tuple[str, int]]) -> DataFrame:
    """(container_kind, capacity, doc_id, piece, from_token, n_tokens): an item longer than the capacity is cut into full
    pieces and a rest; others are one piece. Items of no size (null or not positive) have none."""
    kinds = F.explode(F.array(*[F.struct(F.lit(kind).alias("container_kind"), F.lit(capacity).cast("long").alias("capacity")) for kind, capacity in capacities])).alias("k")
    each = items.where("n_tokens > 0 and doc_id is not null").select("doc_id", "n_tokens", kinds).select("doc_id", "n_tokens", "k.*")
    numbers = F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.col("capacity"))).alias("piece", "from_token")
    cut = each.select("container_kind", "capacity", "doc_id", F.col("n_tokens").alias("total"), numbers)
    return cut.select("container_kind", "capacity", "doc_id", "piece", "from_token", F.least("capacity", F.col("total") - F.col("from_token")).alias("n_tokens"))


PACKED = "container_kind string, capacity long, container_id string, doc_id long, piece int, from_token long, n_tokens long"


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    # Longest first: what is small fills the gaps that the others left.
    group = group.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True])
    capacity = int(group["capacity"].iloc[0])
    boxes = sum_of_squares(group["n_tokens"].to_numpy(), capacity)
    name = f"{group['container_kind'].iloc[0]}-{int(group['block'].iloc[0])}-"
    return group.assign(container_id=[name + str(b) for b in boxes])[[c.split()[0] for c in PACKED.split(", ")]]


def pack(items: DataFrame, spec: DataFrame, block: int = BLOCK) -> DataFrame:
    """``PACKED`` rows: every piece of ``items(doc_id, n_tokens)`` in a container of each kind of ``spec(container_kind, capacity_tokens)``.

    Kinds without a positive capacity are left out; an empty table or specification gives no rows. Equal items are told
    apart by their id, so the result is deterministic.
    """
    rows = spec.where("capacity_tokens > 0 and container_kind is not null").select("container_kind", "capacity_tokens").distinct().orderBy("container_kind", "capacity_tokens").limit(MOST_KINDS + 1).collect()
    if len(rows) > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} kinds of containers")
    if not rows:
        return items.sparkSession.createDataFrame([], PACKED)
    parts = cut_lineage(pieces(cut_lineage(items.select("doc_id", "n_tokens")), [(r.container_kind, r.capacity_tokens) for r in rows]))
    # A full piece is a container of its own and needs no packing.
    full = parts.where("n_tokens = capacity").withColumn("container_id", F.concat_ws("-", "container_kind", F.lit("full"), "doc_id", "piece"))
    rest = parts.where("n_tokens < capacity")
    counts = rest.groupBy("container_kind", "capacity").agg(F.ceil(F.count("*") / block).alias("blocks"))
    placed = rest.join(F.broadcast(counts), ["container_kind", "capacity"]).withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), "blocks"))
    packed = placed.groupBy("container_kind", "capacity", "block").applyInPandas(_pack, PACKED)
    return packed.unionByName(full.select(*packed.columns))


def fill_report(packed: DataFrame) -> DataFrame:
    """(container_kind, capacity, containers, tokens, fill): how full the containers of each kind are; by two aggregates, containers first."""
    boxes = packed.groupBy("container_kind", "capacity", "container_id").agg(F.sum("n_tokens").alias("tokens"))
    total = boxes.groupBy("container_kind", "capacity").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"))
    return total.withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity")))
