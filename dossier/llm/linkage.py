"""Matching entities across sources without keys: soft-logic linkage of profiles and candidates.

Each possible link (lawyer, candidate) is a variable in 0..1. Weighted rules pull at it: the similarity of names, places
and licences (squared hinge towards the similarity); exclusivity, since a candidate means one lawyer at most (hinge on
the sum of a candidate's links); transitivity, since candidates with one licence number mean the same lawyer (hinge
on the difference from the group). The convex problem is solved by alternating directions: every rule solves its own
part in closed form, then a variable becomes the mean of its copies. The values are the confidences.

No rule reaches beyond the candidates of one licence number (a candidate without one stands alone), so the problem falls apart into
blocks. Blocks in which no rule binds are settled by their similarities; the others iterate, a block in one task, and blocks of more than
``MOST_IN_TASK`` links by rounds of row expressions and aggregates over all tasks. Both ways take the same steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossier.llm.addresses import Place, parse_place, same_town
from dossier.llm.names import last_names, likely_middle, middle_conflict, written, written_match
from dossier.llm.people import arrow_schema, by_spelling, evidence, evidence_key, licence_number, resolve_representatives, spellings, street_close, under_evidence, with_copy, with_evidence, with_representatives, written_once
from dossier.session import cut_lineage, drop_cut

#: (similarity, rule weight) by kind of agreement and name level 1 (initials), 2 (typos), 3 (full).
BY_STREET = {3: (0.97, 6.0), 2: (0.95, 5.0), 1: (0.8, 3.0)}
BY_TOWN = {3: (0.9, 4.0), 2: (0.85, 3.0), 1: (0.6, 1.0)}
BY_STATE = {3: (0.6, 1.0), 2: (0.55, 0.8), 1: (0.2, 0.3)}
BY_LICENCE = (1.0, 20.0)
EXCLUSIVE, TRANSITIVE, RHO = 8.0, 1.0, 5.0
#: Rounds after which a block whose values or copies still differ by ``SETTLED`` is an error.
MOST_ROUNDS, SETTLED = 1_000, 0.002
#: Least confidence of a link: more than two equal rivals can both have, by more than the solver is exact to.
ACCEPT = 0.51
#: Links of a block that one task iterates at most.
MOST_IN_TASK = 200_000

FOUND = "candidate_id long, bar string, read string, number string, street string, town string, state string, zip string, lasts array<string>, doubles array<string>"
_FOUND = arrow_schema(FOUND)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, locations = batch.column("name").to_pylist(), batch.column("location").to_pylist()
        places = [parse_place(text) for text in locations]
        lasts = [last_names(n) for n in names]
        made = {"read": [written(n) for n in names], "lasts": [x for x, _ in lasts], "doubles": [y for _, y in lasts]} | {c: [getattr(p, c) for p in places] for c in ("number", "street", "town", "state", "zip")}
        yield pa.record_batch([pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name).cast(f.type) for f in _FOUND], schema=_FOUND)


def candidate_rows(found: DataFrame) -> DataFrame:
    """``FOUND`` rows with ``rep``: repeated finds with equal name, place and licence meet as one. Rows without an id are left out."""
    rows = found.where("candidate_id is not null").select("candidate_id", licence_number(F.col("bar_number")).alias("bar"), "name", "location")
    parsed = with_copy(rows.mapInArrow(_candidates, FOUND), ["read", "bar", "number", "street", "town", "state", "zip"])
    return with_representatives(cut_lineage(parsed), "candidate_id")


PLACE = ["number", "street", "town", "state", "zip"]
PROFILE_SIDE = ["read", "middle", *PLACE]
CANDIDATE_SIDE = ["read", *PLACE]


def similarity(profile: tuple, cand: tuple) -> tuple[float, float]:
    """(similarity, weight) of one profile row and one candidate (values of the two sides) of which one has no licence number; (0, 0) for none.

    Places, which are cheap, are looked at before the names.
    """
    read_a, middle, number_a, street_a, town_a, state_a, zip_a = profile
    read_b, number_b, street_b, town_b, state_b, zip_b = cand
    near = same_town(Place("", "", "", "", town_a or "", state_a or "", zip_a or ""), Place("", "", "", "", town_b or "", state_b or "", zip_b or ""))
    if near and street_close(number_a, street_a, number_b, street_b):
        table = BY_STREET
    elif town_a and town_b:
        table = BY_TOWN if near else None
    else:
        table = BY_STATE if state_a and state_a == state_b else None
    level = written_match(read_a, read_b) if table else 0
    if not level or middle and middle_conflict(middle, likely_middle(read_b)):
        return 0.0, 0.0
    return table[level]


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = len(PROFILE_SIDE)
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[3:]]
        both = [similarity(a, b) for a, b in zip(zip(*columns[:n]), zip(*columns[n:]))]
        made = pa.record_batch([*batch.columns[:3], pa.array([s for s, _ in both], pa.float64()), pa.array([w for _, w in both], pa.float64())], names=["lawyer", "cand", "bar", "s", "w"])
        yield made.filter(pa.array([s > 0 for s, _ in both], pa.bool_()))


#: What profiles and candidates meet by beside the spellings of their towns. A profile without a town meets the candidates that name one by a
#: key of its own ("u"), which is rare.
_NUMBER, _ZIP, _LOST = evidence_key("n", "number", "left(zip, 3)"), evidence_key("m", "zip", only="coalesce(number, '') = ''"), "coalesce(town, '') = ''"
OF_PROFILE = evidence(_NUMBER, _ZIP, evidence_key("s", "state"), evidence_key("u", "state", only=_LOST))
OF_CANDIDATE = evidence(_NUMBER, _ZIP, evidence_key("s", "state", only=_LOST), evidence_key("u", "state", only=f"not ({_LOST})"))


def possible_links(rows: DataFrame, cands: DataFrame, rows_spelt: DataFrame, cands_spelt: DataFrame) -> DataFrame:
    """(lawyer, cand, s, w, bar): links with any similarity, from rows that share a licence number, or a spelling of the last
    name and one of the town, or a street number and zip area (the state where one side names no more).

    ``rows(rep, lawyer, a_licensed, bar, ...)`` (a_licensed: any row of the lawyer has a licence number) and ``cands(cand, bar, ...)`` are representatives, the others are they ``by_spelling``. Two licence
    numbers decide alone, so a lawyer with one and a candidate with one meet by it and not by name.
    """
    left, right = under_evidence(rows_spelt, "across", "rep", "licensed").alias("l"), under_evidence(cands_spelt, "across", "cand", "licensed").alias("r")
    pairs = left.join(right, F.expr("l.k = r.k and not (l.licensed and r.licensed)")).select("rep", "cand").distinct()
    a = rows.select("rep", "lawyer", "a_licensed", *[F.col(c).alias(f"a_{c}") for c in PROFILE_SIDE])
    b = cands.select("cand", "bar", *[F.col(c).alias(f"b_{c}") for c in CANDIDATE_SIDE])
    # Candidates first: their columns are fewer, and what is shuffled again then lies sorted by them, which compresses.
    pairs = pairs.join(b, "cand").join(a, "rep").where("(a_state = b_state or a_state = '' or b_state = '') and not (a_licensed and bar is not null)")
    by_name = pairs.select("lawyer", "cand", "bar", *[f"a_{c}" for c in PROFILE_SIDE], *[f"b_{c}" for c in CANDIDATE_SIDE]).mapInArrow(_similar, "lawyer long, cand long, bar string, s double, w double")
    by_name = by_name.groupBy("lawyer", "cand", "bar").agg(F.max("s").alias("s"), F.max_by("w", "s").alias("w"))
    licences = rows.where("bar is not null").select("lawyer", "bar").distinct()
    by_licence = licences.join(cands.where("bar is not null").select("cand", "bar"), "bar").select("lawyer", "cand", F.lit(BY_LICENCE[0]).alias("s"), F.lit(BY_LICENCE[1]).alias("w"), "bar")
    return by_name.select("lawyer", "cand", "s", "w", "bar").unionByName(by_licence)


# --- the convex problem ----------------------------------------------------------------------------------------------
def iterate(cand: np.ndarray, group: np.ndarray, s: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Confidences of the links of one or more blocks by alternating directions. ``group``: number of the (lawyer, licence), -1 for none."""
    _, cand = np.unique(cand, return_inverse=True)
    tied = group >= 0
    members = group[tied]
    groups = int(members.max()) + 1 if tied.any() else 0
    per_cand, per_group = np.bincount(cand), np.bincount(members, minlength=groups)
    z, m = s.copy(), s[tied].copy()
    u1, u2, u3, um = np.zeros_like(s), np.zeros_like(s), np.zeros(len(m)), np.zeros(len(m))
    step, pull_most = EXCLUSIVE / RHO, TRANSITIVE / RHO
    for _ in range(MOST_ROUNDS):
        v2 = z - u2
        over = np.bincount(cand, v2)[cand] - 1.0
        k = per_cand[cand]
        y1 = (2 * w * s + RHO * (z - u1)) / (2 * w + RHO)
        y2 = np.where(over <= 0, v2, np.where(over >= k * step, v2 - step, v2 - over / k))
        copies, n = y1 + u1 + y2 + u2, np.full(len(s), 2.0)
        if groups:
            va, vb = z[tied] - u3, m - um
            pull = np.clip((va - vb) / 2, -pull_most, pull_most)
            y3, ym = va - pull, vb + pull
            copies[tied] += y3 + u3
            n[tied] += 1
            mean = np.clip(np.bincount(members, ym + um, minlength=groups) / np.maximum(per_group, 1), 0.0, 1.0)[members]
        new = np.clip(copies / n, 0.0, 1.0)
        u1, u2 = u1 + y1 - new, u2 + y2 - new
        # Settled when neither the values move nor the rules' copies differ from them.
        moved = max(np.abs(new - z).max(), np.abs(y1 - new).max(), np.abs(y2 - new).max())
        if groups:
            u3, um = u3 + y3 - new[tied], um + ym - mean
            moved = max(moved, np.abs(mean - m).max(), np.abs(y3 - new[tied]).max(), np.abs(ym - mean).max())
            m = mean
        z = new
        if moved < SETTLED:
            return z
    raise RuntimeError(f"a block of {len(s)} links did not settle in {MOST_ROUNDS} rounds")


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Confidences of links that come sorted by block; blocks are whole in a task, but a batch may end within one."""

    def solved(links: pd.DataFrame) -> pd.DataFrame:
        groups, _ = pd.factorize(pd.Series(np.where(links.bar.isna(), None, links.lawyer.astype(str) + "|" + links.block), dtype=object))
        z = iterate(links.cand.to_numpy(), groups, links.s.to_numpy(dtype=float), links.w.to_numpy(dtype=float)) if len(links) else []
        return pd.DataFrame({"lawyer": links.lawyer, "cand": links.cand, "confidence": z})

    waiting: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch.block.to_numpy() == batch.block.iloc[-1]
        if not last.all() or waiting and waiting[-1].block.iloc[-1] != batch.block.iloc[-1]:
            done = pd.concat([*waiting, batch[~last]], ignore_index=True)
            waiting = [batch[last]]
            yield solved(done)
        else:
            waiting.append(batch)
    if waiting:
        yield solved(pd.concat(waiting, ignore_index=True))


def iterate_rows(links: DataFrame) -> DataFrame:
    """(lawyer, cand, confidence) of ``links(lawyer, cand, s, w, bar)``, the steps of ``iterate`` as row expressions and aggregates.

    One row a link, with its consensus value z, a dual for each of its three rules, and the group value of its licence; each round
    is two aggregates (by candidate, by lawyer and licence) and a written table, of which the one before is dropped.
    """
    zero = F.lit(0.0)
    state = cut_lineage(links.select("lawyer", "cand", "s", "w", "bar", F.col("s").alias("z"), F.col("s").alias("m"), zero.alias("u1"), zero.alias("u2"), zero.alias("u3"), zero.alias("um")))
    for _ in range(MOST_ROUNDS):
        v = state.withColumn("v2", F.col("z") - F.col("u2"))
        sums = v.groupBy("cand").agg(F.sum("v2").alias("sum2"), F.count("*").alias("k"))
        v = v.join(sums, "cand")
        step = F.lit(EXCLUSIVE / RHO)
        over = F.col("sum2") - 1.0
        y1 = (2 * F.col("w") * F.col("s") + RHO * (F.col("z") - F.col("u1"))) / (2 * F.col("w") + RHO)
        y2 = F.when(over <= 0, F.col("v2")).when(over >= F.col("k") * step, F.col("v2") - step).otherwise(F.col("v2") - over / F.col("k"))
        va, vb = F.col("z") - F.col("u3"), F.col("m") - F.col("um")
        pull = F.greatest(F.lit(-TRANSITIVE / RHO), F.least(F.lit(TRANSITIVE / RHO), (va - vb) / 2))
        v = v.withColumns({"y1": y1, "y2": y2, "y3": F.when(F.col("bar").isNotNull(), va - pull), "ym": vb + pull})
        both = F.col("y1") + F.col("u1") + F.col("y2") + F.col("u2")
        copies = F.when(F.col("bar").isNotNull(), (both + F.col("y3") + F.col("u3")) / 3).otherwise(both / 2)
        v = v.withColumn("new", F.greatest(zero, F.least(F.lit(1.0), copies)))
        groups = v.where("bar is not null").groupBy("lawyer", "bar").agg(F.greatest(zero, F.least(F.lit(1.0), F.avg(F.col("ym") + F.col("um")))).alias("new_m"))
        v = v.join(groups, ["lawyer", "bar"], "left")
        old, state = state, cut_lineage(
            v.select(
                "lawyer", "cand", "s", "w", "bar", F.col("new").alias("z"), F.coalesce("new_m", "m").alias("m"),
                (F.col("u1") + F.col("y1") - F.col("new")).alias("u1"), (F.col("u2") + F.col("y2") - F.col("new")).alias("u2"),
                F.coalesce(F.col("u3") + F.col("y3") - F.col("new"), zero).alias("u3"), F.coalesce(F.col("um") + F.col("ym") - F.col("new_m"), zero).alias("um"),
                F.greatest(*[F.abs(F.col(x) - F.col(y)) for x, y in (("new", "z"), ("y1", "new"), ("y2", "new"), ("y3", "new"), ("new_m", "m"), ("ym", "new_m"))]).alias("moved"),
            )
        )
        drop_cut(old)
        if state.agg(F.max("moved")).first()[0] < SETTLED:
            return state.select("lawyer", "cand", F.col("z").alias("confidence"))
    raise RuntimeError(f"links did not settle in {MOST_ROUNDS} rounds")


def solve(links: DataFrame, most_in_task: int = MOST_IN_TASK) -> DataFrame:
    """(lawyer, cand, confidence) of ``links(lawyer, cand, s, w, bar)``, each (lawyer, cand) once.

    A candidate without a licence number is a block; so are all candidates of one. A block is settled (confidence = s) where no
    candidate has links of more than 1 in all and no licence pulls: its links then minimise every rule at once.
    """
    links = cut_lineage(links.withColumn("block", F.coalesce(F.concat(F.lit("b"), "bar"), F.concat(F.lit("c"), "cand"))))
    sizes = links.groupBy("block").agg(F.count("*").alias("n"), F.sum("s").alias("total"), F.min("lawyer").alias("low"), F.max("lawyer").alias("high"), F.min("s").alias("least"), F.max("s").alias("most"))
    binds = F.when(F.col("block").startswith("b"), (F.col("low") < F.col("high")) | (F.col("least") < F.col("most"))).otherwise(F.col("total") > 1)
    open_ = sizes.where(binds).select("block", (F.col("n") > most_in_task).alias("large"))
    marked = links.join(open_, "block", "left")
    found = marked.where("large is null").select("lawyer", "cand", F.col("s").alias("confidence"))
    small = marked.where("not large").select("lawyer", "cand", "s", "w", "bar", "block").repartition("block").sortWithinPartitions("block")
    found = found.unionByName(small.mapInPandas(_blocks, "lawyer long, cand long, confidence double"))
    if not open_.where("large").isEmpty():
        found = found.unionByName(iterate_rows(marked.where("large").select("lawyer", "cand", "s", "w", "bar")))
    return found


def link_rows(people: DataFrame, found: DataFrame) -> DataFrame:
    """(id, candidate_id, confidence): every row of the lawyer that each candidate most probably means.

    Links up to ``ACCEPT`` are left out. A profile without a full name counts only for candidates with a licence number.
    Empty tables give an empty result; extra columns are ignored. The spellings of names and towns are looked up once, for
    the profiles and the candidates together, and which profiles mean one lawyer is found by the operator for name variants.
    """
    finds, profiles = candidate_rows(found), with_representatives(written_once(people), "id")
    one, cands = profiles.where("id = rep"), finds.where("candidate_id = rep").drop("candidate_id").withColumnRenamed("rep", "cand")
    known = spellings(one, cands)
    spelt = cut_lineage(by_spelling(with_evidence(one).withColumn("across", F.expr(OF_PROFILE)), known, "rep", "adm", "licensed", "together", "across"))
    same = resolve_representatives(one, spelt)
    # What is known of a lawyer is gathered before the wide columns are there.
    whose = one.select("rep", F.col("bar").isNotNull().alias("has")).join(same, "rep", "left").select("rep", F.coalesce("lawyer", "rep").alias("lawyer"), "has")
    lawyer = cut_lineage(whose.select("rep", "lawyer", F.max("has").over(Window.partitionBy("lawyer")).alias("a_licensed")))
    cands_spelt = by_spelling(cands.withColumns({"licensed": F.col("bar").isNotNull(), "across": F.expr(OF_CANDIDATE)}), known, "cand", "licensed", "across")
    links = cut_lineage(solve(possible_links(one.join(lawyer, "rep"), cands, spelt, cands_spelt)).where(F.col("confidence") > ACCEPT))
    drop_cut(spelt, known)
    matched = links.join(finds.select(F.col("rep").alias("cand"), "candidate_id", "bar"), "cand")
    members = profiles.select("id", "rep", F.col("full_name").isNotNull().alias("named")).join(lawyer.select("rep", "lawyer"), "rep")
    return matched.join(members, "lawyer").where("named or bar is not null").select("id", "candidate_id", "confidence")
