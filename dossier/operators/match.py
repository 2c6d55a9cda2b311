"""Scoring of candidates against a target, and the choice among them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.functions.addresses import address_similarity, is_street_address
from dossier.functions.names import FIRM_WORDS, MATCH_PREFIXES, SUFFIXES, firm_tokens, last_token, match_key, name_tokens, word_tokens
from dossier.session import cut_lineage, drop_cut


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of two texts (no built-in gives it); null texts count as empty."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


def contains_phrase(text: Column, phrase: Column) -> Column:
    """Whether the phrase stands in the text between word boundaries, regardless of case."""
    quoted = F.concat(F.lit(r"\b\Q"), F.lower(F.trim(phrase)), F.lit(r"\E\b"))
    return F.coalesce((F.trim(phrase) != "") & F.regexp_like(F.lower(F.trim(text)), quoted), F.lit(False))


def _with_names(targets: DataFrame) -> DataFrame:
    """``targets`` with the words that its names are compared by: ``_first``, ``_last``, ``_all`` and the surnames ``_sur``."""
    none = F.array().cast("array<string>")
    own = name_tokens(F.col("full_name"))
    given, family = word_tokens(F.coalesce("first_name", F.lit(""))), word_tokens(F.coalesce("last_name", F.lit("")))
    p = targets.withColumns({"_p": own, "_g": given, "_f": family})
    p = p.withColumns({
        "_first": F.coalesce(F.get("_g", F.lit(0)), F.get("_p", F.lit(0)), F.lit("")),
        "_last": F.coalesce(F.when(F.size("_f") > 0, F.element_at("_f", -1)), F.when(F.size("_p") > 0, F.element_at("_p", -1)), F.lit("")),
        "_all": F.array_distinct(F.filter(F.concat("_p", "_g", "_f"), lambda w: F.length(w) >= 2)),
    })
    second_last = F.when(F.size("_p") >= 4, F.array(F.get("_p", F.size("_p") - 2))).otherwise(none)
    return p.withColumn("_sur", F.filter(F.concat("_f", F.array("_last"), second_last), lambda w: F.length(w) >= 3))


def _phrase_matches(locations: DataFrame, phrases: DataFrame) -> DataFrame:
    """(location, phrase) of ``locations(location)`` and ``phrases(phrase)``, distinct values, where ``contains_phrase`` holds.

    They meet by the first three words of the phrase, or by all of a shorter one, so that a common first word brings nothing together.
    """
    run = lambda words, i, n: F.concat(n.cast("string"), F.lit(" "), F.array_join(F.slice(words, i, n), " "))
    asked = phrases.withColumn("_w", word_tokens(F.col("phrase"))).where("size(_w) > 0").select("phrase", run(F.col("_w"), F.lit(1), F.least(F.size("_w"), F.lit(3))).alias("run"))
    said = locations.withColumn("_w", word_tokens(F.col("location"))).where("size(_w) > 0")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.size("_w")), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(3), F.size("_w") - i + 1)), lambda n: run(F.col("_w"), i, n))))
    said = said.select("location", F.explode(F.array_distinct(runs)).alias("run"))
    return said.join(asked, "run").where(contains_phrase(F.col("location"), F.col("phrase"))).select("location", "phrase")


def possible_pairs(targets: DataFrame, found: DataFrame, target: str, candidate: str) -> DataFrame:
    """(target, candidate): every pair that ``score_candidates`` can give 0.6 or more, and few others.

    0.6 takes an equal licence; or a common surname with a given name or initial, or else with the town or state; or, without a
    common surname, the town with a given name or initial. Each of these is an equality join of its own. ``targets`` and
    ``found`` have the columns that ``score_candidates`` asks of the two sides, and their ids; a null or blank value meets nothing.
    A town or state without any letter or figure is not looked up.
    """
    texts = lambda c: F.array_distinct(F.filter(c, lambda w: w != ""))
    one = lambda c: F.array(c)
    bar = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    own = _with_names(targets)
    seen = found.withColumn("_c", name_tokens(F.col("name"))).withColumn("_head", F.coalesce(F.get("_c", F.lit(0)), F.lit("")))
    locations = found.where("location is not null").select("location").distinct()
    places = lambda c: targets.select(F.lower(F.trim(c)).alias("phrase")).where("phrase <> ''").distinct()
    phrases = places("city").union(places("state_code")).union(places("state_name")).distinct()
    at = _phrase_matches(locations, phrases).groupBy("location").agg(F.collect_set("phrase").alias("_at"))
    seen = seen.join(at, "location", "left")
    initial = F.left("_first", F.lit(1))
    cross = lambda kind, xs, ys: F.flatten(F.transform(texts(xs), lambda x: F.transform(texts(ys), lambda y: F.concat_ws("|", F.lit(kind), x, y))))
    keys = lambda *parts: F.explode(F.array_distinct(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in parts])))
    town = F.array_compact(one(F.lower(F.trim("city"))))
    states = F.array_compact(F.array(F.lower(F.trim("state_code")), F.lower(F.trim("state_name"))))
    last = F.concat("_sur", one(F.col("_last")))
    single = F.when(F.length("_head") == 1, one(F.col("_head")))
    mine = keys(
        *[x for where, kind in ((last, "n"), (town, "t")) for x in (cross(f"{kind}f", where, one(F.col("_first"))), cross(f"{kind}h", where, F.col("_all")), cross(f"{kind}i", where, one(initial)))],
        cross("p", last, F.concat(town, states)), F.array_compact(one(F.concat(F.lit("b|"), bar("target_bar")))),
    )
    theirs = keys(
        *[x for where, kind in ((F.col("_c"), "n"), (F.col("_at"), "t")) for x in (cross(f"{kind}f", where, F.col("_c")), cross(f"{kind}h", where, one(F.col("_head"))), cross(f"{kind}i", where, single))],
        cross("p", F.col("_c"), F.col("_at")), F.array_compact(one(F.concat(F.lit("b|"), F.when(~bar("bar_number").isin("n/a", "none"), bar("bar_number"))))),
    )
    a, b = own.select(target, mine.alias("_k")), seen.select(candidate, theirs.alias("_k"))
    return a.select(target, F.xxhash64("_k").alias("_k")).join(b.select(candidate, F.xxhash64("_k").alias("_k")), "_k").select(target, candidate).distinct()


def score_candidates(pairs: DataFrame) -> DataFrame:
    """``pairs`` (name, location, bar_number of a candidate; full_name, first_name, last_name, city, state_code, state_name and
    target_bar of a target) with ``confidence`` and ``match_signals``.

    An equal licence number is 1.0. Otherwise last name 0.3, first name 0.2 or its initial 0.1, similar spelling (0.8 or more) 0.2, town 0.2 and
    state 0.1; the names must agree in last name and first name or initial, or be spelled alike to 0.75, else 0.
    The cheap tests run in the engine; only pairs without an equal licence need the sequence ratio.
    """
    none = F.array().cast("array<string>")
    p = pairs.withColumn("_c", name_tokens(F.col("name")))
    p = _with_names(p)
    surnames = F.col("_sur")
    head = F.coalesce(F.get("_c", F.lit(0)), F.lit(""))
    last = (F.col("_last") != "") & (F.array_contains("_c", F.col("_last")) | F.arrays_overlap(surnames, F.col("_c")))
    first = (F.col("_first") != "") & (F.array_contains("_c", F.col("_first")) | F.array_contains("_all", head))
    initial = (F.col("_first") != "") & (F.length(head) == 1) & (head == F.left("_first", F.lit(1)))
    bar = F.lower(F.trim("bar_number"))
    licence = F.coalesce((bar != "") & ~bar.isin("n/a", "none") & (bar == F.lower(F.trim("target_bar"))), F.lit(False))
    p = p.withColumns({"_licence": licence, "_lm": F.coalesce(last, F.lit(False)), "_fm": F.coalesce(first, F.lit(False)), "_im": F.coalesce(initial, F.lit(False))})
    full = sequence_ratio(F.array_join("_all", " "), F.array_join("_c", " "))
    short = sequence_ratio(F.concat_ws(" ", "_first", "_last"), F.concat_ws(" ", head, F.when(F.size("_c") > 0, F.element_at("_c", -1))))
    p = p.withColumns({"_full": full, "_short": short})
    both = (F.col("_first") != "") & (F.col("_last") != "")
    similar = F.when((F.size("_all") > 0) & (F.size("_c") > 0), F.greatest(F.col("_full"), F.when(both, F.col("_short")).otherwise(0.0))).otherwise(0.0)
    p = p.withColumn("_s", similar)
    p = p.withColumns({"_city": contains_phrase(F.col("location"), F.col("city")), "_state": contains_phrase(F.col("location"), F.col("state_code")) | contains_phrase(F.col("location"), F.col("state_name"))})
    gate = (F.size("_c") > 0) & ((F.col("_lm") & (F.col("_fm") | F.col("_im"))) | (F.col("_s") >= 0.75))
    part = lambda test, n: F.when(test, n).otherwise(0.0)
    total = part(F.col("_lm"), 0.3) + F.when(F.col("_fm"), 0.2).when(F.col("_im"), 0.1).otherwise(0.0) + part(F.col("_city"), 0.2) + part(F.col("_state"), 0.1) + part(F.col("_s") >= 0.8, 0.2)
    named = lambda test, name: F.when(test, F.lit(name))
    signals = F.array_compact(F.array(named(F.col("_lm"), "last_name_match"), F.when(F.col("_fm"), "first_name_match").when(F.col("_im"), "first_initial_match"), named(F.col("_city"), "city_match"), named(F.col("_state"), "state_match"), F.when(F.col("_s") >= 0.8, F.concat(F.lit("name_similarity_"), F.round(F.col("_s") * 100).cast("int")))))
    confidence = F.when(F.col("_licence"), 1.0).when(gate, F.least(F.lit(1.0), F.round(total, 2))).otherwise(0.0)
    match = F.when(F.col("_licence"), F.array(F.lit("bar_number_exact"))).when(gate, signals).otherwise(none)
    return p.select(*pairs.columns, confidence.alias("confidence"), match.alias("match_signals"))


def best_candidate(scored: DataFrame, target: str, candidate: str, cut: float) -> DataFrame:
    """The candidate of each target with the highest confidence from ``cut`` on (ties: smallest candidate)."""
    row = F.struct(*[F.col(c) for c in scored.columns])
    return scored.where(F.col("confidence") >= cut).groupBy(F.col(target).alias("_t")).agg(F.max_by(row, F.struct("confidence", -F.col(candidate))).alias("row")).select("row.*")


# --- the best target of each candidate, without scoring all pairs -----------------------------------------------------
#: Rows of a bucket from which letters are counted, by numpy, before texts are compared.
MANY = 32
_LETTERS = {c: i for i, c in enumerate(" abcdefghijklmnopqrstuvwxyz0123456789")}


@lru_cache(maxsize=100_000)
def _letter_bits(text: str) -> tuple[int, int]:
    """A bit for each letter and how often it came before, up to four times, and the number of letters beyond."""
    bits, seen = 0, {}
    for c in text:
        n = seen[c] = seen.get(c, -1) + 1
        if n < 4:
            bits |= 1 << 4 * _LETTERS[c] + n
    return bits, len(text) - bits.bit_count()


@lru_cache(maxsize=200_000)
def _alike(whole: str, short: str, name: str, ends: str) -> float:
    """The spelling similarity of ``score_candidates`` where it is 0.75 or more; what cannot reach that is given as less."""
    if not whole or not name:
        return 0.0
    if short and short == ends:
        return 1.0
    best = 0.0
    for a, b in ((whole, name), (short, ends)):
        (bits_a, more_a), (bits_b, more_b) = _letter_bits(a), _letter_bits(b)
        # The letters in common bound the ratio from above.
        if a and 2 * ((bits_a & bits_b).bit_count() + min(more_a, more_b)) >= 0.75 * (len(a) + len(b)):
            best = max(best, SequenceMatcher(None, a, b).ratio())
    return best


def _counts(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), len(_LETTERS)), np.int16)
    for row, text in zip(out, texts):
        for c in text:
            row[_LETTERS[c]] += 1
    return out


class _Bucket:
    """Targets that share a key, by id: what a candidate under the key can get from them."""

    def __init__(self, key: str) -> None:
        self.kind = key[0]
        self.rows: list[tuple] = []
        self.by_state: dict[str, list[int]] = {}
        self.letters: tuple | None = None
        self.asked: tuple = ()

    def add(self, ref: int, text: str, states: list[str]) -> None:
        first, last, whole, sur = text.split("|")
        for state in set(states):
            self.by_state.setdefault(state, []).append(len(self.rows))
        self.rows.append((ref, first, {last, *sur.split()}, set(whole.split()), whole, f"{first} {last}" if first and last else "", states))

    def names(self, row: tuple, words: list[str]) -> int:
        """Tenths for last name and given name or initial."""
        _, first, lasts, whole, *_ = row
        given = 2 * (first in words or words[0] in whole) or int(words[0] == first[:1]) if first else 0
        return 3 * any(w in lasts for w in words) + given

    def alike(self, row: tuple, name: str, ends: str) -> float:
        return _alike(row[4], row[5], name, ends)

    def first_alike(self, among: Sequence[int], name: str, ends: str) -> tuple | None:
        """The first of the rows whose spelling is similar to 0.8."""
        if len(among) > MANY:
            if self.letters is None:
                self.letters = [(_counts(texts), np.array([len(t) for t in texts])) for texts in ([r[4] for r in self.rows], [r[5] for r in self.rows])]
            among = np.asarray(among)
            near = np.zeros(len(among), bool)
            for (counts, sizes), text in zip(self.letters, (name, ends)):
                near |= 2 * np.minimum(counts[among], _counts([text])).sum(axis=1) >= 0.8 * (sizes[among] + len(text)) - 1e-6
            among = among[near]
        return next((self.rows[i] for i in among if self.alike(self.rows[i], name, ends) >= 0.8), None)

    def best(self, name: str, at: list[str]) -> tuple[int, int] | None:
        """(tenths, target) of the best pair, of 6 tenths or more; the smallest target of equal ones."""
        if self.asked[:2] == (name, at):
            return self.asked[2]
        words, found = name.split(), []
        ends = f"{words[0]} {words[-1]}"
        if self.kind == "t":  # last name and town: each pair
            top = (5, 0)
            for row in self.rows:
                n = self.names(row, words)
                most = n + 4 + any(s in at for s in row[6])
                if n >= 3 and most >= 6 and most > top[0]:
                    s = self.alike(row, name, ends)
                    if (n > 3 or s >= 0.75) and most - 2 * (s < 0.8) > top[0]:
                        top = (most - 2 * (s < 0.8), row[0])
                        if top[0] == 10:
                            break
            found = [top]
        else:
            town = 2 * (self.kind == "w")
            for state, among in [(1, self.by_state[s]) for s in at if s in self.by_state] + [(int(self.kind == "s"), range(len(self.rows)))]:
                if row := self.first_alike(among, name, ends):
                    found.append((self.names(row, words) + town + state + 2, row[0]))
                elif self.kind == "g" and state:  # last and given name and state do without the spelling
                    found.append((self.names(self.rows[among[0]], words) + 1, self.rows[among[0]][0]))
        got = max((f for f in found if f[0] >= 6), key=lambda f: (f[0], -f[1]), default=None)
        self.asked = (name, at, got)
        return got


def _best_in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(candidate, points, target) from rows of both sides that come sorted by key, the targets of a key (side 0) first."""
    key, bucket = None, None
    for batch in batches:
        keys, sides, refs = batch.column("k").to_pylist(), batch.column("side").to_pylist(), batch.column("ref").to_pylist()
        texts, places = batch.column("text"), batch.column("places")
        out: list[tuple] = []
        for i, k in enumerate(keys):
            if k != key:
                key, bucket = k, None
            if not sides[i]:
                bucket = bucket or _Bucket(k)
                bucket.add(refs[i], texts[i].as_py(), places[i].as_py())
            elif bucket and (got := bucket.best(texts[i].as_py(), places[i].as_py())):
                out.append((refs[i], *got))
        yield pa.record_batch([pa.array([o[j] for o in out], pa.int64()) for j in range(3)], names=["rep", "points", "target"])


def best_targets(targets: DataFrame, found: DataFrame, target: str, candidate: str) -> DataFrame:
    """(candidate, target): of all pairs with a confidence (``score_candidates``) of 0.6 or more the best of each candidate (ties:
    smallest target). Candidates and targets have the columns that ``score_candidates`` asks of them, and whole numbers for ids.

    No pair is made. Equal names and places of either side count once; targets and candidates are sorted by what they can share, and for each
    candidate the targets under a key are looked through by id up to the first that is as good as the key allows. The keys are last name and town;
    last and given name or initial, with the states looked up within; and, for candidates that have no more than these can give, last
    name and state, and given name and town. An equal licence is a join of its own.
    """
    words = lambda c: F.filter(c, lambda w: w != "")
    text = lambda c: F.array_join(c, " ")
    low = lambda c: F.coalesce(F.lower(F.trim(c)), F.lit(""))
    lines = lambda kind, xs, ys: F.flatten(F.transform(F.array_distinct(words(xs)), lambda x: F.transform(F.array_distinct(words(ys)), lambda y: F.concat_ws("|", F.lit(kind), x, y))))
    one = lambda c: F.array(c)
    none = F.array().cast("array<string>")
    own = _with_names(targets.where(F.col(target).isNotNull())).select(target, low("city").alias("town"), F.array_distinct(words(F.array(low("state_code"), low("state_name")))).alias("places"), F.concat_ws("|", "_first", "_last", text("_all"), text("_sur")).alias("text"))
    own = cut_lineage(own.groupBy("text", "town", "places").agg(F.min(target).alias("ref")))
    seen = found.where(F.col(candidate).isNotNull()).select(candidate, text(name_tokens(F.col("name"))).alias("text"), F.coalesce("location", F.lit("")).alias("location"))
    names = cut_lineage(seen.where("text <> ''").groupBy("text", "location").agg(F.min(candidate).alias("rep"), F.collect_list(candidate).alias("all")))
    places = lambda c: targets.select(low(c).alias("phrase")).where("phrase <> ''").distinct()
    phrases = places("city").union(places("state_code")).union(places("state_name")).distinct()
    at = _phrase_matches(names.select("location").distinct(), phrases).groupBy("location").agg(F.array_sort(F.collect_set("phrase")).alias("places"))
    theirs = cut_lineage(names.join(at, "location", "left").select(F.col("rep").alias("ref"), "text", F.coalesce("places", none).alias("places")))

    part = lambda i: F.split_part("text", F.lit("|"), F.lit(i))
    last, said = F.split(F.concat_ws(" ", part(2), part(4)), " "), F.split("text", " ")
    head = F.get(said, F.lit(0))
    firsts = [("f", one(part(1))), ("h", F.when(part(1) != "", F.split(part(3), " ")).otherwise(none)), ("i", one(F.left(part(1), F.lit(1))))]
    heads = [("f", said), ("h", one(head)), ("i", F.when(F.length(head) == 1, one(head)).otherwise(none))]
    given = lambda kind, x, ys: F.concat(*[lines(f"{kind}{k}", x, y) for k, y in ys])
    here, town = F.col("places"), one(F.col("town"))

    def under(rows: DataFrame, side: int, keys: Column, kept: Column) -> DataFrame:
        under_ = rows.select(F.explode(keys).alias("k"), F.lit(side).alias("side"), "ref", "text", kept.alias("places"))
        # Targets that do not differ under the key count once.
        return under_ if side else under_.groupBy("k", "side", "text", "places").agg(F.min("ref").alias("ref")).select("k", "side", "ref", "text", "places")

    def searched(*sides: DataFrame) -> DataFrame:
        rows = reduce(DataFrame.unionByName, sides).repartition("k").sortWithinPartitions("k", "side", F.when(F.col("side") == 0, F.col("ref")), "text", "places")
        return rows.mapInArrow(_best_in_buckets, "rep long, points long, target long")

    best = lambda rows, by: rows.groupBy(by).agg(F.max_by(F.struct("points", "target"), F.struct("points", -F.col("target"))).alias("b")).select(by, "b.points", "b.target")
    near = cut_lineage(best(searched(under(own, 0, lines("t", last, town), here), under(own, 0, given("g", last, firsts), here), under(theirs, 1, lines("t", said, here), here), under(theirs, 1, given("g", said, heads), here)), "rep"))
    rest = theirs.join(near.select(F.col("rep").alias("ref"), "points"), "ref", "left").where("points is null or points <= 7").withColumn("poor", F.expr("points is null or points <= 6"))
    rest = cut_lineage(rest.drop("points"))
    far = searched(under(own, 0, lines("s", last, here), none), under(own, 0, given("w", town, firsts), here), under(rest.where("poor"), 1, lines("s", said, here), none), under(rest, 1, given("w", here, heads), here))
    by_name = names.select("rep", F.explode("all").alias(candidate)).join(best(near.unionByName(far), "rep"), "rep").select(candidate, "points", "target")
    bar = lambda c: F.lower(F.trim(c)).alias("bar")
    licensed = targets.select(target, bar("target_bar")).where("bar <> '' and bar not in ('n/a', 'none')").groupBy("bar").agg(F.min(target).alias("target"))
    by_licence = found.select(candidate, bar("bar_number")).join(licensed, "bar").select(candidate, F.lit(10).cast("long").alias("points"), "target")
    return best(by_name.unionByName(by_licence), candidate).select(candidate, F.col("target").alias(target))


# --- places ----------------------------------------------------------------------------------------------------------
def place_confidence(pairs: DataFrame) -> DataFrame:
    """``pairs`` (place_name, formatted_address; full_name, first_name, last_name, firm_name, line1, city, state_code, state_name) with
    ``confidence`` and ``match_signals``.

    A street line alike to 0.5 gives 0.5; first and last name 0.45; a firm of which 0.6 of the distinctive words and the first one are there 0.45, or
    0.15 beside the name; the last name alone 0.3, if no foreign word stands by or partners are strung together. One of these must hold, else
    the confidence is 0; then town and state give 0.1 each.
    """
    p = _with_names(pairs)
    words = word_tokens(F.col("place_name"))
    common = F.array(*[F.lit(w) for w in [*FIRM_WORDS, *MATCH_PREFIXES, *SUFFIXES]])
    p = p.withColumns({"_words": words, "_told": name_tokens(F.col("place_name")), "_own": F.filter(words, lambda w: ~F.array_contains(common, w)), "_firm": firm_tokens(F.col("firm_name"))})
    p = p.withColumn("_street", F.when(is_street_address(F.col("line1")), address_similarity(F.col("line1"), F.col("formatted_address"))).otherwise(0.0))
    both = (F.col("_first") != "") & (F.col("_last") != "") & F.array_contains("_told", F.col("_first")) & F.array_contains("_told", F.col("_last"))
    shared = F.size(F.array_intersect("_firm", "_own"))
    firm = (F.size("_firm") > 0) & (F.size("_own") > 0) & (shared / F.greatest(F.size("_firm"), F.lit(1)) >= 0.6) & F.array_contains("_own", F.get("_firm", F.lit(0)))
    allowed = F.concat("_all", "_sur", F.coalesce("_firm", F.array().cast("array<string>")), F.array(F.left("_first", F.lit(1))))
    strung = F.col("place_name").contains("&") | F.array_contains("_words", "and")
    alone = (F.length("_last") >= 3) & F.array_contains("_own", F.col("_last")) & ((F.size(F.array_except("_own", allowed)) == 0) | strung)
    sure = lambda c: F.coalesce(c, F.lit(False))
    p = p.withColumns({"_both": sure(both), "_isfirm": sure(firm)}).withColumn("_alone", ~F.col("_both") & sure(alone))
    p = p.withColumns({"_at": F.col("_street") >= 0.5, "_city": contains_phrase(F.col("formatted_address"), F.col("city")), "_state": contains_phrase(F.col("formatted_address"), F.col("state_code")) | contains_phrase(F.col("formatted_address"), F.col("state_name"))})
    part = lambda test, n: F.when(F.col(test), n).otherwise(0.0)
    total = part("_at", 0.5) + part("_both", 0.45) + F.when(F.col("_isfirm"), F.when(F.col("_both"), 0.15).otherwise(0.45)).otherwise(0.0) + part("_alone", 0.3) + part("_city", 0.1) + part("_state", 0.1)
    gate = F.col("_at") | F.col("_both") | F.col("_isfirm") | F.col("_alone")
    named = lambda test, name: F.when(F.col(test), F.lit(name))
    signals = F.array_compact(F.array(F.when(F.col("_at"), F.concat(F.lit("address_match_"), F.round(F.col("_street") * 100).cast("int"))), named("_both", "name_match"), named("_isfirm", "firm_name_match"), named("_alone", "last_name_match"), named("_city", "city_in_address"), named("_state", "state_in_address")))
    confidence = F.when(gate, F.least(F.lit(1.0), F.round(total, 2))).otherwise(0.0)
    return p.select(*pairs.columns, confidence.alias("confidence"), F.when(gate, signals).otherwise(F.array().cast("array<string>")).alias("match_signals"))


def decisions(scored: DataFrame, key: str, threshold: float, lone: float = 0.45) -> DataFrame:
    """(key, decision, best, n) of scored candidates (confidence): found from ``threshold`` on, or from ``lone`` on if it is the only one; else
    candidates, or not_found where none has a confidence."""
    rated = scored.groupBy(key).agg(F.coalesce(F.max("confidence"), F.lit(0.0)).alias("best"), F.count_if(F.col("confidence") > 0).alias("n"))
    decision = F.when(F.col("n") == 0, "not_found").when((F.col("best") >= threshold) | ((F.col("n") == 1) & (F.col("best") >= lone)), "found").otherwise("candidates")
    return rated.select(key, decision.alias("decision"), "best", "n")


# --- signatures and exclusive choice ---------------------------------------------------------------------------------
def signature(name: Column, last: Column, first: Column, city: Column, state: Column) -> Column:
    """struct<name, last, first, city, state> by ``match_key``; without a last name the last word of the name."""
    whole = match_key(name)
    return F.struct(whole.alias("name"), F.coalesce(F.nullif(match_key(last), F.lit("")), last_token(whole)).alias("last"), match_key(first).alias("first"), match_key(city).alias("city"), match_key(state).alias("state"))


def signature_score(a: Column, b: Column, ratio: Column) -> Column:
    """0..1: 1 for the same name, 0.85 for the same last name (0.1 more with the first), else 0.8 times ``ratio``; town and state 0.05 each."""
    same = lambda part: (a[part] != "") & (a[part] == b[part])
    by_name = F.when(same("name"), 1.0).when(same("last"), 0.85 + F.when(same("first"), 0.1).otherwise(0.0)).when((a["name"] != "") & (b["name"] != ""), ratio * 0.8).otherwise(0.0)
    return F.least(F.lit(1.0), by_name + F.when(same("city"), 0.05).otherwise(0.0) + F.when(same("state"), 0.05).otherwise(0.0))


def exclusive_matches(scored: DataFrame, target: str, candidate: str, cut: float, most_rounds: int = 1_000) -> DataFrame:
    """(target, candidate, score): each target in its order takes the best candidate from ``cut`` on that none before it took (ties: smallest).

    Not one after the other: every target asks for its best candidate, each candidate keeps the first target that asks and refuses the
    others, and who was refused asks for the next one, until nobody is refused. Since all candidates prefer the earlier target, this ends
    with the same choice, in as many rounds as the longest chain of refusals; a round is two aggregates and an anti-join.
    """
    pairs = cut_lineage(scored.where(F.col("score") >= cut).groupBy(target, candidate).agg(F.max("score").alias("score")))
    for _ in range(most_rounds):
        asked = pairs.groupBy(target).agg(F.max_by(F.struct(F.col(candidate), F.col("score")), F.struct("score", -F.col(candidate))).alias("c")).select(target, f"c.{candidate}", "c.score")
        first = asked.groupBy(candidate).agg(F.min(target).alias("_first"))
        refused = cut_lineage(asked.join(first, candidate).where(F.col(target) != F.col("_first")).select(target, candidate))
        if refused.isEmpty():
            return asked
        left = cut_lineage(pairs.join(refused, [target, candidate], "left_anti"))
        drop_cut(pairs, refused)
        pairs = left
    raise RuntimeError(f"matches did not settle in {most_rounds} rounds")
