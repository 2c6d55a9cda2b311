"""Variant spellings of names: which profiles mean one lawyer.

Spellings are joined at the level of distinct names: each is cut into k + 1 segments, position-shifted substrings of the others
are looked up in the inverted index of segments, and a banded edit distance, in which a swap of neighbours is one edit,
decides. Profiles then meet under (a piece of evidence, a spelling of the last name), so that neither a common name
nor a common piece of evidence alone brings profiles together, and every pair that meets is verified on the whole typed
names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.llm.addresses import Place, join_parts, parse_place, same_town
from dossier.llm.graph import connected_components
from dossier.llm.names import bare, edits_for, last_names, letter_bits, middle_conflict, plain, within, written, written_match
from dossier.session import cut_lineage, drop_cut

DOCUMENT = (
    "phone string, email string, firm_name string, law_school string, address struct<line1:string, line2:string, city:string, state:string, zip:string>"
)

#: Values that only say that there is no value. Fixed values.
NO_VALUE = [
    "", "n a", "na", "none", "null", "nil", "nan", "unknown", "undefined", "not available", "not applicable", "not provided", "not listed", "not specified", "not given", "not set", "none listed", "none given",
    "none provided", "none on file", "no value", "no data", "no information", "unlisted", "unspecified", "unavailable", "missing", "empty", "blank", "tbd", "tba", "to be determined", "pending", "see website", "ask", "x", "xx", "xxx",
]


def real(value: Column) -> Column:
    """The trimmed value, or null where it only says that there is none."""
    words = F.trim(F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]+", " "))
    return F.when(~words.isin(NO_VALUE), F.trim(value))


def licence_number(bar: Column) -> Column:
    """Letters and digits of a licence number, in upper case; null if none."""
    return F.nullif(F.upper(F.regexp_replace(bar, "[^A-Za-z0-9]", "")), F.lit(""))


#: Rows of one town and last name from which they meet by admission date as well, where they have one.
HOT = 200

#: Bits of the numbers by which rows meet. What meets is verified, so that two things of one number only cost a look: with the 1.3 billion
#: keys of 30 GB these are less than a million pairs. The bits left out are a fifth of what the keys take in a shuffle.
KEY = (1 << 40) - 1

#: What two rows of one lawyer are compared by, in the order of ``same_person``: adm is a day number, email, phone, school and firm are
#: 64-bit hashes that only confirm pairs which met by name, read is the typed name in all its readings.
COMPARED = ["read", "lic", "adm", "email", "phone", "school", "firm", "middle", "number", "street", "town", "state", "zip"]
HASHED = ["email", "phone", "school", "firm"]
PERSON = (
    "id long, full_name string, bar string, read string, lic string, adm int, email long, phone long, school long, firm long, middle string,"
    " number string, street string, town string, state string, zip string, lasts array<string>, doubles array<string>"
)


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()), "boolean": pa.bool_()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


_PERSON = arrow_schema(PERSON)


def _persons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        made: dict[str, list] = {name: [] for name in ("read", "middle", "number", "street", "town", "state", "zip", "lasts", "doubles")}
        for name, middle, line1, line2, a_city, a_state, a_zip, licensed, state, city in zip(*[c[x] for x in ("full_name", "middle", "line1", "line2", "a_city", "a_state", "a_zip", "license_state", "state", "city")]):
            place = parse_place(join_parts(line1, line2, a_city, a_state, a_zip))
            made["read"].append(written(name))
            made["middle"].append(plain(middle) if middle else None)
            made["number"].append(place.number)
            made["street"].append(place.street)
            made["town"].append(place.town or (parse_place(city).town if city else ""))
            made["state"].append(place.state or (licensed or state or "").strip().upper())
            made["zip"].append(place.zip)
            single, double = last_names(name)
            made["lasts"].append(single)
            made["doubles"].append(double)
        yield pa.record_batch([pa.array(made[f.name], f.type) if f.name in made else batch.column(f.name).cast(f.type) for f in _PERSON], schema=_PERSON)


def latest_middle_names(parsed: DataFrame) -> DataFrame:
    """(id, middle): the middle name of the newest parse of each profile (ties: largest parse_id)."""
    newest = F.max_by("middle_name", F.struct("parsed_at", "parse_id"))
    return parsed.where("lawyer_enrichment_id is not null").groupBy(F.col("lawyer_enrichment_id").alias("id")).agg(F.nullif(F.trim(newest), F.lit("")).alias("middle"))


def persons(profiles: DataFrame, parsed: DataFrame) -> DataFrame:
    """One row per profile, its name, licence and contacts in comparable form, and ``copy``. Rows without an id are left out; broken JSON
    counts as no document."""
    m = F.from_json("merged_data", DOCUMENT)
    flat = profiles.where("id is not null").select("id", "full_name", "bar_number", "license_state", "state", "city", F.unix_date("admission_date").alias("adm"), m.alias("m"))
    bar = licence_number(F.col("bar_number"))
    digits = F.regexp_replace(real(F.col("m.phone")), "[^0-9]", "")
    flat = flat.select(
        "id", F.when(F.trim("full_name") != "", F.col("full_name")).alias("full_name"), "license_state", "state", "city", "adm",
        F.concat_ws("|", F.when(bar.isNotNull(), F.upper(F.trim("license_state"))), bar).alias("lic_text"), bar.alias("bar"),
        F.lower(real(F.col("m.email"))).alias("email"),
        F.when(F.length(digits) >= 7, F.right(digits, F.lit(10))).alias("phone"),
        F.lower(real(F.col("m.law_school"))).alias("school"), F.lower(real(F.col("m.firm_name"))).alias("firm"),
        F.col("m.address.line1").alias("line1"), F.col("m.address.line2").alias("line2"), F.col("m.address.city").alias("a_city"), F.col("m.address.state").alias("a_state"), F.col("m.address.zip").alias("a_zip"),
    )
    flat = flat.withColumn("lic", F.when(F.col("lic_text").contains("|"), F.col("lic_text"))).drop("lic_text")
    # Hashed before the join, which shuffles the rows.
    flat = flat.withColumns({c: F.when(F.col(c).isNotNull(), F.xxhash64(c)) for c in HASHED}).join(latest_middle_names(parsed), "id", "left")
    return with_copy(flat.mapInArrow(_persons, PERSON), COMPARED)


# --- spellings -------------------------------------------------------------------------------------------------------
def _cuts(length: int) -> tuple[int, list[tuple[int, int]]]:
    k = edits_for(length)
    return k, [(i * length // (k + 1), (i + 1) * length // (k + 1)) for i in range(k + 1)]


def index_pieces(name: str) -> set[tuple[int, int, str]]:
    """(length, segment number, segment) of a name of three letters or more.

    A swap across a cut would spoil two segments, so the segments of the name with the letters at any of its cuts swapped are in as well:
    of k edits, the swaps across cuts are then undone and each other edit spoils one segment, so one of k + 1 is whole.
    """
    k, cuts = _cuts(len(name))
    found = set()
    for chosen in range(1 << k if k else 0):
        letters = list(name)
        for j in range(k):
            if chosen >> j & 1:
                at = cuts[j][1]
                letters[at - 1], letters[at] = letters[at], letters[at - 1]
        found |= {(len(name), i, "".join(letters[start:end])) for i, (start, end) in enumerate(cuts)}
    return found


def probe_pieces(name: str) -> set[tuple[int, int, str]]:
    """What ``index_pieces`` of any name within its edits can have in common with this one: substrings, shifted as far as the edits allow."""
    found = set()
    for length in range(max(3, len(name) - 2), len(name) + 3):
        k, cuts = _cuts(length)
        longer = len(name) - length
        for i, (start, end) in enumerate(cuts) if abs(longer) <= k else ():
            for shift in range(max(-i, longer - (k - i)), min(i, longer + (k - i)) + 1):
                if start + shift >= 0 and end + shift <= len(name):
                    found.add((length, i, name[start + shift : end + shift]))
    return found


PIECES = "scope string, name string, double boolean, form string, n long, letters long, pieces array<long>"
_PIECES = arrow_schema(PIECES)


def _pieces(of) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for scope, name, double, n in zip(*[c.to_pylist() for c in batch.columns]):
                for form in {name} if scope else {name, bare(name)}:
                    digests = [xxhash.xxh64_intdigest(f"{scope}|{length}|{i}|{piece}") & KEY for length, i, piece in of(form)]
                    rows.append((scope, name, double, form, n, letter_bits(form), digests))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_PIECES), _PIECES)], schema=_PIECES)

    return run


def _same_form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, over = [c.to_pylist() for c in batch.columns[4:]]
        keep = [not o or within(x, y, edits_for(min(len(x), len(y)))) for x, y, o in zip(a, b, over)]
        yield batch.select(["scope", "name", "double", "key"]).filter(pa.array(keep, pa.bool_()))


def spelling_keys(names: DataFrame) -> DataFrame:
    """(scope, name, double, key): each distinct name with itself and every more frequent name of its scope within ``edits_for`` edits; each
    double name with every name that is not double within them.

    ``names(scope, name, double, n)`` has each (scope, name, double) once. Two spellings of one name share a key: one is the other's key, or a
    more frequent spelling near both is. Names of one or two letters meet as they are. Scope "" is that of last names, which also
    meet without their particles.
    """
    names = names.select("scope", "name", "double", "n").where("name <> ''")
    long_ = names.where(F.length("name") > 2)
    # Numbers stand for the segments; the distance is checked anyway, and before the pairs are shuffled again.
    # A form goes along only where it is not the name itself.
    other = F.when(F.col("form") != F.col("name"), F.col("form"))
    index = long_.where("not double").mapInArrow(_pieces(index_pieces), PIECES).select(F.col("scope").alias("of"), F.col("name").alias("key"), other.alias("other_b"), F.col("n").alias("key_n"), F.col("letters").alias("letters_b"), F.explode("pieces").alias("k"))
    asked = long_.mapInArrow(_pieces(probe_pieces), PIECES).select("scope", "name", "double", other.alias("other_a"), "n", F.col("letters").alias("letters_a"), F.explode("pieces").alias("k"))
    a, b = F.coalesce("other_a", "name"), F.coalesce("other_b", "key")
    size = F.least(F.length(a), F.length(b))
    allowed = F.when(size < 3, 0).when(size < 6, 1).otherwise(2)
    apart = F.bit_count(F.col("letters_a").bitwiseXOR(F.col("letters_b")))
    # A swap is two plain edits and leaves the letters as they are, so each edit over ``allowed`` must be one of a swap. One condition, so the
    # distance is taken once a pair, and only where the letters are near enough.
    most = F.greatest(allowed, 2 * allowed - F.ceil(apart / 2))
    close = F.when(apart <= 2 * allowed, F.levenshtein(a, b) <= most).otherwise(False)
    met = asked.join(index, "k").where("of = scope and (double or key_n > n or key_n = n and key > name)").where(close)
    # Pairs that meet by several segments go once, behind this, when they are narrow.
    met = met.select("scope", "name", "double", "key", a.alias("a"), b.alias("b"), (F.levenshtein(a, b) > allowed).alias("over"))
    near = met.mapInArrow(_same_form, "scope string, name string, double boolean, key string")
    # By name, so that the spellings of one lie together in what is written of it.
    return near.unionByName(names.where("not double").select("scope", "name", "double", F.col("name").alias("key"))).repartition("scope", "name", "double").distinct()


def _looked_up() -> Column:
    """array<struct<scope, name, double>>: the last names of a row."""
    of = lambda column, double: F.transform(column, lambda n: F.struct(F.lit("").alias("scope"), n.alias("name"), F.lit(double).alias("double")))
    return F.concat(of("lasts", False), of("doubles", True))


def spellings(*frames: DataFrame) -> DataFrame:
    """``spelling_keys`` of the last names (scope "") and of the towns (scope: their state) of ``frames(lasts, doubles, state, town)``."""
    every = None
    for df in frames:
        one = df.select(F.explode(F.array_compact(F.concat(_looked_up(), F.array(F.expr("if(state <> '' and town <> '', struct(state as scope, town as name, false as double), null)"))))).alias("e")).select("e.*")
        every = one if every is None else every.unionByName(one)
    names = cut_lineage(every.groupBy("scope", "name", "double").agg(F.count("*").alias("n")))
    known = cut_lineage(spelling_keys(names))
    drop_cut(names)
    return known


def by_spelling(rows: DataFrame, known: DataFrame, *keep: str) -> DataFrame:
    """(keep, towns, key): each of ``rows(lasts, doubles, state, town)`` once for each spelling of a last name of its own, with the spellings
    of its town (null without one); spellings as numbers."""
    # There are few spellings a town.
    towns = known.where("scope <> ''").groupBy("scope", "name").agg(F.collect_set("key").alias("key")).select(F.col("scope").alias("state"), F.col("name").alias("town"), F.transform("key", lambda t: number(F.lit("t"), "scope", t)).alias("towns"))
    names = known.where("scope = ''").groupBy("name", "double").agg(F.collect_set(number("key")).alias("keys"))
    # Towns first and spellings as lists, so that rows are only shuffled once each and once a last name, never once a spelling.
    named = rows.join(towns, ["state", "town"], "left").select(*keep, "towns", F.explode(_looked_up()).alias("e")).select(*keep, "towns", "e.name", "e.double")
    return named.join(names, ["name", "double"]).select(*keep, "towns", F.explode("keys").alias("key"))


def under_evidence(spelt: DataFrame, evidence: str, *keep: str) -> DataFrame:
    """(keep, k): ``by_spelling`` rows under each (piece of evidence, spelling), as a number; what it says is verified later.

    ``evidence`` is an array of numbers, to which the spellings of the row's town are added.
    """
    every = F.concat(evidence, F.coalesce("towns", F.array().cast("array<bigint>")))
    return spelt.select(*keep, "key", F.explode(every).alias("e")).select(*keep, number("e", "key").alias("k"))


def number(*columns: Column | str) -> Column:
    """A number of ``KEY`` bits for the columns together."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(KEY))


def evidence_key(kind: str, *columns: str, only: str = "true") -> str:
    """SQL of a number for the columns together, null where one of them is null or empty or ``only`` does not hold."""
    full = " and ".join(f"coalesce(cast({c} as string), '') <> ''" for c in columns)
    return f"if({full} and ({only}), xxhash64('{kind}', {', '.join(columns)}) & {KEY}, null)"


def evidence(*keys: str) -> str:
    return f"array_compact(array({', '.join(keys)}))"


# --- pairs -----------------------------------------------------------------------------------------------------------
def street_close(number_a: str, street_a: str, number_b: str, street_b: str) -> bool:
    return bool(number_a) and number_a == number_b and (street_a == street_b or within(street_a or "", street_b or "", 2))


def same_person(a: tuple, b: tuple) -> bool:
    """Whether two rows (``COMPARED`` values) mean one lawyer. Licences decide where both have one; admission dates never differ.

    What contradicts is looked at before the names, which cost more.
    """
    read_a, lic_a, adm_a, email_a, phone_a, school_a, firm_a, middle_a, number_a, street_a, town_a, state_a, zip_a = a
    read_b, lic_b, adm_b, email_b, phone_b, school_b, firm_b, middle_b, number_b, street_b, town_b, state_b, zip_b = b
    if lic_a and lic_b:
        return lic_a == lic_b
    dated = adm_a is not None and adm_b is not None
    if (dated and adm_a != adm_b) or (state_a and state_b and state_a != state_b):
        return False
    near = same_town(Place("", "", "", "", town_a or "", state_a or "", zip_a or ""), Place("", "", "", "", town_b or "", state_b or "", zip_b or ""))
    town = bool(town_a and town_b) and near
    away = bool(town_a and town_b) and not near
    # An e-mail address made of a name is shared by namesakes, so it counts only where the towns can agree.
    shared = (email_a is not None and email_a == email_b and not away) or (phone_a is not None and phone_a == phone_b) or (near and street_close(number_a, street_a, number_b, street_b))
    if not (shared or town or dated) or middle_conflict(middle_a or "", middle_b or ""):
        return False
    level = written_match(read_a, read_b)
    if not level:
        return False
    if shared or level > 1 and (town or dated) or dated and town:
        return True
    return town and ((school_a is not None and school_a == school_b) or (firm_a is not None and firm_a == firm_b))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = len(COMPARED)
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[2:]]
        keep = [same_person(a, b) for a, b in zip(zip(*columns[:n]), zip(*columns[n:]))]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def with_copy(rows: DataFrame, compared: list[str]) -> DataFrame:
    """``rows`` with ``copy``, a digest of 128 bits that rows have in common if they are equal in ``compared``."""
    return rows.withColumn("copy", F.unhex(F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in compared]))))


def with_representatives(rows: DataFrame, ident: str) -> DataFrame:
    """``rows(copy, ...)`` with ``rep``, the smallest ``ident`` of the rows of one copy.

    Only representatives meet each other, so copies never meet pairwise. Counts are taken before the shuffle; only copies that really
    occur more than once are joined back.
    """
    repeated = cut_lineage(rows.groupBy("copy").agg(F.min(ident).alias("first"), F.count("*").alias("n")).where("n > 1").select("copy", "first"))
    return rows.join(repeated, "copy", "left").withColumn("rep", F.coalesce("first", ident)).drop("copy", "first")


def hot_keys(rows: DataFrame) -> DataFrame:
    """(k, hot): the keys of towns and last names, as ``keyed_by_name`` makes them, that more than ``HOT`` of the rows have as typed."""
    own = rows.where("state <> '' and town <> ''").select("state", "town", F.explode("lasts").alias("name")).select(number(number(F.lit("t"), "state", "town"), number("name")).alias("k"))
    return own.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("k", F.lit(True).alias("hot"))


def met_pairs(keyed: DataFrame, hot: DataFrame) -> DataFrame:
    """(a, b), a < b: the rows of ``keyed(rep, adm, lic, k)`` that share a k and may be one lawyer.

    Rows with two licences or two admission dates are two lawyers, whatever else they share. Under the keys of ``hot(k, hot)``, those with
    a date meet those with the same date only, and those without one meet all.
    """
    dated = F.array(F.struct(number("k", "adm").alias("k"), F.lit(0).alias("role")), F.struct(number("k", F.lit("*")).alias("k"), F.lit(1).alias("role")))
    undated = F.array(F.struct(number("k", F.lit("*")).alias("k"), F.lit(2).alias("role")))
    cold = F.array(F.struct(F.col("k"), F.lit(0).alias("role")))
    # Without hot keys both sides of the join are one exchange.
    spread = keyed.withColumn("role", F.lit(0)) if hot.isEmpty() else keyed.join(hot, "k", "left").select("rep", "adm", "lic", F.explode(F.when(F.col("hot").isNull(), cold).when(F.col("adm").isNull(), undated).otherwise(dated)).alias("e")).select("rep", "adm", "lic", "e.k", "e.role")
    agree = "(x.adm is null or y.adm is null or x.adm = y.adm) and (x.lic is null or y.lic is null)"
    once = "(x.role = y.role and x.role <> 1 and x.rep < y.rep or x.role = 1 and y.role = 2)"
    met = spread.alias("x").join(spread.alias("y"), F.expr(f"x.k = y.k and {once} and {agree}"))
    return met.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


#: What profiles meet by beside the spellings of their towns, which go without any letter of the given name: that may be typed with
#: another first letter or not at all. A row without a state meets by its date alone.
TOGETHER = evidence(evidence_key("a", "adm", "state"), evidence_key("a", "adm", only="state = ''"), evidence_key("p", "phone"), evidence_key("e", "email"), evidence_key("z", "number", "zip"))


def resolve_representatives(one: DataFrame, spelt: DataFrame) -> DataFrame:
    """(rep, lawyer) of the representatives ``one(rep, COMPARED, lasts)`` that are not alone: lawyer is the smallest rep of those that mean the
    same one. ``spelt``: ``by_spelling`` of them with rep, adm, ``licensed`` and ``together`` (``TOGETHER``)."""
    keyed = under_evidence(spelt.withColumn("lic", F.when(F.col("licensed"), 1)), "together", "rep", "adm", "lic")
    side = lambda s: one.select(F.col("rep").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in COMPARED])
    pairs = met_pairs(keyed, cut_lineage(hot_keys(one))).join(side("a"), "a").join(side("b"), "b").where("a_state = b_state or a_state = '' or b_state = ''")
    linked = pairs.select("a", "b", *[f"a_{c}" for c in COMPARED], *[f"b_{c}" for c in COMPARED]).mapInArrow(_verify, "a long, b long")
    first = one.where("lic is not null").groupBy("lic").agg(F.min("rep").alias("a"))
    by_licence = one.select("lic", F.col("rep").alias("b")).join(first, "lic").where("a <> b").select("a", "b")
    return connected_components(linked.unionByName(by_licence)).select(F.col("id").alias("rep"), F.col("component").alias("lawyer"))


def with_evidence(one: DataFrame) -> DataFrame:
    return one.withColumns({"licensed": F.col("lic").isNotNull(), "together": F.expr(TOGETHER)})


def written_once(people: DataFrame) -> DataFrame:
    """``people`` as a table, which the steps behind it read many times; a frame that ``cut_lineage`` gave is one already."""
    return people if getattr(people, "cut_path", None) else cut_lineage(people)


def resolve(people: DataFrame, licences: bool = True) -> DataFrame:
    """(id, lawyer) for each of ``persons``: lawyer is the smallest id of the rows that mean the same one.

    ``licences`` False leaves the licence number out of the evidence (used to measure the rest).
    """
    if not licences:
        people = with_copy(people.withColumn("lic", F.lit(None).cast("string")), COMPARED)
    rows = with_representatives(written_once(people), "id")
    one = rows.where("id = rep")
    found = resolve_representatives(one, by_spelling(with_evidence(one), spellings(one), "rep", "adm", "licensed", "together"))
    return rows.select("id", "rep").join(found, "rep", "left").select("id", F.coalesce("lawyer", "rep").alias("lawyer"))


def linked_pairs(people: DataFrame, lawyers: DataFrame) -> DataFrame:
    """(id_a, id_b): each pair of rows of one lawyer whose typed names are both present and not byte-identical.

    Rows of a lawyer with different licences or admission dates, brought together through a third row, are no pair. The result has as many
    rows as there are pairs, which is what it is asked for.
    """
    rows = people.select("id", "full_name", "lic", "adm").join(lawyers, "id").where("full_name is not null")
    a, b = rows.alias("a"), rows.alias("b")
    differ = "(a.lic is null or b.lic is null or a.lic = b.lic) and (a.adm is null or b.adm is null or a.adm = b.adm)"
    return a.join(b, F.expr(f"a.lawyer = b.lawyer and a.id < b.id and a.full_name <> b.full_name and {differ}")).select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"))
