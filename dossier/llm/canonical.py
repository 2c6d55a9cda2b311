"""Mapping free-entered values to a canonical list: pigeonhole segment join in SQL, verified by the built-in levenshtein.

A reference string of length L is cut into k + 1 segments. If at most k edits turn a typed string into it, one segment
survives them untouched, at a position shifted by no more than the edits before it allow; so an equality join on
(scope, L, segment number, substring) finds every pair within k edits, and nothing is compared with the whole list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dossier.llm.aliases import AREA_ALIASES, AREA_NOISE, STATES, TOWN_WORDS
from dossier.session import cut_lineage

#: Edits allowed: none below 4 letters, 1 below 6, else 2.
MAX_EDITS = 2


def allowed_edits(length: Column) -> Column:
    return F.when(length < 4, 0).when(length < 6, 1).otherwise(MAX_EDITS)


def segments(text: str, k: int = MAX_EDITS) -> Column:
    """array<struct<seg, len, piece>>: the k + 1 segments of a reference string."""
    return F.expr(
        f"transform(sequence(0, {k}), i -> struct(i as seg, length({text}) as len, substring({text}, cast(floor(i * length({text}) / {k + 1}) as int) + 1,"
        f" cast(floor((i + 1) * length({text}) / {k + 1}) as int) - cast(floor(i * length({text}) / {k + 1}) as int)) as piece))"
    )


def probes(text: str, k: int = MAX_EDITS) -> Column:
    """The same struct for every reference length within k and every shift that k edits can cause."""
    at = f"cast(floor(i * l / {k + 1}) as int)"
    size = f"(cast(floor((i + 1) * l / {k + 1}) as int) - {at})"
    shift_low = f"greatest(-i, length({text}) - l - ({k} - i))"
    shift_high = f"least(i, length({text}) - l + ({k} - i))"
    return F.expr(
        f"array_distinct(flatten(flatten(transform(sequence(greatest(1, length({text}) - {k}), length({text}) + {k}), l -> transform(sequence(0, {k}), i ->"
        f" transform(filter(sequence(-{k}, {k}), d -> d >= {shift_low} and d <= {shift_high} and {at} + d >= 0 and {at} + d + {size} <= length({text})),"
        f" d -> struct(i as seg, l as len, substring({text}, {at} + d + 1, {size}) as piece)))))))"
    )


def match_canonical(values: DataFrame, reference: DataFrame) -> DataFrame:
    """The closest entry of each value.

    ``values(scope, norm)`` distinct; ``reference(scope, norm, ref_id)``. Returns ``values`` with ``ref_id``, the entry
    with the fewest edits (ties: smallest id), or 0 where none is within ``allowed_edits``. A null or empty norm gets 0.
    Segments may be empty for reference strings shorter than k + 1; those match by the equal join on the whole string
    that goes first, which also keeps exact values out of the wider join.
    """
    values = values.select("scope", "norm").distinct()
    reference = reference.select("scope", "norm", "ref_id").where(F.length("norm") > 0)
    exact = values.join(reference, ["scope", "norm"]).groupBy("scope", "norm").agg(F.min("ref_id").alias("ref_id"))
    rest = values.join(exact, ["scope", "norm"], "left_anti").where(F.length("norm") >= 3)
    entries = reference.withColumnRenamed("norm", "ref_norm").select("scope", "ref_norm", "ref_id", F.explode(segments("ref_norm")).alias("key"))
    asked = rest.select("scope", "norm", F.explode(probes("norm")).alias("key"))
    flat = lambda df, *keep: df.select("scope", *keep, "key.seg", "key.len", "key.piece").where("piece != ''")
    pairs = flat(asked, "norm").join(flat(entries, "ref_norm", "ref_id"), ["scope", "seg", "len", "piece"]).select("scope", "norm", "ref_norm", "ref_id").distinct()
    edits = F.levenshtein("norm", "ref_norm", MAX_EDITS)
    near = (
        pairs.withColumn("edits", edits)
        .where((F.col("edits") >= 0) & (F.col("edits") <= allowed_edits(F.least(F.length("norm"), F.length("ref_norm")))))
        .groupBy("scope", "norm")
        .agg(F.min(F.struct("edits", "ref_id")).alias("best"))
        .select("scope", "norm", F.col("best.ref_id").alias("ref_id"))
    )
    found = exact.unionByName(near)
    unmatched = values.join(found, ["scope", "norm"], "left_anti").withColumn("ref_id", F.lit(0).cast("long"))
    return found.withColumn("ref_id", F.col("ref_id").cast("long")).unionByName(unmatched)


def squash(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-z0-9]", "")


def area_norm(typed: Column, noise: bool = False) -> Column:
    """The letters of a typed practice area, without bullets, remarks, "lawyer" and the like; "b, a" reads "a b".

    With ``noise`` the last word stays, as in "accident lawyer", of which it is a part.
    """
    text = F.translate(F.lower(typed), "_-*áéíóúñü", "   aeiounu")
    text = F.regexp_replace(text, r"\((all types|any)\)|& more\s*$|\.", " ")
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    if not noise:
        text = F.regexp_replace(text, rf" ({'|'.join(AREA_NOISE)})$", "")
    return squash(F.regexp_replace(text, r"^([^,]+),([^,]+)$", "$2 $1"))


def town_norm(typed: Column) -> Column:
    """The letters of a typed town: no state behind it, no "City of", short forms written out."""
    names = "|".join(sorted(name.lower() for name in STATES.values()))
    codes = "|".join(code.lower() for code in STATES)
    text = F.trim(F.regexp_replace(F.lower(typed), r"\s+", " "))
    text = F.regexp_replace(text, rf"\s*,\s*({codes}|{names})\.?(\s+\d{{5}}(-\d{{4}})?)?$", "")
    text = F.regexp_replace(text, r"^(the )?(city|town|village) of ", "")
    words = F.split(F.trim(F.regexp_replace(text, r"[^a-z0-9]+", " ")), " ")
    table = F.create_map(*[F.lit(x) for pair in TOWN_WORDS.items() for x in pair])
    return F.array_join(F.transform(words, lambda w: F.coalesce(table[w], w)), "")


def state_code(typed: Column) -> Column:
    """Two-letter code of a state given by code or name; null otherwise."""
    text = F.upper(F.trim(F.regexp_replace(typed, r"[.\s]+", " ")))
    table = F.create_map(*[F.lit(x) for code, name in STATES.items() for x in (name.upper(), code)] + [F.lit(x) for code in STATES for x in (code, code)])
    return table[text]


PROFILE = "practice_areas array<string>, address struct<line1:string, line2:string, city:string, state:string, zip:string>, _broken string"


def typed_values(discovery: DataFrame, profiles: DataFrame) -> DataFrame:
    """(place_typed, row_id, typed_value, scope, norm): each distinct non-blank value of a row.

    Texts that are no JSON offer nothing. A town's scope is the state of its address, or that typed behind the town; a
    town with neither is looked for in all states (scope "*").
    """
    value = lambda kind, typed, state: F.struct(F.lit(kind).alias("place_typed"), typed.alias("typed_value"), state.alias("state"))
    none = F.lit(None).cast("string")
    searched = discovery.select(F.col("discovery_id").alias("row_id"), value("searched", F.col("practice_area_searched"), none).alias("v"))
    # The parser may still give the first keys of a text that is cut off, but it marks that text as broken.
    document = profiles.select(F.col("id").alias("row_id"), F.from_json("merged_data", PROFILE, {"columnNameOfCorruptRecord": "_broken"}).alias("m")).where("m._broken is null")
    areas = F.transform(F.coalesce(F.array_distinct("m.practice_areas"), F.array().cast("array<string>")), lambda x: value("areas", x, none))
    documents = document.select("row_id", F.explode(F.concat(areas, F.array(value("city", F.col("m.address.city"), F.col("m.address.state"))))).alias("v"))
    every = searched.unionByName(documents).select("row_id", "v.*").where(F.regexp_replace("typed_value", r"\s+", "") != "")
    behind = F.nullif(F.regexp_extract("typed_value", r",\s*([A-Za-z][A-Za-z .]+?)\s*$", 1), F.lit(""))
    town = F.col("place_typed") == "city"
    scope = F.when(town, F.coalesce(state_code(F.col("state")), state_code(behind), F.lit("*"))).otherwise("area")
    norm = F.when(town, town_norm(F.col("typed_value"))).otherwise(area_norm(F.col("typed_value")))
    return every.select("place_typed", "row_id", "typed_value", scope.alias("scope"), norm.alias("norm"))


def reference_entries(areas: DataFrame, cities: DataFrame) -> DataFrame:
    """(scope, norm, ref_id) of both lists: area names with their other wordings, and towns by state.

    Towns whose name occurs in one state only can also be found without a state (scope "*").
    """
    names = areas.select(F.col("area_name").alias("name"), F.col("area_id").alias("ref_id"))
    rows = [(name, wording.strip()) for name, wordings in AREA_ALIASES.items() for wording in wordings.split(";")]
    aliases = areas.sparkSession.createDataFrame(rows, T.StructType([T.StructField("area_name", T.StringType()), T.StructField("name", T.StringType())]))
    aliases = aliases.join(areas.select("area_name", F.col("area_id").alias("ref_id")), "area_name").select("name", "ref_id")
    forms = F.explode(F.array(area_norm(F.col("name")), area_norm(F.col("name"), noise=True)))
    named = names.unionByName(aliases).select(F.lit("area").alias("scope"), forms.alias("norm"), "ref_id")
    short = F.regexp_replace(town_norm(F.col("city_name")), "^(saint|south)(?=.)", "s")  # "S. Elmo" may mean either
    towns = cities.select(F.upper(F.trim("state_code")).alias("scope"), F.explode(F.array_distinct(F.array(town_norm(F.col("city_name")), short))).alias("norm"), F.col("city_id").alias("ref_id"))
    anywhere = towns.groupBy("norm").agg(F.min("ref_id").alias("ref_id"), F.count("*").alias("n")).where("n = 1").select(F.lit("*").alias("scope"), "norm", "ref_id")
    return named.unionByName(towns).unionByName(anywhere).distinct()


def map_typed_values(discovery: DataFrame, profiles: DataFrame, areas: DataFrame, cities: DataFrame) -> DataFrame:
    """(place_typed, row_id, typed_value, ref_id) of each typed value that is not byte-identical to a name of its list.

    ref_id is 0 where no entry fits. Values are matched once each, however many rows have them; the rows join the
    result by (scope, norm). Both lists are fixed tables.
    """
    typed = typed_values(discovery, profiles)
    listed = areas.select(F.lit(False).alias("town"), F.col("area_name").alias("typed_value")).unionByName(cities.select(F.lit(True).alias("town"), F.col("city_name").alias("typed_value"))).distinct()
    # Written once: both tables are read once, and each distinct value is matched once.
    open_ = cut_lineage(typed.withColumn("town", F.col("place_typed") == "city").join(listed, ["town", "typed_value"], "left_anti").drop("town"))
    distinct = cut_lineage(open_.select("scope", "norm").distinct())
    matched = match_canonical(distinct, reference_entries(areas, cities))
    return open_.join(matched, ["scope", "norm"], "left").select("place_typed", "row_id", "typed_value", F.coalesce("ref_id", F.lit(0).cast("long")).alias("ref_id"))
