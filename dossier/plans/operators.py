"""Queries that show the column functions and the operators on the directory tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.functions import addresses, names, text, values
from dossier.operators import dedupe, extract, match, merge, rank, score
from dossier.session import prepare, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its own name, with its SQL."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


# Pieces of DuckDB SQL that several oracles share.
def _sq(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


_BAR = _sq(f"regexp_replace({_sq('coalesce(bar_number, chr(39) || chr(39))').replace('chr(39) || chr(39)', chr(39) * 2)}, '^#', '')")
_UPPER = ", ".join(f"'{w}'" for w in text.ALWAYS_UPPER)
_CAP = lambda w: f"upper(substr({w}, 1, 1)) || lower(substr({w}, 2))"
_SIMPLE = lambda w: (
    f"CASE WHEN upper({w}) IN ({_UPPER}) THEN upper({w}) WHEN regexp_matches({w}, '(?i)^\\d+(st|nd|rd|th)$') THEN lower({w})"
    f" WHEN contains({w}, '''') THEN {_CAP(f'''split_part({w}, '{chr(39) * 2}', 1)''')} || '''' || {_CAP(f'''substr({w}, strpos({w}, '{chr(39) * 2}') + 1)''')}"
    f" WHEN regexp_matches({w}, '(?i)^mc[a-z].') THEN {_CAP(f'substr({w}, 1, 2)')} || {_CAP(f'substr({w}, 3)')}"
    f" WHEN regexp_matches({w}, '(?i)^mac[a-z].') THEN {_CAP(f'substr({w}, 1, 3)')} || {_CAP(f'substr({w}, 4)')} ELSE {_CAP(w)} END"
)
_TITLE = lambda x: (
    f"CASE WHEN {x} IS NULL OR {_sq(x)} = '' THEN {x} ELSE array_to_string(list_transform(string_split({_sq(x)}, ' '), lambda w: CASE WHEN upper(w) IN ({_UPPER}) THEN upper(w)"
    f" WHEN regexp_matches(w, '(?i)^\\d+(st|nd|rd|th)$') THEN lower(w) ELSE array_to_string(list_transform(string_split(w, '-'), lambda p: {_SIMPLE('p')}), '-') END), ' ') END"
)


# --- scalar functions ------------------------------------------------------------------------------------------------
@query(f"SELECT id, lower({_BAR}) AS bar_key, nullif({_BAR}, '') AS stored_bar, sha256(trim(lower({_BAR}) || ' ' || lower(trim(coalesce(license_state, ''))))) AS fingerprint FROM lawyer_enrichment")
def licence_keys(spark, d):
    bar, state = F.col("bar_number"), F.col("license_state")
    return table(spark, d, "lawyer_enrichment").select("id", values.bar_key(bar).alias("bar_key"), values.stored_bar(bar).alias("stored_bar"), values.profile_fingerprint(bar, state).alias("fingerprint"))


@query("SELECT discovery_id, sha256(lower(trim(coalesce(name, ''))) || '|' || lower(trim(coalesce(city, ''))) || '|' || lower(trim(coalesce(state, '')))) AS fingerprint FROM google_discovery")
def place_keys(spark, d):
    return table(spark, d, "google_discovery").select("discovery_id", values.place_fingerprint(F.col("name"), F.col("city"), F.col("state")).alias("fingerprint"))


_OR_BLANK = lambda x, made: f"CASE WHEN {x} IS NULL OR {_sq(x)} = '' THEN {x} ELSE {made} END"
_CITY = lambda x: _OR_BLANK(x, f"array_to_string(list_transform(string_split({_sq(x)}, ' '), lambda w: {_CAP('w')}), ' ')")
_STEM = "regexp_replace(w, '[,.]+$', '')"
_FIRM_TITLE = lambda x: _OR_BLANK(x, f"array_to_string(list_transform(string_split({_sq(x)}, ' '), lambda w: CASE WHEN upper({_STEM}) IN ({_UPPER}) THEN upper({_STEM}) ELSE {_CAP(_STEM)} END || regexp_extract(w, '([,.]*)$', 1)), ' ')")


@query(f"SELECT id, {_TITLE('upper(full_name)')} AS name, {_CITY('upper(city)')} AS city, {_FIRM_TITLE('upper(firm_name)')} AS firm FROM lawyer_enrichment")
def title_cases(spark, d):
    up = lambda c: F.upper(F.col(c))
    return table(spark, d, "lawyer_enrichment").select("id", text.title_name(up("full_name")).alias("name"), text.title_city(up("city")).alias("city"), text.title_firm(up("firm_name")).alias("firm"))


_PARSE = rf"""
WITH a AS (SELECT id, {_sq('full_name')} AS t FROM lawyer_enrichment WHERE {_sq('full_name')} <> ''),
b AS (SELECT id, t, trim(regexp_extract(t, '^([^,]*),', 1)) AS before, trim(regexp_extract(t, '^[^,]*,(.*)$', 1)) AS after FROM a),
c AS (SELECT id, CASE WHEN contains(t, ',') AND NOT regexp_matches(after, '\d') AND NOT list_has_any(string_split(lower(after), ' '), ['suite','ste','floor','fl','apt','blvd','ave','st','rd','dr','#']) THEN after || ' ' || before ELSE t END AS t FROM b),
e AS (SELECT id, regexp_replace(t, '(?i)^(?:mr|mrs|ms|dr|prof|hon|judge)\.?\s+', '') AS t FROM c),
f AS (SELECT id, t, regexp_replace(regexp_extract(t, '(?i)\s+((?:{'|'.join(names.SUFFIXES)})\.?)\s*$', 1), '\.+$', '') AS suffix, trim(regexp_replace(t, '(?i)\s+((?:{'|'.join(names.SUFFIXES)})\.?)\s*$', '')) AS rest FROM e),
g AS (SELECT id, suffix, rest, list_filter(string_split(rest, ' '), lambda w: w <> '') AS p FROM f)
SELECT id, CASE WHEN len(p) >= 2 THEN p[1] ELSE rest END AS first_name, CASE WHEN len(p) > 2 THEN array_to_string(p[2:len(p) - 1], ' ') END AS middle_name, CASE WHEN len(p) >= 2 THEN p[len(p)] END AS last_name, nullif(suffix, '') AS suffix FROM g"""


@query(_PARSE)
def name_parts(spark, d):
    rows = table(spark, d, "lawyer_enrichment").select("id", names.parse_name(text.squeeze(F.col("full_name"))).alias("p")).where("p is not null")
    return rows.select("id", "p.first_name", "p.middle_name", "p.last_name", "p.suffix")


@query(r"""
SELECT scrape_id,
 CASE WHEN trim(formatted_phone) = '' OR formatted_phone IS NULL THEN NULL
      WHEN regexp_full_match(regexp_replace(formatted_phone, '[^0-9+]', '', 'g'), '[0-9]{10}') THEN '+1' || regexp_replace(formatted_phone, '[^0-9+]', '', 'g')
      WHEN regexp_full_match(regexp_replace(formatted_phone, '[^0-9+]', '', 'g'), '\+1.{10}') THEN regexp_replace(formatted_phone, '[^0-9+]', '', 'g')
      WHEN regexp_full_match(regexp_replace(formatted_phone, '[^0-9+]', '', 'g'), '1.{10}') THEN '+' || regexp_replace(formatted_phone, '[^0-9+]', '', 'g')
      ELSE trim(regexp_replace(formatted_phone, '\s+', ' ', 'g')) END AS phone,
 CASE length(regexp_replace(formatted_phone, '[^0-9]', '', 'g')) WHEN 10 THEN '+1' || regexp_replace(formatted_phone, '[^0-9]', '', 'g')
      WHEN 11 THEN CASE WHEN regexp_replace(formatted_phone, '[^0-9]', '', 'g') LIKE '1%' THEN '+' || regexp_replace(formatted_phone, '[^0-9]', '', 'g') END END AS strict
FROM google_places""")
def phones(spark, d):
    phone = F.col("formatted_phone")
    return table(spark, d, "google_places").select("scrape_id", values.normalize_phone(phone).alias("phone"), values.strict_phone(phone).alias("strict"))


_TAIL = r"(?i),\s*([A-Za-z][A-Za-z\s]*?),?\s+([A-Za-z]{2})(?:\s+(\d{5}(?:-\d{4})?))?$"
_SHORT = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in addresses.STREET_SHORT.items())


@query(rf"""
WITH a AS (SELECT scrape_id, regexp_replace({_sq("regexp_replace(formatted_address, ', (USA|United States)$', '')")}, ',\s*', ', ', 'g') AS t FROM google_places WHERE trim(formatted_address) <> ''),
b AS (SELECT scrape_id, t, list_filter(list_transform(string_split(regexp_replace(t, '{_TAIL}', ''), ','), lambda x: trim(x)), lambda x: x <> '') AS l FROM a)
SELECT scrape_id, CASE WHEN len(l) > 0 THEN array_to_string(list_transform(string_split(l[1], ' '), lambda w: CASE lower(w) {_SHORT} ELSE w END), ' ') END AS line1, l[2] AS line2,
 nullif(array_to_string(list_transform(string_split(trim(regexp_extract(t, '{_TAIL}', 1)), ' '), lambda w: {_CAP('w')}), ' '), '') AS city, nullif(upper(regexp_extract(t, '{_TAIL}', 2)), '') AS state, nullif(regexp_extract(t, '{_TAIL}', 3), '') AS zip FROM b""")
def address_parts(spark, d):
    written = F.regexp_replace("formatted_address", ", (USA|United States)$", "")
    rows = table(spark, d, "google_places").where("trim(formatted_address) <> ''").select("scrape_id", addresses.parse_address(written).alias("a"))
    return rows.select("scrape_id", F.col("a.address_line1").alias("line1"), F.col("a.address_line2").alias("line2"), "a.city", "a.state", "a.zip")


@query("""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE 'soon' END AS written, o_orderdate FROM orders)
SELECT o_orderkey, written, CASE o_orderkey % 4 WHEN 0 THEN CAST(date_trunc('year', o_orderdate) AS date) WHEN 1 THEN CAST(date_trunc('month', o_orderdate) AS date) WHEN 2 THEN CAST(o_orderdate AS date) END AS coerced FROM t""")
def dates_written(spark, d):
    k = F.col("o_orderkey") % 4
    written = F.when(k == 0, F.date_format("o_orderdate", "yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyy-MM")).when(k == 2, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise("soon")
    return table(spark, d, "orders").select("o_orderkey", written.alias("written")).withColumn("coerced", values.coerce_date(F.col("written")))


_LOW = "lower(trim(coalesce(name, '')))"
_FIRM = f"""({_LOW} = '' OR {' OR '.join(f"{_LOW} LIKE '%{s}'" for s in names.ENTITY_SUFFIXES)} OR {' OR '.join(f"contains({_LOW}, '{p}')" for p in names.FIRM_PHRASES)}
 OR (contains({_LOW}, '&') AND (contains({_LOW}, ',') OR len(regexp_extract_all({_LOW}, '\\b[a-z]{{3,}}\\b')) >= 3)))"""


@query(f"SELECT is_firm, count(*) AS n, count(DISTINCT name) AS names FROM (SELECT name, {_FIRM} AS is_firm FROM google_discovery) GROUP BY is_firm")
def firms_and_people(spark, d):
    return table(spark, d, "google_discovery").groupBy(names.is_firm(F.col("name")).alias("is_firm")).agg(F.count("*").alias("n"), F.count_distinct("name").alias("names"))


_POP = "least(100.0, greatest(0.0, (coalesce(google_rating, 0.0) * 20.0 + least(coalesce(google_review_count, 0) * CAST(0.3 AS double), 40.0)) / 140.0 * 100.0))"


@query(f"SELECT discovery_id, CAST({_POP} AS double) AS popularity FROM google_discovery WHERE coalesce(google_rating, 0) >= 3.5 AND coalesce(google_review_count, 0) >= 5 AND {_POP} >= 40")
def popular_hits(spark, d):
    rows = table(spark, d, "google_discovery").withColumn("popularity", values.popularity(F.col("google_rating"), F.col("google_review_count")))
    return rows.where("coalesce(google_rating, 0) >= 3.5 and coalesce(google_review_count, 0) >= 5 and popularity >= 40").select("discovery_id", "popularity")


@query("SELECT area, count(*) AS n, count(DISTINCT id) AS profiles FROM (SELECT id, unnest(from_json(json_extract(merged_data, '$.practice_areas'), '[\"VARCHAR\"]')) AS area FROM lawyer_enrichment WHERE json_valid(merged_data)) GROUP BY area")
def areas_named(spark, d):
    rows = table(spark, d, "lawyer_enrichment").where(F.expr("try_parse_json(merged_data) is not null"))
    exploded = rows.select("id", F.explode(F.from_json(F.get_json_object("merged_data", "$.practice_areas"), "array<string>")).alias("area"))
    return exploded.groupBy("area").agg(F.count("*").alias("n"), F.count_distinct("id").alias("profiles"))


@query("SELECT layer, count(*) AS profiles, avg(CAST(completeness_score AS double)) AS avg_score FROM (SELECT unnest(enrichment_layers) AS layer, completeness_score FROM lawyer_enrichment) GROUP BY layer")
def layer_completion(spark, d):
    rows = table(spark, d, "lawyer_enrichment").select(F.explode("enrichment_layers").alias("layer"), "completeness_score")
    return rows.groupBy("layer").agg(F.count("*").alias("profiles"), F.avg(F.col("completeness_score").cast("double")).alias("avg_score"))


@query("SELECT source, count(*) AS payloads, min(length(source)) AS letters FROM (SELECT unnest(json_keys(raw_data_by_source)) AS source FROM lawyer_enrichment WHERE json_valid(raw_data_by_source)) GROUP BY source")
def payload_sources(spark, d):
    rows = table(spark, d, "lawyer_enrichment").select(F.explode(F.json_object_keys("raw_data_by_source")).alias("source"))
    return rows.groupBy("source").agg(F.count("*").alias("payloads"), F.min(F.length("source")).cast("bigint").alias("letters"))


# --- duplicates ------------------------------------------------------------------------------------------------------
_BARKEY = f"nullif(lower({_BAR}), '')"


@query(f"""
WITH k AS (SELECT id, {_BARKEY} AS bar, coalesce(lower(trim(license_state)), '') AS st, coalesce(completeness_score, 0) AS s FROM lawyer_enrichment)
SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY bar, st ORDER BY s DESC, id) AS rn FROM k WHERE bar IS NOT NULL) WHERE rn = 1 UNION ALL SELECT id FROM k WHERE bar IS NULL""")
def dedupe_best_score(spark, d):
    return dedupe.dedupe_by_licence(table(spark, d, "lawyer_enrichment").select("id", "bar_number", "license_state", "completeness_score")).select("id")


@query("SELECT bar_number, license_state, id FROM (SELECT *, row_number() OVER (PARTITION BY bar_number, license_state ORDER BY enrichment_level DESC NULLS LAST, completeness_score DESC NULLS LAST, updated_at DESC NULLS LAST, id) AS rn FROM lawyer_enrichment WHERE bar_number IS NOT NULL AND license_state IS NOT NULL) WHERE rn = 1 UNION ALL SELECT bar_number, license_state, id FROM lawyer_enrichment WHERE bar_number IS NULL OR license_state IS NULL")
def best_profile_per_licence(spark, d):
    rows = table(spark, d, "lawyer_enrichment").select("id", "bar_number", "license_state", "enrichment_level", "completeness_score", "updated_at")
    order = F.struct("enrichment_level", "completeness_score", "updated_at", -F.col("id"))
    return dedupe.best_per_key(rows, ["bar_number", "license_state"], order).select("bar_number", "license_state", "id")


@query("SELECT google_place_id, count(*) AS n FROM google_discovery WHERE google_place_id IS NOT NULL GROUP BY google_place_id HAVING count(*) > 1")
def repeated_places(spark, d):
    return dedupe.duplicate_groups(table(spark, d, "google_discovery"), ["google_place_id"])


_PERSON = f"""p AS (SELECT id, coalesce(completeness_score, 0) AS s, len(enrichment_layers) AS n, lower({_sq('first_name')}) AS f, lower({_sq('last_name')}) AS l, lower({_sq('state')}) AS st, lower({_sq('city')}) AS c FROM lawyer_enrichment),
w AS (SELECT f, l, st, c, id, first_value(id) OVER (PARTITION BY f, l, st, c ORDER BY s DESC, n DESC, id) AS winner FROM p WHERE f IS NOT NULL AND l IS NOT NULL AND st IS NOT NULL AND c IS NOT NULL)"""


def _moves(spark, d) -> DataFrame:
    low = lambda c: F.lower(text.squeeze(F.col(c)))
    rows = table(spark, d, "lawyer_enrichment").select("id", "completeness_score", F.size("enrichment_layers").alias("n"), low("first_name").alias("f"), low("last_name").alias("l"), low("state").alias("st"), low("city").alias("c"))
    return dedupe.survivors(rows, ["f", "l", "st", "c"], F.struct(F.coalesce("completeness_score", F.lit(0).cast("smallint")), "n", -F.col("id")))


@query(f"WITH {_PERSON} SELECT winner, id AS loser FROM w WHERE id <> winner")
def person_survivors(spark, d):
    return _moves(spark, d).select("winner", "loser")


@query(f"""
WITH {_PERSON}, m AS (SELECT winner, id AS loser FROM w WHERE id <> winner),
ch AS (SELECT lawyer_enrichment_id AS pid, last_name, parse_id, winner FROM (SELECT lawyer_enrichment_id, last_name, min(parse_id) AS parse_id FROM parsed_name WHERE last_name IS NOT NULL GROUP BY ALL) LEFT JOIN m ON m.loser = lawyer_enrichment_id),
own AS (SELECT DISTINCT pid, last_name FROM ch WHERE winner IS NULL)
SELECT pid AS profile_id, last_name, parse_id FROM ch WHERE winner IS NULL
UNION ALL SELECT winner, last_name, max(parse_id) FROM ch WHERE winner IS NOT NULL AND NOT EXISTS (SELECT 1 FROM own WHERE own.pid = ch.winner AND own.last_name = ch.last_name) GROUP BY winner, last_name""")
def children_repointed(spark, d):
    children = table(spark, d, "parsed_name").where("last_name is not null").groupBy(F.col("lawyer_enrichment_id").alias("profile_id"), "last_name").agg(F.min("parse_id").alias("parse_id"))
    return dedupe.repoint_children(children, _moves(spark, d), "profile_id", "last_name").select("profile_id", "last_name", "parse_id")


# --- ranking ---------------------------------------------------------------------------------------------------------
_QUOTAS = [("CA", 15), ("NY", 10), ("TX", 10), ("FL", 5), ("WI", 0)]


@query(f"""
SELECT state, place, popularity, CAST(rn AS bigint) AS rank FROM (
 SELECT *, row_number() OVER (PARTITION BY state ORDER BY popularity DESC, place) AS rn FROM (
  SELECT upper(trim(state)) AS state, google_place_id AS place, max(CAST({_POP} AS double)) AS popularity FROM google_discovery WHERE trim(state) <> '' GROUP BY ALL))
 JOIN (VALUES {', '.join(f"('{s}', {n})" for s, n in _QUOTAS)}) q(qs, quota) ON qs = state WHERE rn <= quota""")
def ranked_with_quota(spark, d):
    hits = table(spark, d, "google_discovery").where("trim(state) <> ''")
    best = hits.groupBy(F.upper(F.trim("state")).alias("state"), F.col("google_place_id").alias("place")).agg(F.max(values.popularity(F.col("google_rating"), F.col("google_review_count"))).alias("popularity"))
    quotas = spark.createDataFrame(_QUOTAS, "state string, quota int")
    return rank.rank_with_quota(best, "state", [F.col("popularity").desc(), F.col("place")], quotas).withColumn("rank", F.col("rank").cast("bigint"))


@query("""
SELECT source_key, day, finds FROM (SELECT *, coalesce(sum(finds) OVER (PARTITION BY source_key ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent
 FROM (SELECT source_key, CAST(found_at AS date) AS day, count(*) AS finds FROM discovery_candidate GROUP BY ALL)) WHERE spent < 100""")
def budgeted_days(spark, d):
    days = table(spark, d, "discovery_candidate").groupBy("source_key", F.to_date("found_at").alias("day")).agg(F.count("*").alias("finds"))
    return rank.stop_after(days, ["source_key"], [F.col("day")], F.col("finds"), 100)


@query("SELECT user_id, list(event_type ORDER BY first_at) AS \"values\" FROM (SELECT user_id, event_type, min(event_id) AS first_at FROM events WHERE event_type IS NOT NULL GROUP BY ALL) GROUP BY user_id")
def event_kinds_in_order(spark, d):
    return rank.ordered_distinct(table(spark, d, "events").select("user_id", "event_type", "event_id"), ["user_id"], "event_type", "event_id")


# --- scores ----------------------------------------------------------------------------------------------------------
_FIELDS = ["full_name", "bar_number", "license_state", "license_status", "admission_date", "firm_name", "bio", "photo_url", "city", "state"]
_JSON = ["phone", "email", "website_url", "law_school"]
_INNER = "phone string, email string, website_url string, law_school string, practice_areas array<string>, address struct<line1:string, city:string, state:string, zip:string>"
_DOC = f"""s AS (SELECT id, {', '.join(_FIELDS)}, {', '.join(f"json_extract_string(m, '$.{f}') AS {f}" for f in _JSON)}, coalesce(json_array_length(m, '$.practice_areas'), 0) AS areas,
 coalesce(json_extract_string(m, '$.address.line1'), '') AS line1, coalesce(json_extract_string(m, '$.address.city'), '') AS acity, coalesce(json_extract_string(m, '$.address.zip'), '') AS zip
 FROM (SELECT *, CASE WHEN json_valid(merged_data) THEN json(merged_data) END AS m FROM lawyer_enrichment))"""


def _scored(spark, d) -> tuple[DataFrame, dict]:
    # A null or broken document counts as an empty one.
    document = F.when(F.try_parse_json("merged_data").isNotNull(), F.col("merged_data"))
    rows = table(spark, d, "lawyer_enrichment").select("id", *_FIELDS, F.from_json(document, _INNER).alias("m"))
    return rows, {f: F.col(f) for f in _FIELDS} | {f: F.col(f"m.{f}") for f in _JSON}


_HAS_ADDRESS = "(acity <> '' OR zip <> '' OR line1 <> '' OR coalesce(city NOT IN ('', 'None'), false) OR coalesce(state NOT IN ('', 'None'), false))"
_RT = lambda f: f"coalesce(CAST({f} AS varchar) NOT IN ('', 'None'), false)"
_TIER = " + ".join(f"CASE WHEN {_HAS_ADDRESS if f == 'address' else 'areas > 0' if f == 'practice_areas' else _RT(f)} THEN {n} ELSE 0 END" for f, (_, n) in score.TIER_POINTS.items())
_RECORD = " + ".join(f"CASE WHEN coalesce(CAST({f} AS varchar) <> '', false) THEN {n} ELSE 0 END" for f, n in score.RECORD_POINTS.items())


def _address(c: DataFrame | None = None):
    has = lambda x: F.coalesce(F.col(x) != "", F.lit(False))
    return has("m.address.city") | has("m.address.zip") | has("m.address.line1") | score.real_text(F.col("city")) | score.real_text(F.col("state"))


@query(f"""
WITH {_DOC}
SELECT id, CAST({_TIER} AS integer) AS tier_score,
 CAST(least(100, {_RECORD} + least(12, CASE WHEN areas <= 2 THEN areas * 4 WHEN areas <= 5 THEN areas * 3 ELSE areas * 2 END) + CASE WHEN length(full_name) > 2 THEN 10 ELSE 0 END + CASE WHEN length(bio) > 20 THEN 10 ELSE 0 END + CASE WHEN line1 <> '' THEN 16 ELSE 0 END) AS integer) AS record_score FROM s""")
def completeness_scores(spark, d):
    rows, fields = _scored(spark, d)
    areas = F.col("m.practice_areas")
    tests = score.tier_tests(fields, areas, _address())
    return rows.select("id", score.tier_score(tests).alias("tier_score"), score.record_score(fields, areas, F.col("m.address.line1") != "").alias("record_score"))


@query(f"""
WITH {_DOC}, b AS (SELECT id, unnest([{', '.join(f"struct_pack(field := '{f}', tier := '{t}', weight := {n}, present := {_HAS_ADDRESS if f == 'address' else 'areas > 0' if f == 'practice_areas' else _RT(f)})" for f, (t, n) in score.TIER_POINTS.items())}]) AS x FROM s)
SELECT x.field AS field, x.tier AS tier, x.weight AS weight, count(*) FILTER (WHERE x.present) AS present, count(*) AS profiles FROM b GROUP BY ALL""")
def score_breakdown(spark, d):
    rows, fields = _scored(spark, d)
    tests = score.tier_tests(fields, F.col("m.practice_areas"), _address())
    parts = rows.select(F.explode(score.tier_breakdown(tests)).alias("x"))
    return parts.groupBy("x.field", "x.tier", "x.weight").agg(F.count_if("x.present").alias("present"), F.count("*").alias("profiles"))


_WSQL = lambda f: {"address_line1": "line1 <> ''", "zip": "zip <> ''", "practice_areas": "areas > 0"}.get(f, f"coalesce(trim({f}) <> '', false)")


@query(f"WITH {_DOC} SELECT id, CAST(floor(({' + '.join(f'CASE WHEN {_WSQL(f)} THEN {n} ELSE 0 END' for f, n in score.WEIGHTS.items())}) * 100 / {sum(score.WEIGHTS.values())}) AS integer) AS weighted FROM s")
def weighted_scores(spark, d):
    rows, fields = _scored(spark, d)
    full = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    present = {f: full(fields[f]) for f in score.WEIGHTS if f in fields} | {"address_line1": full(F.col("m.address.line1")), "zip": full(F.col("m.address.zip")), "practice_areas": F.coalesce(F.size("m.practice_areas") > 0, F.lit(False))}
    return rows.select("id", score.weighted_score(present).alias("weighted"))


# --- merges ----------------------------------------------------------------------------------------------------------
_ALIAS = {"state_bar": "state_bars", "counselpages": "justia", "lawdex": "google_places"}


def _claims(spark, d) -> DataFrame:
    schema = "map<string, struct<layer:int, data:map<string,string>>>"
    rows = table(spark, d, "lawyer_enrichment").select(F.col("id").cast("string").alias("key"), "manually_curated_fields", F.posexplode(F.map_entries(F.from_json("raw_data_by_source", schema))).alias("pos", "e"))
    fields = rows.select("key", "pos", "manually_curated_fields", F.col("e.key").alias("source"), F.col("e.value.layer").alias("layer"), F.explode("e.value.data").alias("field", "value"))
    renamed = F.coalesce(F.create_map(*[F.lit(x) for p in _ALIAS.items() for x in p])[F.col("source")], F.col("source"))
    return fields.select("key", "field", "value", renamed.alias("source"), "layer", "pos", F.col("manually_curated_fields").alias("locked"))


_CLAIMS = """c AS (SELECT CAST(id AS varchar) AS key, source, pos, unnest(json_keys(p, '$.data')) AS field, p FROM (SELECT id, source, list_position(ks, source) AS pos, json_extract(raw_data_by_source, '$."' || source || '"') AS p
 FROM (SELECT id, raw_data_by_source, json_keys(raw_data_by_source) AS ks, unnest(json_keys(raw_data_by_source)) AS source FROM lawyer_enrichment WHERE json_valid(raw_data_by_source)))),
v AS (SELECT key, field, pos, CASE source WHEN 'state_bar' THEN 'state_bars' WHEN 'counselpages' THEN 'justia' WHEN 'lawdex' THEN 'google_places' ELSE source END AS source, json_extract_string(p, '$.data.' || field) AS value FROM c)"""
_RANKS = ", ".join(f"('{f}', '{s}', {i})" for f, ss in merge.SOURCE_PRIORITY.items() for i, s in enumerate(ss))


@query(f"""
WITH {_CLAIMS}
SELECT key, field, value, source FROM (SELECT v.*, row_number() OVER (PARTITION BY v.key, v.field ORDER BY coalesce(r, 999), pos) AS rn FROM v LEFT JOIN (VALUES {_RANKS}) k(f, s, r) ON f = v.field AND s = v.source WHERE trim(value) <> '') WHERE rn = 1""")
def merged_by_priority(spark, d):
    return merge.priority_merge(_claims(spark, d), merge.SOURCE_PRIORITY)


_IN = lambda words: ", ".join(f"'{w}'" for w in words)
_FOLD = f"""CASE WHEN coalesce(x.v, '') IN ('', 'null', '""', '[]') THEN acc
 WHEN x.c THEN {{'f': acc.f, 'v': acc.v, 's': acc.s, 'l': x.l, 'w': x.w, 'c': x.c, 'r': acc.r, 'a': 'curated'}}
 WHEN x.f IN ({_IN(merge.IDENTITY_FIELDS)}) AND x.l >= 3 AND coalesce(acc.v, '""') <> '""' THEN {{'f': acc.f, 'v': acc.v, 's': acc.s, 'l': x.l, 'w': x.w, 'c': x.c, 'r': acc.r, 'a': 'identity'}}
 WHEN x.f IN ({_IN(merge.IDENTITY_FIELDS)}) AND x.l >= 3 THEN {{'f': acc.f, 'v': x.v, 's': x.s, 'l': x.l, 'w': x.w, 'c': x.c, 'r': acc.r, 'a': 'filled'}}
 WHEN x.w THEN {{'f': acc.f, 'v': x.v, 's': x.s, 'l': x.l, 'w': x.w, 'c': x.c, 'r': acc.r AND x.f <> 'phone', 'a': 'overwritten'}}
 WHEN acc.v IS NULL THEN {{'f': acc.f, 'v': x.v, 's': x.s, 'l': x.l, 'w': x.w, 'c': x.c, 'r': acc.r, 'a': 'new'}}
 WHEN acc.s = x.s THEN {{'f': acc.f, 'v': x.v, 's': x.s, 'l': x.l, 'w': x.w, 'c': x.c, 'r': acc.r, 'a': 'refreshed'}}
 WHEN lower(trim(trim(acc.v, '"'))) = lower(trim(trim(x.v, '"'))) THEN {{'f': acc.f, 'v': acc.v, 's': acc.s, 'l': x.l, 'w': x.w, 'c': x.c, 'r': acc.r, 'a': 'duplicate'}}
 ELSE {{'f': acc.f, 'v': acc.v, 's': acc.s, 'l': x.l, 'w': x.w, 'c': x.c, 'r': true, 'a': 'conflict'}} END"""


@query(f"""
WITH {_CLAIMS},
p AS (SELECT key, field, pos, source, CAST(to_json(value) AS varchar) AS v, CAST(json_extract(raw_data_by_source, '$."' || list_extract(json_keys(raw_data_by_source), pos) || '".layer') AS int) AS l, coalesce(manually_curated_fields, []) AS locked FROM v JOIN lawyer_enrichment e ON CAST(e.id AS varchar) = key WHERE value IS NOT NULL),
q AS (SELECT key, field, l, pos, source, v, l = 4 AND field IN ({_IN(merge.OVERWRITTEN_FIELDS)}) AS w, locked FROM p UNION ALL SELECT key, 'phone', l, pos, source, v, true, locked FROM p WHERE l = 4 AND field IN ({_IN(merge.LISTING_PHONES)})),
g AS (SELECT key, field, list({{'f': field, 'v': v, 's': source, 'l': l, 'w': w, 'c': list_contains(locked, field), 'r': false, 'a': ''}} ORDER BY l, pos, v, source, w) AS c FROM q GROUP BY ALL),
r AS (SELECT key, field, list_reduce(list_prepend({{'f': field, 'v': CAST(NULL AS varchar), 's': CAST(NULL AS varchar), 'l': CAST(0 AS int), 'w': false, 'c': false, 'r': false, 'a': 'empty'}}, c), lambda acc, x: {_FOLD}) AS z FROM g)
SELECT key, field, z.v AS value, z.s AS source, z.r AS needs_review, z.a AS action FROM r""")
def merged_by_rule(spark, d):
    # A text as JSON: the array of it without its brackets.
    quoted = F.regexp_replace(F.to_json(F.array("value")), r"^\[|\]$", "")
    return merge.rule_merge(_claims(spark, d).where("value is not null").withColumn("value", quoted)).drop("conflicts")


@query(f"WITH {_CLAIMS} SELECT key, field, list(value ORDER BY first_at) AS \"values\" FROM (SELECT key, field, lower(trim(value)) AS k, arg_min(value, pos) AS value, min(pos) - 1 AS first_at FROM v WHERE trim(value) <> '' GROUP BY ALL) GROUP BY key, field")
def merged_lists(spark, d):
    return merge.merge_lists(_claims(spark, d))


@query("""
WITH o AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment, c_custkey % 3 AS level, c_custkey % 5 = 0 AS locked FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0),
n AS (SELECT c_custkey, upper(c_name) AS c_name, c_acctbal + 10 AS c_acctbal, CASE WHEN c_custkey % 7 <> 0 THEN lower(c_mktsegment) END AS c_mktsegment, c_custkey % 4 AS level FROM customer WHERE c_custkey % 2 = 1 OR c_custkey % 3 = 0)
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN coalesce(locked, false) THEN o.c_name WHEN n.level >= coalesce(o.level, 0) THEN coalesce(n.c_name, o.c_name) ELSE coalesce(o.c_name, n.c_name) END AS c_name,
 greatest(o.c_acctbal, n.c_acctbal) AS c_acctbal, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment, greatest(o.level, n.level) AS level FROM o FULL OUTER JOIN n ON o.c_custkey = n.c_custkey""")
def upserted_customers(spark, d):
    c = table(spark, d, "customer")
    old = c.where("c_custkey % 2 = 0 or c_custkey % 3 = 0").selectExpr("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_custkey % 3 as level", "c_custkey % 5 = 0 as locked")
    new = c.where("c_custkey % 2 = 1 or c_custkey % 3 = 0").selectExpr("c_custkey", "upper(c_name) as c_name", "c_acctbal + 10 as c_acctbal", "case when c_custkey % 7 <> 0 then lower(c_mktsegment) end as c_mktsegment", "c_custkey % 4 as level")
    policy = {"c_name": merge.guarded("c_name", F.col("o.locked"), "level"), "c_acctbal": merge.largest("c_acctbal"), "c_mktsegment": merge.new_wins("c_mktsegment"), "level": merge.largest("level")}
    return merge.upsert(old, new, "c_custkey", policy)


# --- similarity and matching -----------------------------------------------------------------------------------------
@query("""
WITH a AS (SELECT id, from_json(json_extract(merged_data, '$.practice_areas'), '["VARCHAR"]') AS x, enrichment_layers FROM lawyer_enrichment WHERE json_valid(merged_data)),
p AS (SELECT l.id, list_distinct(list_transform(l.x, lambda w: lower(w))) AS x, list_distinct(list_transform(r.x, lambda w: lower(w))) AS y FROM a l JOIN a r ON r.id = l.id + 1 WHERE l.x IS NOT NULL AND r.x IS NOT NULL)
SELECT id, CASE WHEN len(x) + len(y) > 0 THEN CAST(len(list_intersect(x, y)) AS double) / len(list_distinct(list_concat(x, y))) ELSE 0.0 END AS overlap FROM p""")
def neighbour_area_overlap(spark, d):
    a = table(spark, d, "lawyer_enrichment").where(F.expr("try_parse_json(merged_data) is not null")).select("id", F.from_json(F.get_json_object("merged_data", "$.practice_areas"), "array<string>").alias("x"))
    b = a.select((F.col("id") - 1).alias("id"), F.col("x").alias("y"))
    return a.join(b, "id").where("x is not null and y is not null").select("id", values.list_overlap(F.col("x"), F.col("y")).cast("double").alias("overlap"))


@query()
def address_similarities(spark, d):
    line = table(spark, d, "lawyer_enrichment").select("id", "state", F.get_json_object("merged_data", "$.address.line1").alias("line"), F.get_json_object("merged_data", "$.address.zip").alias("zip")).where("line <> '' and zip <> ''")
    written = table(spark, d, "google_places").select("scrape_id", "formatted_address", F.regexp_extract("formatted_address", r"(\d{5})(-\d{4})?(, [A-Za-z ]+)?$", 1).alias("zip"))
    pairs = line.join(written, "zip").select("id", "scrape_id", addresses.address_similarity(F.col("line"), F.col("formatted_address")).alias("similarity"))
    return pairs.where("similarity > 0")


@query()
def candidate_confidences(spark, d):
    """The best candidate of all profiles for each find, looked up without making the pairs (``match.best_targets``); only it is scored."""
    own = table(spark, d, "lawyer_enrichment").select("id", "full_name", "first_name", "last_name", "city", F.lower("state").alias("state_code"), F.lit("").alias("state_name"), F.col("bar_number").alias("target_bar"))
    found = table(spark, d, "discovery_candidate").select("candidate_id", "name", "location", "bar_number")
    pairs = match.best_targets(own, found, "id", "candidate_id").join(own, "id").join(found, "candidate_id")
    return match.best_candidate(match.score_candidates(pairs), "candidate_id", "id", 0.6).select("candidate_id", "id", "confidence", "match_signals")


# --- extraction ------------------------------------------------------------------------------------------------------
@query(r"SELECT candidate_id, nullif(regexp_extract(url, '-(\d+)\.html', 1), '') AS profile_number FROM discovery_candidate")
def profile_numbers(spark, d):
    return table(spark, d, "discovery_candidate").select("candidate_id", extract.profile_number(F.col("url")).alias("profile_number"))


@query("""SELECT candidate_id, CAST(candidate_id % 50 AS varchar) AS number, 'https://p.example/a-' || (candidate_id % 50) || '.html' AS link FROM discovery_candidate
UNION ALL SELECT candidate_id, CAST(candidate_id AS varchar), 'https://p.example/c-' || candidate_id || '.html' FROM discovery_candidate WHERE candidate_id <> candidate_id % 50""")
def listing_link_maps(spark, d):
    """The first link of each number on a page of three links, queries cut."""
    n = F.col("candidate_id")
    link = lambda kind, number, rest="": F.concat(F.lit(f"https://p.example/{kind}-"), number.cast("string"), F.lit(f".html{rest}"))
    listed = F.array(link("a", n % 50, "?x=1"), link("b", n % 50), F.lit("https://p.example/about"), link("c", n, "#top"))
    return table(spark, d, "discovery_candidate").select("candidate_id", F.explode(extract.listing_links(listed)).alias("number", "link"))


@query("SELECT scrape_id, name AS term_name, formatted_phone AS phone, CAST(google_rating AS varchar) AS rating FROM google_places WHERE formatted_phone IS NOT NULL AND google_rating IS NOT NULL")
def definition_lists(spark, d):
    rows = table(spark, d, "google_places").where("formatted_phone is not null and google_rating is not null")
    html = F.concat(F.lit("<html><style>dt{}</style><dl><dt>Name:</dt><dd><b>"), "name", F.lit("</b></dd><dt> Phone: </dt><dd>"), "formatted_phone", F.lit("</dd><dt>Rating</dt><dd>"), F.col("google_rating").cast("string"), F.lit("</dd></dl></html>"))
    fields = rows.select("scrape_id", extract.definition_list(extract.strip_markup(html)).alias("f"))
    return fields.select("scrape_id", F.col("f")["Name"].alias("term_name"), F.col("f")["Phone"].alias("phone"), F.col("f")["Rating"].alias("rating"))


@query("SELECT scrape_id, name, formatted_phone AS phone, website FROM google_places WHERE formatted_phone IS NOT NULL AND website IS NOT NULL")
def listing_tables(spark, d):
    rows = table(spark, d, "google_places").where("formatted_phone is not null and website is not null")
    html = F.concat(F.lit("<table><tr><td>menu</td></tr></table><table class='table-hover'><tr><th>Name</th><th>Phone</th><th>Site</th></tr><tr><td>"), F.regexp_replace("name", "&", "&amp;"), F.lit("</td><td>"), "formatted_phone", F.lit("</td><td><a href='x'>"), "website", F.lit("</a></td></tr></table>"))
    return extract.listing_rows(rows.select(F.col("scrape_id").alias("page_id"), html.alias("html")), ["name", "phone", "website"], ["table-hover"]).select(F.col("page_id").alias("scrape_id"), "name", "phone", "website")


@query("SELECT scrape_id, name, place_id FROM google_places")
def linked_data_blocks(spark, d):
    rows = table(spark, d, "google_places")
    block = F.to_json(F.struct(F.lit("LocalBusiness").alias("@type"), F.col("name"), F.concat(F.lit("https://maps.example/?q="), "place_id").alias("url")))
    html = F.concat(F.lit("<script type='application/ld+json'>{broken</script><script type='application/ld+json'>{\"@type\":\"WebSite\"}</script><script type='application/ld+json'>"), block, F.lit("</script>"))
    found = rows.select("scrape_id", extract.linked_data(html, "LocalBusiness").alias("j"))
    return found.select("scrape_id", F.get_json_object("j", "$.name").alias("name"), extract.place_id(F.get_json_object("j", "$.url")).alias("place_id"))
