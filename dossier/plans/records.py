"""Queries of record making, matching and page reading, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.functions import addresses, names, text, values
from dossier.operators import areas, dedupe, extract, match, merge, pages
from dossier.plans.operators import _BAR, _TITLE, _sq, query
from dossier.session import table
from dossier.sources import readers, registry, writers

_IN = lambda words: ", ".join(f"'{w}'" for w in words)
_KEY = lambda x: f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9 ]', '', 'g'))"
_LAST = lambda x: f"regexp_extract({x}, '(\\S+)\\s*$', 1)"


# --- small functions -------------------------------------------------------------------------------------------------
@query(rf"""
SELECT id, trim(regexp_replace(trim('Dr. ' || full_name), '(?i)^(?:(?:Mr|Mrs|Ms|Dr|Prof|Hon)\.|Judge|Sir|Lady)\s+', '')) AS plain, {_KEY('full_name')} AS key, {_LAST(_KEY('full_name'))} AS last,
 sha256(coalesce('avvo:' || nullif(bar_number, ''), {_KEY('full_name')} || '|' || {_KEY('city')} || '|' || {_KEY('license_state')})) AS fingerprint FROM lawyer_enrichment""")
def directory_keys(spark, d):
    name = F.col("full_name")
    return table(spark, d, "lawyer_enrichment").select(
        "id", names.strip_honorific(F.concat(F.lit("Dr. "), name)).alias("plain"), names.match_key(name).alias("key"), names.last_token(names.match_key(name)).alias("last"),
        values.directory_fingerprint(F.col("bar_number"), name, F.col("city"), F.col("license_state")).alias("fingerprint"),
    )


@query(rf"""
WITH h AS (SELECT id, {_sq('full_name')} AS n, nullif(trim(first_name), '') AS f, nullif(trim(last_name), '') AS l, full_name, first_name, last_name FROM lawyer_enrichment)
SELECT id, CASE WHEN trim(full_name) <> '' THEN full_name ELSE nullif(concat_ws(' ', f, l), '') END AS full_name, CASE WHEN f IS NULL AND l IS NULL THEN CASE WHEN contains(n, ' ') THEN regexp_extract(n, '^(.*) [^ ]+$', 1) END ELSE first_name END AS first_name,
 CASE WHEN f IS NULL AND l IS NULL THEN CASE WHEN contains(n, ' ') THEN regexp_extract(n, '([^ ]+)$', 1) END ELSE last_name END AS last_name FROM h""")
def completed_names(spark, d):
    return table(spark, d, "lawyer_enrichment").select("id", names.completed_names(F.col("full_name"), F.col("first_name"), F.col("last_name")).alias("n")).select("id", "n.*")


@query("""SELECT id, list_sort(list_distinct(list_concat(coalesce(enrichment_layers, []), ['level_9']))) AS layers, CASE WHEN list_contains(coalesce(enrichment_layers, []), 'justia') THEN enrichment_layers ELSE list_append(coalesce(enrichment_layers, []), 'justia') END AS added,
 date_diff('second', date_trunc('second', created_at), date_trunc('second', updated_at)) AS seconds, strftime(updated_at, '%Y-%m-%d %H:%M') AS written FROM lawyer_enrichment WHERE len(coalesce(enrichment_layers, [])) = len(list_distinct(coalesce(enrichment_layers, [])))""")
def layers_and_times(spark, d):
    rows = table(spark, d, "lawyer_enrichment").where("size(coalesce(enrichment_layers, array())) = size(array_distinct(coalesce(enrichment_layers, array())))")
    layers = F.coalesce("enrichment_layers", F.array().cast("array<string>"))
    second = lambda c: F.date_trunc("second", F.col(c))
    return rows.select("id", F.array_sort(F.array_union(layers, F.array(F.lit("level_9")))).alias("layers"), values.appended(F.col("enrichment_layers"), F.lit("justia")).alias("added"), values.seconds_between(second("created_at"), second("updated_at")).alias("seconds"), F.date_format("updated_at", "yyyy-MM-dd HH:mm").alias("written"))


@query("SELECT id, merged_data AS document FROM lawyer_enrichment WHERE json_valid(merged_data)")
def fenced_answers(spark, d):
    """Documents wrapped as a model answers come out as they were; broken ones do not."""
    rows = table(spark, d, "lawyer_enrichment").select("id", values.unfenced(F.concat(F.lit("```json\n"), "merged_data", F.lit("\n```"))).alias("document"))
    return rows.where("document is not null")


@query("""SELECT event_id, sha256('{"n":' || (event_id % 97) || ',"t":"' || event_type || '"}') AS digest FROM events WHERE event_type IS NOT NULL""")
def stable_hashes(spark, d):
    """Equal documents hash alike, in whatever order their keys came."""
    rows = table(spark, d, "events").where("event_type is not null")
    document = F.concat(F.lit('{"t": "'), "event_type", F.lit('", "n": '), F.col("event_id") % 97, F.lit("}"))
    return rows.select("event_id", F.sha2(values.stable_json(document), 256).alias("digest"))


@query("SELECT discovery_id FROM google_discovery ORDER BY md5(CAST(discovery_id AS varchar)), discovery_id LIMIT 25")
def sampled_rows(spark, d):
    """Random rows, the same at each run."""
    rows = table(spark, d, "google_discovery").select("discovery_id")
    return rows.orderBy(F.md5(F.col("discovery_id").cast("string")), "discovery_id").limit(25)


@query("SELECT discovery_id, name FROM google_discovery WHERE google_rating >= 4 AND trim(state) <> '' ORDER BY discovery_id LIMIT 50")
def first_accepted(spark, d):
    """Stop after 50 rows that pass, not 50 rows read."""
    return table(spark, d, "google_discovery").where("google_rating >= 4 and trim(state) <> ''").orderBy("discovery_id").limit(50).select("discovery_id", "name")


# --- practice areas --------------------------------------------------------------------------------------------------
_RULES = ", ".join(f"({i}, '{term}', '{area}')" for i, (term, area) in enumerate(areas.RULES))


@query(f"""
WITH rules(i, term, area) AS (VALUES {_RULES}), v AS (SELECT DISTINCT practice_area_searched AS raw, lower(trim(practice_area_searched)) AS t FROM google_discovery WHERE trim(practice_area_searched) <> ''),
own AS (SELECT raw, area FROM v JOIN rules ON term = t), near AS (SELECT raw, arg_min(area, i) AS area FROM v JOIN rules ON contains(t, term) OR contains(term, t) GROUP BY raw)
SELECT v.raw, coalesce(own.area, CASE WHEN t IN ({_IN(areas.CANONICAL)}) THEN t END, near.area) AS area, CASE WHEN coalesce(own.area, CASE WHEN t IN ({_IN(areas.CANONICAL)}) THEN t END, near.area) IS NULL THEN 'none' ELSE 'rule' END AS how FROM v LEFT JOIN own USING (raw) LEFT JOIN near USING (raw)""")
def areas_by_rule(spark, d):
    typed = table(spark, d, "google_discovery").select(F.col("practice_area_searched").alias("raw"))
    return areas.classify_rest(typed, spark.createDataFrame([], "raw string, area string"))


# --- records ---------------------------------------------------------------------------------------------------------
@query(rf"""
WITH a AS (SELECT l.*, {_BAR} AS bar, json_extract_string(CASE WHEN json_valid(merged_data) THEN merged_data END, '$.phone') AS phone FROM lawyer_enrichment l)
SELECT id, {_TITLE('full_name')} AS full_name, nullif(bar, '') AS bar_number, upper(license_state) AS license_state, nullif(firm_name, '') AS firm_name, CAST(date_trunc('year', admission_date) AS date) AS admission_date,
 CASE length(regexp_replace(phone, '[^0-9]', '', 'g')) WHEN 10 THEN '+1' || regexp_replace(phone, '[^0-9]', '', 'g') WHEN 11 THEN CASE WHEN regexp_replace(phone, '[^0-9]', '', 'g') LIKE '1%' THEN '+' || regexp_replace(phone, '[^0-9]', '', 'g') END END AS phone,
 sha256(trim(lower(bar) || ' ' || lower(trim(coalesce(license_state, ''))))) AS fingerprint, bar_number AS raw_bar FROM a""")
def normalized_records(spark, d):
    """Raw records as normal ones, with a key and the raw value beside it."""
    rows = table(spark, d, "lawyer_enrichment").withColumn("phone", F.get_json_object(F.when(F.try_parse_json("merged_data").isNotNull(), F.col("merged_data")), "$.phone"))
    return rows.select(
        "id", text.title_name(F.col("full_name")).alias("full_name"), values.stored_bar(F.col("bar_number")).alias("bar_number"), F.upper("license_state").alias("license_state"), F.nullif("firm_name", F.lit("")).alias("firm_name"),
        values.year_start(F.year("admission_date")).alias("admission_date"), values.strict_phone(F.col("phone")).alias("phone"), values.profile_fingerprint(F.col("bar_number"), F.col("license_state")).alias("fingerprint"), F.col("bar_number").alias("raw_bar"),
    )


@query("""
WITH n AS (SELECT lawyer_enrichment_id AS id, arg_max(first_name, (parsed_at, parse_id)) AS first_name, arg_max(last_name, (parsed_at, parse_id)) AS last_name, CAST(max(parse_id) % 5 AS int) AS level FROM parsed_name WHERE lawyer_enrichment_id IS NOT NULL GROUP BY 1),
o AS (SELECT id, first_name, last_name, CAST(enrichment_level AS int) AS level, coalesce(manually_curated, false) AND list_contains(coalesce(manually_curated_fields, []), 'full_name') AS locked, enrichment_layers AS layers, CAST(completeness_score AS int) AS score, license_state FROM lawyer_enrichment)
SELECT coalesce(o.id, n.id) AS id, CASE WHEN coalesce(o.locked, false) AND n.level < 4 THEN o.first_name WHEN n.level >= coalesce(o.level, 0) THEN coalesce(n.first_name, o.first_name) ELSE coalesce(o.first_name, n.first_name) END AS first_name,
 CASE WHEN coalesce(o.locked, false) AND n.level < 4 THEN o.last_name WHEN n.level >= coalesce(o.level, 0) THEN coalesce(n.last_name, o.last_name) ELSE coalesce(o.last_name, n.last_name) END AS last_name,
 greatest(o.level, n.level) AS level, o.score AS score, o.license_state AS license_state, CASE WHEN n.id IS NULL THEN o.layers WHEN list_contains(coalesce(o.layers, []), 'parsed') THEN o.layers ELSE list_append(coalesce(o.layers, []), 'parsed') END AS layers FROM o FULL OUTER JOIN n ON o.id = n.id""")
def upserted_profiles(spark, d):
    """The newest parse of each profile written over it: locked names stay below level 4, higher levels win, lower ones only fill."""
    newest = lambda c: F.max_by(c, F.struct("parsed_at", "parse_id")).alias(c)
    new = table(spark, d, "parsed_name").where("lawyer_enrichment_id is not null").groupBy(F.col("lawyer_enrichment_id").alias("id")).agg(newest("first_name"), newest("last_name"), (F.max("parse_id") % 5).cast("int").alias("level"))
    locked = F.coalesce("manually_curated", F.lit(False)) & F.coalesce(F.array_contains("manually_curated_fields", "full_name"), F.lit(False))
    old = table(spark, d, "lawyer_enrichment").select("id", "first_name", "last_name", F.col("enrichment_level").cast("int").alias("level"), locked.alias("locked"), F.col("enrichment_layers").alias("layers"), F.col("completeness_score").cast("int").alias("score"), "license_state")
    new = new.withColumns({"layers": F.array(F.lit("parsed")), "score": F.lit(None).cast("int"), "license_state": F.lit(None).cast("string")})
    low = F.coalesce(F.col("o.locked"), F.lit(False)) & (F.col("n.level") < 4)
    added = F.when(F.col("n.id").isNull(), F.col("o.layers")).otherwise(values.appended(F.col("o.layers"), F.lit("parsed")))
    policy = {"first_name": merge.guarded("first_name", low, "level"), "last_name": merge.guarded("last_name", low, "level"), "level": merge.largest("level"), "score": merge.largest("score"), "license_state": merge.keep_old("license_state"), "layers": added}
    return merge.upsert(old, new, "id", policy)


@query("""
WITH doc AS (SELECT id, CASE WHEN json_valid(merged_data) THEN merged_data END AS m, CASE WHEN json_valid(raw_data_by_source) THEN raw_data_by_source END AS r, coalesce(list_contains(manually_curated_fields, 'phone'), false) AS locked FROM lawyer_enrichment),
v AS (SELECT id, locked, nullif(json_extract_string(m, '$.phone'), '') AS phone, nullif(json_extract_string(r, '$.lawdex.data.phone'), '') AS listed, nullif(json_extract_string(r, '$.counselpages.data.phone'), '') AS told,
 nullif(json_extract_string(m, '$.email'), '') AS email, nullif(json_extract_string(r, '$.counselpages.data.email'), '') AS email2, nullif(json_extract_string(r, '$.state_bar.data.email'), '') AS email3, list_sort(json_keys(r)) AS sources FROM doc)
SELECT id, CASE WHEN locked THEN coalesce(phone, listed, told) ELSE coalesce(listed, phone, told) END AS phone, coalesce(email, email2, email3) AS email, sources FROM v""")
def fused_sources(spark, d):
    """One value a field by a fixed chain of sources; the listing's phone goes first unless the phone is locked. Payloads with or without "data"."""
    rows = table(spark, d, "lawyer_enrichment").select("id", F.coalesce(F.array_contains("manually_curated_fields", "phone"), F.lit(False)).alias("locked"), *[F.when(F.try_parse_json(c).isNotNull(), F.col(c)).alias(a) for c, a in (("merged_data", "m"), ("raw_data_by_source", "r"))])
    of = lambda source, field: F.coalesce(F.get_json_object("r", f"$.{source}.data.{field}"), F.get_json_object("r", f"$.{source}.{field}"))
    own = lambda field: F.get_json_object("m", f"$.{field}")
    phone = F.when(F.col("locked"), merge.first_nonempty(own("phone"), of("lawdex", "phone"), of("counselpages", "phone"))).otherwise(merge.first_nonempty(of("lawdex", "phone"), own("phone"), of("counselpages", "phone")))
    return rows.select("id", phone.alias("phone"), merge.first_nonempty(own("email"), of("counselpages", "email"), of("state_bar", "email")).alias("email"), F.array_sort(F.json_object_keys("r")).alias("sources"))


@query("""
WITH doc AS (SELECT id, merged_data AS m FROM lawyer_enrichment WHERE json_valid(merged_data)), kv AS (SELECT id, unnest(json_keys(m)) AS k, m FROM doc),
f AS (SELECT id, count(*) FILTER (WHERE CAST(json_extract(m, '$."' || k || '"') AS varchar) NOT IN ('""', 'null', '[]', '{}')) AS kept, count(*) FILTER (WHERE k <> 'website_url' AND CAST(json_extract(m, '$."' || k || '"') AS varchar) NOT IN ('""', 'null', '[]', '{}')) AS more FROM kv GROUP BY id)
SELECT id, kept AS fields, more = 0 AS nothing FROM f""")
def pruned_documents(spark, d):
    rows = table(spark, d, "lawyer_enrichment").where(F.expr("try_parse_json(merged_data) is not null"))
    kept = rows.select("id", values.pruned(F.from_json("merged_data", "map<string,string>")).alias("f"))
    return kept.select("id", F.size("f").cast("long").alias("fields"), values.says_nothing(F.col("f"), "website_url").alias("nothing"))


@query("""SELECT id, CAST(json_extract(m, '$.phone') IS NOT NULL AS boolean) AS has_phone, json_extract_string(m, '$.address.zip') AS zip FROM (SELECT id, CASE WHEN json_valid(merged_data) THEN merged_data END AS m FROM lawyer_enrichment)""")
def document_keys(spark, d):
    rows = table(spark, d, "lawyer_enrichment").select("id", F.when(F.try_parse_json("merged_data").isNotNull(), F.col("merged_data")).alias("m"))
    return rows.select("id", F.coalesce(F.array_contains(F.json_object_keys("m"), "phone"), F.lit(False)).alias("has_phone"), F.get_json_object("m", "$.address.zip").alias("zip"))


@query("""
WITH k AS (SELECT id, lower(trim(license_state)) AS st, lower(trim(bar_number)) AS bar, to_json({'name': coalesce(full_name, ''), 'firm': coalesce(firm_name, '')}) AS doc, coalesce(full_name, '') AS n, coalesce(firm_name, '') AS f FROM lawyer_enrichment WHERE trim(bar_number) <> '' AND trim(license_state) <> ''),
g AS (SELECT *, first_value(n) OVER w AS wn, first_value(f) OVER w AS wf, row_number() OVER w AS rn, count(*) OVER (PARTITION BY st, bar) AS c FROM k WINDOW w AS (PARTITION BY st, bar ORDER BY id))
SELECT min(id) AS winner, id AS loser, nullif(coalesce(nullif(wn, ''), n), '') AS name, nullif(coalesce(nullif(wf, ''), f), '') AS firm FROM (SELECT *, first_value(id) OVER (PARTITION BY st, bar ORDER BY id) AS w0 FROM g) WHERE rn = 2 GROUP BY id, wn, n, wf, f, w0 HAVING true""".replace("min(id) AS winner", "w0 AS winner"))
def deep_merged_pairs(spark, d):
    """The first two rows of each licence, the loser's values where the winner has none."""
    low = lambda c: F.lower(F.trim(c))
    rows = table(spark, d, "lawyer_enrichment").where("trim(bar_number) <> '' and trim(license_state) <> ''").select("id", low("license_state").alias("st"), low("bar_number").alias("bar"), F.create_map(F.lit("name"), F.coalesce("full_name", F.lit("")), F.lit("firm"), F.coalesce("firm_name", F.lit(""))).alias("doc"))
    first = rows.groupBy("st", "bar").agg(F.min("id").alias("winner"))
    second = rows.join(first, ["st", "bar"]).where("id > winner").groupBy("st", "bar", "winner").agg(F.min("id").alias("loser"))
    a, b = rows.select(F.col("id").alias("winner"), F.col("doc").alias("w")), rows.select(F.col("id").alias("loser"), F.col("doc").alias("l"))
    both = second.join(a, "winner").join(b, "loser").select("winner", "loser", merge.deep_merge(F.col("w"), F.col("l")).alias("m"))
    return both.select("winner", "loser", F.nullif(F.col("m")["name"], F.lit("")).alias("name"), F.nullif(F.col("m")["firm"], F.lit("")).alias("firm"))


# --- matching --------------------------------------------------------------------------------------------------------
_SIG = lambda alias: f"{{'name': {_KEY(f'{alias}.name')}, 'city': {_KEY(f'{alias}.city')}, 'state': {_KEY(f'{alias}.state')}}}"


@query(rf"""
WITH t AS (SELECT id, {_KEY('full_name')} AS name, coalesce(nullif({_KEY('last_name')}, ''), {_LAST(_KEY('full_name'))}) AS last, {_KEY('city')} AS city, {_KEY('coalesce(license_state, state)')} AS state FROM lawyer_enrichment),
c AS (SELECT candidate_id, {_KEY('name')} AS name, {_LAST(_KEY('name'))} AS last, {_KEY("trim(split_part(location, ',', 1))")} AS city, {_KEY("CASE WHEN contains(location, ',') THEN trim(substr(location, strpos(location, ',') + 1)) END")} AS state FROM discovery_candidate)
SELECT id, candidate_id, least(1.0, CASE WHEN t.name <> '' AND t.name = c.name THEN CAST(1.0 AS double) ELSE 0.85 END + CASE WHEN t.city <> '' AND t.city = c.city THEN 0.05 ELSE 0.0 END + CASE WHEN t.state <> '' AND t.state = c.state THEN 0.05 ELSE 0.0 END) AS score
FROM t JOIN c ON t.last = c.last AND t.last <> ''""")
def signature_scores(spark, d):
    """Scores of all profiles and finds with the same last name, by their signatures (the sequence ratio is for the others)."""
    return _signed(spark, d).select("id", "candidate_id", F.round("score", 9).alias("score"))


def _signed(spark, d) -> DataFrame:
    none = F.lit(None).cast("string")
    own = table(spark, d, "lawyer_enrichment").select("id", match.signature(F.col("full_name"), F.col("last_name"), none, F.col("city"), F.coalesce("license_state", "state")).alias("t"))
    place = F.col("location")
    found = table(spark, d, "discovery_candidate").select("candidate_id", match.signature(F.col("name"), none, none, F.trim(F.substring_index(place, ",", 1)), F.when(place.contains(","), F.trim(F.regexp_extract(place, "(?s)^[^,]*,(.*)$", 1)))).alias("c"))
    pairs = own.withColumn("last", F.col("t.last")).where("last <> ''").join(found.withColumn("last", F.col("c.last")), "last")
    return pairs.select("id", "candidate_id", match.signature_score(F.col("t"), F.col("c"), F.lit(0.0)).alias("score"))


@query("SELECT CAST(0 AS bigint) AS targets_twice, CAST(0 AS bigint) AS candidates_twice, CAST(0 AS bigint) AS passed_over")
def exclusive_match_checks(spark, d):
    """What must hold of the exclusive choice: nobody twice, and no better candidate that is free or went to a later target."""
    scored = _signed(spark, d).where("score >= 0.95")
    chosen = match.exclusive_matches(scored, "id", "candidate_id", 0.95)
    mine = chosen.select("id", F.col("score").alias("own"))
    theirs = chosen.select("candidate_id", F.col("id").alias("holder"))
    better = scored.join(mine, "id", "left").join(theirs, "candidate_id", "left").where("(own is null or score > own) and (holder is null or holder > id)")
    twice = lambda c: chosen.groupBy(c).count().where("count > 1").agg(F.count("*").alias(f"{c}_n"))
    return twice("id").crossJoin(twice("candidate_id")).crossJoin(better.agg(F.count("*").alias("passed_over"))).select(F.col("id_n").alias("targets_twice"), F.col("candidate_id_n").alias("candidates_twice"), "passed_over")


@query("""SELECT url, CASE WHEN n = 0 THEN 'not_found' WHEN best >= 0.8 OR (n = 1 AND best >= 0.45) THEN 'found' ELSE 'candidates' END AS decision, best, n
FROM (SELECT url, coalesce(max(confidence), 0.0) AS best, count(*) FILTER (WHERE confidence > 0) AS n FROM discovery_candidate GROUP BY url)""")
def discovery_decisions(spark, d):
    return match.decisions(table(spark, d, "discovery_candidate").select("url", "confidence"), "url", 0.8)


_WORDS = lambda x: f"regexp_extract_all(lower({x}), '[a-z0-9]+')"


@query(rf"""
WITH p AS (SELECT id, lower(trim(first_name)) AS f, lower(trim(last_name)) AS l, city, state FROM lawyer_enrichment WHERE regexp_full_match(first_name, '[A-Za-z]{{3,}}') AND regexp_full_match(last_name, '[A-Za-z]{{3,}}') AND trim(city) <> '' AND regexp_full_match(trim(state), '[A-Za-z]{{2}}') AND NOT contains(city, '.')),
g AS (SELECT scrape_id, list_filter({_WORDS('name')}, lambda w: w NOT IN ({_IN([*names.FIRM_WORDS, *names.MATCH_PREFIXES, *names.SUFFIXES])})) AS own, formatted_address AS a FROM google_places WHERE formatted_address IS NOT NULL AND NOT contains(name, ',') AND name NOT LIKE '%&%' AND NOT list_contains({_WORDS('name')}, 'and')),
w AS (SELECT scrape_id, unnest(list_distinct(own)) AS l, own, a FROM g),
m AS (SELECT id, scrape_id, list_contains(own, f) AS whole, len(list_filter(own, lambda w: w NOT IN (f, p.l, f[1:1]))) AS foreign_words, regexp_matches(lower(a), '\b' || regexp_replace(lower(trim(city)), '([^a-z0-9 ])', '\\\1', 'g') || '\b') AS in_city, regexp_matches(lower(a), '\b' || lower(trim(state)) || '\b') AS in_state FROM p JOIN w ON p.l = w.l)
SELECT id, scrape_id, round(CASE WHEN whole THEN 0.45 ELSE 0.3 END + CASE WHEN in_city THEN 0.1 ELSE 0.0 END + CASE WHEN in_state THEN 0.1 ELSE 0.0 END, 2) AS confidence FROM m WHERE in_state AND (whole OR foreign_words = 0)""")
def place_confidences(spark, d):
    """Profiles (with plain names) and places of one state whose names share the last name, by the rules for places; no street or firm here."""
    plain = "first_name rlike '^[A-Za-z]{3,}$' and last_name rlike '^[A-Za-z]{3,}$' and trim(city) <> '' and trim(state) rlike '^[A-Za-z]{2}$' and not contains(city, '.')"
    none = F.lit(None).cast("string")
    own = table(spark, d, "lawyer_enrichment").where(plain).select("id", F.concat_ws(" ", "first_name", "last_name").alias("full_name"), "first_name", "last_name", none.alias("firm_name"), none.alias("line1"), "city", F.col("state").alias("state_code"), F.lit("").alias("state_name"), F.concat_ws("|", F.lower(F.trim("last_name")), F.lower(F.trim("state"))).alias("k"))
    found = table(spark, d, "google_places").where("formatted_address is not null and not contains(name, ',') and name not like '%&%'").where(~F.array_contains(names.word_tokens(F.col("name")), "and"))
    codes = F.array_distinct(F.filter(names.word_tokens(F.col("formatted_address")), lambda w: F.length(w) == 2))
    keys = F.flatten(F.transform(F.array_distinct(names.word_tokens(F.col("name"))), lambda w: F.transform(codes, lambda c: F.concat_ws("|", w, c))))
    found = found.select("scrape_id", F.col("name").alias("place_name"), "formatted_address", F.explode(keys).alias("k"))
    return match.place_confidence(own.join(found, "k")).where("confidence > 0").select("id", "scrape_id", "confidence")


# --- pages -----------------------------------------------------------------------------------------------------------
@query("""SELECT scrape_id, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS full_name, nullif(trim(regexp_replace(formatted_phone, '\\s+', ' ', 'g')), '') AS phone, nullif(website, '') AS website FROM google_places WHERE trim(name) <> '' AND NOT contains(name, '"')""")
def profile_pages(spark, d):
    """Places written as profile pages and read back."""
    rows = table(spark, d, "google_places").where("trim(name) <> '' and not contains(name, '\\\"')")
    ld = F.to_json(F.struct(F.lit("LocalBusiness").alias("@type"), "name", F.col("formatted_phone").alias("telephone"), F.struct(F.col("website").alias("url")).alias("image")))
    html = F.concat(F.lit("<html><script type='application/ld+json'>{oops</script><script type='application/ld+json'>"), ld, F.lit("</script></html>"))
    read = rows.select("scrape_id", pages.profile_record(html, F.lit("u")).alias("p"))
    return read.select("scrape_id", "p.full_name", "p.phone", F.col("p.photo_url").alias("website"))


@query("""SELECT source_key, url, arg_max(name, (length(name), -candidate_id)) AS name FROM (SELECT source_key, '/attorneys/' || md5(coalesce(url, '')) AS url, candidate_id, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS name FROM discovery_candidate WHERE trim(name) <> '' AND NOT contains(name, '<') AND NOT contains(name, '&')) WHERE length(name) >= 3 GROUP BY ALL""")
def search_result_cards(spark, d):
    """Finds written as search pages, one a source and find, and read back: the longest name a link."""
    rows = table(spark, d, "discovery_candidate").where("trim(name) <> '' and not contains(name, '<') and not contains(name, '&') and length(trim(regexp_replace(name, '\\\\s+', ' '))) >= 3")
    link = F.concat(F.lit("/attorneys/"), F.md5(F.coalesce("url", F.lit(""))))
    card = F.concat(F.lit('<div class="serp-card organic-card"><a href="'), link, F.lit('#top">x</a><a href="'), link, F.lit('">View Profile</a><a href="'), link, F.lit('"><b>'), "name", F.lit("</b></a></div>"))
    cards = pages.search_cards(rows.select(F.col("candidate_id").alias("page_id"), card.alias("html"))).join(rows.select(F.col("candidate_id").alias("page_id"), "source_key"), "page_id")
    best = pages.best_named(cards.withColumn("key", F.concat_ws(" ", "source_key", "url")), "key", "name", "page_id")
    return best.select("source_key", "url", "name")


@query("""SELECT id, trim(regexp_replace(bio, '\\s+', ' ', 'g')) AS bio, ['Tax', 'Wills'] AS practice_areas, 'Any School' AS school FROM lawyer_enrichment WHERE trim(bio) <> '' AND NOT contains(bio, '<') AND NOT contains(bio, '>') AND trim(regexp_replace(bio, '\\s+', ' ', 'g')) NOT IN ('Practice Areas', 'Fees')""")
def page_sections(spark, d):
    rows = table(spark, d, "lawyer_enrichment").where("trim(bio) <> '' and not contains(bio, '<') and not contains(bio, '>')")
    html = F.concat(F.lit("<h2>Biography</h2><p>"), text.squeeze(F.col("bio")), F.lit("</p><h2>Practice Areas</h2><ul><li>Tax • Wills</li><li>Tax</li></ul><h2>Fees</h2><h2>Education</h2><p>Any School</p>"))
    return rows.select("id", pages.section_record(html, F.lit("u")).alias("s")).select("id", "s.bio", "s.practice_areas", "s.school")


@query("""SELECT scrape_id, trim(regexp_replace(name, '\\s+', ' ', 'g')) AS full_name, google_rating AS rating, CAST(google_review_count AS int) AS review_count, nullif(website, '') AS website_url FROM google_places WHERE trim(name) <> ''""")
def crawled_records(spark, d):
    rows = table(spark, d, "google_places").where("trim(name) <> ''")
    item = F.to_json(F.struct(F.lit("").alias("name"), F.col("name").alias("full_name"), F.col("google_rating").cast("string").alias("rating"), F.array().cast("array<string>").alias("reviewCount"), F.col("google_review_count").cast("string").alias("reviewsCount"), F.col("website").alias("websiteUrl")))
    return rows.select("scrape_id", pages.crawled_record(item).alias("r")).select("scrape_id", "r.full_name", "r.rating", "r.review_count", "r.website_url")


@query(f"""SELECT scrape_id, CASE WHEN contains(a, ',') AND ({' OR '.join(f"contains(upper(trim(split_part(a, ',', 1))), '{m}')" for m in pages.FIRM_MARKS)}) THEN trim(split_part(a, ',', 1)) END AS firm,
 nullif(concat_ws(', ', nullif(trim(name), ''), 'Any Town, CA 90001'), '') AS address FROM (SELECT *, name || ', ' || coalesce(formatted_address, '') AS a FROM google_places WHERE NOT contains(name, '<') AND NOT contains(name, '>'))""")
def firms_in_addresses(spark, d):
    rows = table(spark, d, "google_places").where("not contains(name, '<') and not contains(name, '>')")
    lines = F.concat(F.lit("<p>"), "name", F.lit("<br/> </p>"))
    return rows.select("scrape_id", pages.firm_from_address(F.concat("name", F.lit(", "), F.coalesce("formatted_address", F.lit("")))).alias("firm"), pages.address_from_lines(lines, F.lit("Any Town"), F.lit("CA"), F.lit("90001")).alias("address"))


# --- sources and sinks -----------------------------------------------------------------------------------------------
@query("SELECT id, source_key, 'pending' AS status, CASE WHEN source_key = 'justia' THEN 7 ELSE 5 END AS priority FROM lawyer_enrichment CROSS JOIN (VALUES ('justia'), ('google_maps')) s(source_key)")
def seeded_requests(spark, d):
    ids = table(spark, d, "lawyer_enrichment").select("id", F.lit(5).alias("priority"))
    old = ids.select("id", F.lit("justia").alias("source_key"), F.lit("done").alias("status"), F.lit(7).alias("priority"))
    return writers.append_requests(ids, ["justia", "google_maps"], old)


@query("SELECT two AS bucket, all_n AS n FROM (SELECT left(k, 2) AS two, count(*) AS all_n FROM (SELECT lower(trim(last_name)) AS k FROM lawyer_enrichment) WHERE k <> '' GROUP BY 1) WHERE all_n < 40 UNION ALL SELECT left(k, 3), count(*) FROM (SELECT lower(trim(last_name)) AS k FROM lawyer_enrichment) WHERE k <> '' AND left(k, 2) IN (SELECT left(k, 2) FROM (SELECT lower(trim(last_name)) AS k FROM lawyer_enrichment) WHERE k <> '' GROUP BY 1 HAVING count(*) >= 40) GROUP BY 1")
def name_buckets(spark, d):
    """Names by two letters, and by three where two have 40 names or more. Buckets of one text are one."""
    return readers.adaptive_buckets(table(spark, d, "lawyer_enrichment"), "last_name", 40)


@query("SELECT discovery_id, 'no_state' AS error_type FROM google_discovery WHERE coalesce(trim(state), '') = '' UNION ALL SELECT discovery_id, 'no_rating' FROM google_discovery WHERE trim(state) <> '' AND google_rating IS NULL")
def quarantined_hits(spark, d):
    rows = table(spark, d, "google_discovery")
    return writers.split_valid(rows, {"no_state": F.trim("state") != "", "no_rating": F.col("google_rating").isNotNull()})[1].select("discovery_id", "error_type")


@query("SELECT bar_number, license_state, count(*) AS n FROM lawyer_enrichment WHERE bar_number IS NOT NULL AND license_state IS NOT NULL GROUP BY ALL HAVING count(*) > 1")
def licence_violations(spark, d):
    return writers.violations(table(spark, d, "lawyer_enrichment"), ["bar_number", "license_state"])


@query("SELECT scrape_id, place_id, name, formatted_phone, google_rating, CAST(google_review_count AS int) AS google_review_count, 'https://m.example/?key=&q=1' AS maps_url FROM google_places WHERE place_id IS NOT NULL")
def place_payloads(spark, d):
    rows = table(spark, d, "google_places").where("place_id is not null")
    payload = F.to_json(F.struct("place_id", "name", F.col("formatted_phone").alias("formatted_phone_number"), F.col("google_rating").alias("rating"), F.col("google_review_count").alias("user_ratings_total"), F.lit("https://m.example/?key=secret&q=1").alias("url")))
    return readers.place_details(rows.select("scrape_id", payload.alias("payload"))).select("scrape_id", "place_id", "name", "formatted_phone", "google_rating", "google_review_count", "maps_url")


@query("SELECT candidate_id, CASE source_key WHEN 'google' THEN 4 ELSE 3 END AS layer, true AS asked FROM discovery_candidate WHERE source_key IN (SELECT DISTINCT source_key FROM discovery_candidate)")
def finds_by_plugin(spark, d):
    """Every find goes to the plug-in of its source; sources without one of their own share the general one."""
    finds = table(spark, d, "discovery_candidate").select("candidate_id", "source_key")
    plugins = registry.Registry()
    plugins.add(registry.Source("google", 4, lambda df: df.withColumn("asked", F.lit(True))))
    plugins.add(registry.Source("*", 3, lambda df: df.withColumn("asked", F.lit(True))))
    return plugins.run(finds, "source_key").select("candidate_id", "layer", "asked")


@query(f"SELECT id, {_sq('lower(city)')} AS town, list_sort(list_distinct(regexp_extract_all(lower(coalesce(full_name, '')), '[a-z0-9]+'))) AS words FROM lawyer_enrichment")
def word_lists(spark, d):
    return table(spark, d, "lawyer_enrichment").select("id", text.squeeze(F.lower("city")).alias("town"), F.array_sort(F.array_distinct(names.word_tokens(F.col("full_name")))).alias("words"))


@query("""SELECT scrape_id, len(t) >= 2 AND len(list_filter(t, lambda w: regexp_matches(w, '[0-9]'))) > 0 AND len(list_filter(t, lambda w: regexp_matches(w, '[a-z]'))) > 0 AS is_street FROM (SELECT scrape_id, regexp_extract_all(lower(coalesce(formatted_address, '')), '[a-z0-9]+') AS t FROM google_places)""")
def street_addresses(spark, d):
    return table(spark, d, "google_places").select("scrape_id", addresses.is_street_address(F.col("formatted_address")).alias("is_street"))


@query("SELECT google_place_id, arg_max(name, (discovered_at, discovery_id)) AS name FROM google_discovery WHERE google_place_id IS NOT NULL GROUP BY google_place_id")
def newest_hit_per_place(spark, d):
    """Cache semantics: what was put last under a key is what it holds."""
    rows = table(spark, d, "google_discovery").select("google_place_id", "name", "discovered_at", "discovery_id").where("google_place_id is not null")
    return dedupe.best_per_key(rows, ["google_place_id"], F.struct("discovered_at", "discovery_id")).select("google_place_id", "name")


@query(r"SELECT candidate_id, nullif(regexp_extract('Page of ' || candidate_id || ' entries. State Bar # ' || candidate_id, '(?i)State Bar\s*#\s*([0-9]{4,})', 1), '') AS bar, CAST(ceil(candidate_id / 50.0) AS int) AS pages, CAST(1900 + candidate_id % 120 AS int) AS year FROM discovery_candidate")
def page_numbers_and_years(spark, d):
    n = F.col("candidate_id").cast("string")
    page = F.concat(F.lit("Page of "), n, F.lit(" entries. State Bar # "), n)
    return table(spark, d, "discovery_candidate").select("candidate_id", extract.bar_number(page).alias("bar"), extract.total_pages(page, 50).alias("pages"), extract.admission_year(F.concat(F.lit("Admitted on May 1, "), (1900 + F.col("candidate_id") % 120).cast("string"))).alias("year"))
