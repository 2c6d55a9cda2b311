"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

from dossier.llm.aliases import AREA_ALIASES, AREA_NOISE, STATES, TOWN_WORDS
from dossier.llm.golden import FIELDS, ROUNDS
from dossier.llm.people import NO_VALUE

_NONE = ", ".join(f"'{v}'" for v in NO_VALUE)


def _real(x: str) -> str:
    return f"CASE WHEN trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) NOT IN ({_NONE}) THEN {x} END"


def _best(field: str) -> str:
    payload = _real(f"json_extract_string(raw, '$.\"' || k || '\".data.{field}')")
    raw = f"list_filter(list_transform(list_sort(json_keys(raw)), lambda k: {payload}), lambda v: v IS NOT NULL)[1]"
    merged = _real(f"json_extract_string(m, '$.{field}')")
    return f"SELECT id, '{field}' AS column_name, coalesce({merged}, {raw}) AS value, coalesce(list_contains(manually_curated_fields, '{field}'), false) AS curated, updated_at, state, bar FROM r"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _area_norm(x: str, noise: bool = False) -> str:
    text = f"translate(lower({x}), '_-*áéíóúñü', '   aeiounu')"
    text = f"regexp_replace({text}, '\\((all types|any)\\)|& more\\s*$|\\.', ' ', 'g')"
    text = f"trim(regexp_replace({text}, '\\s+', ' ', 'g'))"
    if not noise:
        text = f"regexp_replace({text}, ' ({'|'.join(AREA_NOISE)})$', '')"
    return f"regexp_replace(regexp_replace({text}, '^([^,]+),([^,]+)$', '\\2 \\1'), '[^a-z0-9]', '', 'g')"


def _town_norm(x: str) -> str:
    names = "|".join(sorted(name.lower() for name in STATES.values()))
    codes = "|".join(code.lower() for code in STATES)
    text = f"trim(regexp_replace(lower({x}), '\\s+', ' ', 'g'))"
    text = f"regexp_replace({text}, '\\s*,\\s*({codes}|{names})\\.?(\\s+\\d{{5}}(-\\d{{4}})?)?$', '')"
    text = f"regexp_replace({text}, '^(the )?(city|town|village) of ', '')"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TOWN_WORDS.items())
    return f"array_to_string(list_transform(string_split(trim(regexp_replace({text}, '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: CASE w {cases} ELSE w END), '')"


_ALIASES = ", ".join(f"({_quoted(name)}, {_quoted(a.strip())})" for name, text in AREA_ALIASES.items() for a in text.split(";"))
_CODES = ", ".join(f"('{name.upper()}', '{code}'), ('{code}', '{code}')" for code, name in STATES.items())
_STATE = lambda x: f"(SELECT min(code) FROM codes WHERE codes.name = upper(trim(regexp_replace({x}, '[.\\s]+', ' ', 'g'))))"

#: All values against all entries of their scope: small lists, so brute force is feasible here.
_P7 = f"""
WITH codes(name, code) AS (VALUES {_CODES}),
doc AS (SELECT id, merged_data AS m FROM lawyer_enrichment WHERE json_valid(merged_data)),
raw AS (SELECT 'searched' AS place_typed, discovery_id AS row_id, practice_area_searched AS typed_value, 'area' AS scope FROM google_discovery
 UNION ALL SELECT 'areas', id, unnest(list_distinct(from_json(json_extract(m, '$.practice_areas'), '["VARCHAR"]'))), 'area' FROM doc
 UNION ALL SELECT 'city', id, json_extract_string(m, '$.address.city'), coalesce({_STATE("json_extract_string(m, '$.address.state')")}, {_STATE("nullif(regexp_extract(json_extract_string(m, '$.address.city'), ',\\s*([A-Za-z][A-Za-z .]+?)\\s*$', 1), '')")}, '*') FROM doc),
t AS (SELECT *, CASE WHEN scope = 'area' THEN {_area_norm('typed_value')} ELSE {_town_norm('typed_value')} END AS norm FROM raw WHERE regexp_replace(typed_value, '\\s+', '', 'g') <> ''
 AND NOT (place_typed <> 'city' AND typed_value IN (SELECT area_name FROM practice_area_ref)) AND NOT (place_typed = 'city' AND typed_value IN (SELECT city_name FROM city_ref))),
named AS (SELECT area_name AS name, area_id AS ref_id FROM practice_area_ref UNION ALL SELECT a.alias, r.area_id FROM (VALUES {_ALIASES}) a(area, alias) JOIN practice_area_ref r ON r.area_name = a.area),
towns AS (SELECT upper(trim(state_code)) AS scope, {_town_norm('city_name')} AS norm, city_id AS ref_id FROM city_ref),
spelt AS (SELECT scope, norm, ref_id FROM towns UNION SELECT scope, regexp_replace(norm, '^(saint|south)(.)', 's\\2'), ref_id FROM towns),
refs AS (SELECT 'area' AS scope, {_area_norm('name')} AS norm, ref_id FROM named UNION SELECT 'area', {_area_norm('name', True)}, ref_id FROM named
 UNION SELECT scope, norm, ref_id FROM spelt UNION SELECT '*', norm, min(ref_id) FROM spelt GROUP BY norm HAVING count(*) = 1),
v AS (SELECT DISTINCT scope, norm FROM t),
pairs AS (SELECT v.scope, v.norm, r.ref_id, levenshtein(v.norm, r.norm) AS edits, least(length(v.norm), length(r.norm)) AS n FROM v JOIN refs r ON r.scope = v.scope AND abs(length(r.norm) - length(v.norm)) <= 2 WHERE length(r.norm) > 0),
best AS (SELECT scope, norm, arg_min(ref_id, (edits, ref_id)) AS ref_id FROM pairs WHERE edits = 0 OR (edits <= CASE WHEN n < 4 THEN 0 WHEN n < 6 THEN 1 ELSE 2 END AND length(norm) >= 3) GROUP BY ALL)
SELECT place_typed, row_id, typed_value, coalesce(ref_id, 0) AS ref_id FROM t LEFT JOIN best USING (scope, norm)"""

#: Claims, votes and the rounds of truth discovery that are always taken, one after the other.
def _truth(rounds: int) -> str:
    said = "regexp_replace(lower(x.v), '[^\\p{L}\\p{N}@.]+', '', 'g')"
    merged, told = _real("json_extract_string(m, '$.' || field)"), _real("json_extract_string(raw, '$.\"' || k || '\".data.' || field)")
    steps = "s0 AS MATERIALIZED (SELECT DISTINCT source, CAST(0.8 AS double) AS rel FROM votes)"
    for i in range(rounds):
        steps += f""",
u{i} AS MATERIALIZED (SELECT group_id, field, said, sum(rel * ln(1 + n)) AS support FROM votes JOIN s{i} USING (source) GROUP BY ALL),
c{i} AS MATERIALIZED (SELECT *, support / sum(support) OVER (PARTITION BY group_id, field) AS confidence FROM u{i}),
s{i + 1} AS MATERIALIZED (SELECT source, sum(confidence * n) / sum(n) AS rel FROM votes JOIN c{i} USING (group_id, field, said) GROUP BY source)"""
    return f"""
WITH {_GROUPS},
e AS (SELECT group_id, field, {merged} AS merged, coalesce(list_filter(list_transform(list_sort(json_keys(raw)), lambda k: {{'s': k, 'v': {told}}}), lambda x: x.v IS NOT NULL), []) AS told FROM r JOIN g ON g.st = r.st AND g.bar = r.bar CROSS JOIN (VALUES {', '.join(f"('{f}')" for f in FIELDS)}) f(field)),
v AS (SELECT group_id, field, unnest(CASE WHEN merged IS NULL OR list_contains(list_transform(told, lambda x: x.v), merged) THEN told ELSE list_append(told, {{'s': 'merged', 'v': merged}}) END) AS x FROM e WHERE coalesce(merged, told[1].v) IS NOT NULL),
claims AS MATERIALIZED (SELECT group_id, field, x.s AS source, trim(x.v) AS value, {said} AS said FROM v),
votes AS MATERIALIZED (SELECT group_id, field, said, source, count(*) AS n FROM claims GROUP BY ALL),
{steps}
SELECT group_id, field AS column_name, value, confidence FROM (SELECT group_id, field, value, round(confidence, 9) AS confidence, row_number() OVER (PARTITION BY group_id, field ORDER BY round(confidence, 9) DESC, said DESC, value DESC) AS rn FROM claims JOIN c{rounds - 1} USING (group_id, field, said)) WHERE rn = 1"""


_GROUPS = """r AS (SELECT *, CASE WHEN json_valid(merged_data) THEN merged_data END AS m, CASE WHEN json_valid(raw_data_by_source) THEN raw_data_by_source END AS raw, upper(trim(license_state)) AS st, nullif(upper(regexp_replace(bar_number, '[^A-Za-z0-9]', '', 'g')), '') AS bar FROM lawyer_enrichment WHERE trim(license_state) <> ''),
g AS (SELECT st, bar, min(id) AS group_id FROM r WHERE bar IS NOT NULL GROUP BY ALL HAVING count(*) > 1)"""

ORACLES = {
    "p3_truth": _truth(ROUNDS),
    "p8_checks": """
SELECT container_kind, CAST(capacity_tokens AS bigint) AS capacity, (SELECT count(*) FROM documents WHERE text <> '') AS documents, CAST(0 AS bigint) AS missing_tokens, CAST(0 AS bigint) AS split_without_need, CAST(0 AS bigint) AS over_capacity, true AS well_filled FROM container_spec""",
    "p9_checks": "SELECT source, true AS within_repeats, true AS share_reached, true AS used_whole, true AS tempered_within_repeats, true AS exponent_between FROM mix_target",
    "p7_found": _P7,
    "p3_found": f"""
WITH r AS (SELECT *, CASE WHEN json_valid(merged_data) THEN merged_data END AS m, CASE WHEN json_valid(raw_data_by_source) THEN raw_data_by_source END AS raw, upper(trim(license_state)) AS st, nullif(upper(regexp_replace(bar_number, '[^A-Za-z0-9]', '', 'g')), '') AS bar FROM lawyer_enrichment WHERE trim(license_state) <> ''),
g AS (SELECT st, bar, min(id) AS group_id FROM r WHERE bar IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
o AS ({' UNION ALL '.join(_best(f).replace(', state, bar FROM r', ', st, bar FROM r') for f in FIELDS)})
SELECT group_id, column_name, id AS from_id FROM (SELECT group_id, column_name, id, row_number() OVER (PARTITION BY group_id, column_name ORDER BY curated DESC, updated_at DESC NULLS LAST, id) AS rn FROM o JOIN g ON g.st = o.st AND g.bar = o.bar WHERE value IS NOT NULL) WHERE rn = 1""",
    "p6_found": """
WITH h AS (SELECT upper(trim(state)) AS state, city, google_place_id, google_rating, google_review_count, row_number() OVER (PARTITION BY upper(trim(state)), city, google_place_id ORDER BY discovered_at DESC NULLS LAST, discovery_id DESC) AS rn
 FROM google_discovery WHERE trim(state) <> '' AND google_rating IS NOT NULL AND NOT isnan(google_rating) AND city IS NOT NULL AND google_place_id IS NOT NULL)
SELECT state, city, google_place_id FROM (SELECT *, row_number() OVER (PARTITION BY state, city ORDER BY google_rating DESC, google_review_count DESC NULLS LAST, google_place_id) AS place FROM h WHERE rn = 1) WHERE place <= 5""",
}
