"""Relational reports over the directory tables: joins, filtered aggregates, set operations, windows.

Each report is one SQL text that both engines read; ``{name}`` stands for a table. Catalyst plans the Spark side: filters and columns reach the
scans, fixed dimension tables are small enough to be broadcast by their size.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dossier.session import prepare, table

REPORTS: dict[str, str] = {
    # --- filtered counts, guarded ratios -------------------------------------------------------------------------
    "finds_by_source": """
        SELECT source_key, count(*) AS finds, count(*) FILTER (WHERE bar_number IS NOT NULL) AS with_licence,
               count(*) FILTER (WHERE location IS NULL) AS without_place,
               CAST(100.0 * count(*) FILTER (WHERE confidence >= 0.8) AS double) / nullif(count(confidence), 0) AS sure_pct,
               avg(confidence) FILTER (WHERE bar_number IS NOT NULL) AS avg_with_licence
        FROM {discovery_candidate} GROUP BY source_key""",
    "coverage_by_state": """
        SELECT coalesce(license_state, state, '?') AS state_code, count(*) AS profiles, count(bio) AS with_bio, count(photo_url) AS with_photo,
               count(DISTINCT firm_name) AS firms, count(*) FILTER (WHERE manually_curated) AS curated, CAST(sum(coalesce(completeness_score, 0)) AS bigint) AS points,
               min(admission_date) AS first_admitted, max(admission_date) AS last_admitted
        FROM {lawyer_enrichment} GROUP BY coalesce(license_state, state, '?')""",
    "quality_overview": """
        SELECT count(*) AS profiles, count(DISTINCT license_state) AS states, avg(CAST(completeness_score AS double)) AS avg_score, count(*) FILTER (WHERE completeness_score >= 80) AS high,
               count(*) FILTER (WHERE completeness_score < 60) AS low, max(updated_at) AS last_update, CAST(count(*) FILTER (WHERE bar_number IS NULL) AS double) / nullif(count(*), 0) AS share_without_licence
        FROM {lawyer_enrichment}""",
    "score_buckets": """
        SELECT bucket, count(*) AS profiles, avg(CAST(completeness_score AS double)) AS avg_score, CAST(sum(CASE WHEN manually_curated THEN 1 ELSE 0 END) AS bigint) AS curated
        FROM (SELECT *, CASE WHEN completeness_score < 40 THEN '0-39' WHEN completeness_score < 60 THEN '40-59' WHEN completeness_score < 80 THEN '60-79' ELSE '80-100' END AS bucket FROM {lawyer_enrichment})
        GROUP BY bucket""",
    "daily_discovery": """
        SELECT CAST(discovered_at AS date) AS day, count(*) AS hits, count(DISTINCT google_place_id) AS places, count(DISTINCT city) FILTER (WHERE google_rating >= 4) AS good_cities
        FROM {google_discovery} GROUP BY CAST(discovered_at AS date) HAVING count(*) > 1""",
    "hourly_events": """
        WITH recent AS (SELECT event_type, CAST(date_trunc('hour', ts) AS timestamp) AS hour_ts, value FROM {events} WHERE value IS NOT NULL)
        SELECT event_type, CAST(hour_ts AS date) AS day, CAST(extract(hour FROM hour_ts) AS bigint) AS hour, count(*) AS n, avg(value) AS avg_value, count(*) FILTER (WHERE value > 50) AS high
        FROM recent GROUP BY event_type, hour_ts""",
    "alerts": """
        WITH by_source AS (SELECT source_key, count(*) AS n, count(*) FILTER (WHERE location IS NULL) AS lost, count(*) FILTER (WHERE confidence < 0.5) AS weak FROM {discovery_candidate} GROUP BY source_key)
        SELECT 'no_place' AS alert, 'warning' AS severity, source_key, concat(source_key, ': ', CAST(lost AS varchar(20)), ' finds without a place') AS message FROM by_source WHERE lost > 2
        UNION ALL SELECT 'weak_finds', 'info', source_key, concat(source_key, ': ', CAST(weak AS varchar(20)), ' weak finds') FROM by_source WHERE weak > 10 AND n > 10
        UNION ALL SELECT 'unrated_state', 'error', state, concat(state, ' has no rating') FROM (SELECT upper(trim(state)) AS state FROM {google_discovery} WHERE state IS NOT NULL GROUP BY upper(trim(state)) HAVING count(google_rating) = 0)""",
    "status_lines": """
        SELECT 'profiles' AS metric, CAST(count(*) AS varchar(20)) AS value FROM {lawyer_enrichment}
        UNION ALL SELECT 'candidates', CAST(count(*) AS varchar(20)) FROM {discovery_candidate}
        UNION ALL SELECT 'places', CAST(count(DISTINCT place_id) AS varchar(20)) FROM {google_places}
        UNION ALL SELECT 'hits', CAST(count(*) AS varchar(20)) FROM {google_discovery}
        UNION ALL SELECT 'curated', CAST(count(*) FILTER (WHERE manually_curated) AS varchar(20)) FROM {lawyer_enrichment}
        UNION ALL SELECT 'parses', CAST(count(*) AS varchar(20)) FROM {parsed_name}""",
    "progress_by_level": """
        SELECT 'level 1' AS layer_name, 1 AS layer_num, count(*) AS profiles, avg(CAST(completeness_score AS double)) AS avg_score FROM {lawyer_enrichment} WHERE enrichment_level >= 1
        UNION ALL SELECT 'level 2', 2, count(*), avg(CAST(completeness_score AS double)) FROM {lawyer_enrichment} WHERE enrichment_level >= 2
        UNION ALL SELECT 'level 9', 9, count(*), avg(CAST(completeness_score AS double)) FROM {lawyer_enrichment} WHERE enrichment_level >= 9
        UNION ALL SELECT 'parsed', 3, count(DISTINCT l.id), avg(CAST(l.completeness_score AS double)) FROM {lawyer_enrichment} l JOIN {parsed_name} p ON p.lawyer_enrichment_id = l.id""",
    # --- joins ---------------------------------------------------------------------------------------------------
    "finds_with_profile": """
        SELECT c.candidate_id, c.source_key, l.id, l.full_name, l.license_state, l.completeness_score
        FROM {discovery_candidate} c JOIN {lawyer_enrichment} l ON upper(trim(c.bar_number)) = upper(trim(l.bar_number)) WHERE c.confidence IS NOT NULL""",
    "places_with_details": """
        SELECT d.google_place_id, d.city, count(*) AS hits, count(g.scrape_id) AS scrapes, max(g.google_rating) AS scraped_rating
        FROM (SELECT DISTINCT google_place_id, city FROM {google_discovery}) d LEFT JOIN {google_places} g ON g.place_id = d.google_place_id AND g.website IS NOT NULL GROUP BY d.google_place_id, d.city""",
    "stale_or_missing_details": """
        SELECT d.google_place_id, max(d.discovered_at) AS last_seen, max(g.scraped_at) AS last_scraped
        FROM {google_discovery} d LEFT JOIN {google_places} g ON g.place_id = d.google_place_id
        WHERE g.scrape_id IS NULL OR g.scraped_at < d.discovered_at - INTERVAL '30' DAY OR (g.google_rating IS NULL AND d.google_rating IS NOT NULL) GROUP BY d.google_place_id""",
    "profiles_never_parsed": """
        SELECT l.id, l.full_name FROM {lawyer_enrichment} l WHERE l.full_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parsed_name} p WHERE p.lawyer_enrichment_id = l.id AND p.last_name IS NOT NULL)""",
    "cities_without_hits": """
        SELECT c.city_id, c.city_name, c.state_code FROM {city_ref} c WHERE c.city_id NOT IN (SELECT r.city_id FROM {google_discovery} d JOIN {city_ref} r ON r.city_name = d.city AND r.state_code = upper(trim(d.state)))""",
    "light_then_full": """
        SELECT id, full_name, firm_name, CAST(length(merged_data) AS bigint) AS document_length FROM {lawyer_enrichment}
        WHERE id IN (SELECT id FROM {lawyer_enrichment} WHERE enrichment_level >= 3 AND completeness_score >= 90)""",
    "query_generation": """
        SELECT city_id, query, rn FROM (
            SELECT c.city_id, concat(a.area_name, t.word, ' in ', c.city_name, ', ', c.state_code) AS query, CAST(row_number() OVER (PARTITION BY c.city_id ORDER BY a.area_id, t.pos) AS bigint) AS rn
            FROM {city_ref} c CROSS JOIN {practice_area_ref} a CROSS JOIN (SELECT 1 AS pos, ' lawyer' AS word UNION ALL SELECT 2, ' attorney') t WHERE c.population >= 250000) q WHERE rn <= 10""",
    "city_tiers": """
        SELECT c.city_id, c.state_code, t.tier, t.queries FROM {city_ref} c
        JOIN (SELECT 'tier1' AS tier, 1000000 AS low, 2000000000 AS high, 40 AS queries UNION ALL SELECT 'tier2', 250000, 1000000, 20 UNION ALL SELECT 'tier3', 100000, 250000, 10 UNION ALL SELECT 'tier4', 0, 100000, 5) t
        ON c.population >= t.low AND c.population < t.high""",
    "latest_parse": """
        SELECT lawyer_enrichment_id, parse_id, first_name, middle_name, last_name FROM (
            SELECT *, row_number() OVER (PARTITION BY lawyer_enrichment_id ORDER BY parsed_at DESC, parse_id DESC) AS rn FROM {parsed_name}) p WHERE rn = 1""",
    "all_known_places": """
        SELECT google_place_id AS place_id FROM {google_discovery} UNION SELECT place_id FROM {google_places}""",
    "shared_places": """
        SELECT google_place_id AS place_id FROM {google_discovery} INTERSECT SELECT place_id FROM {google_places}""",
    "unscraped_places": """
        SELECT google_place_id AS place_id FROM {google_discovery} EXCEPT SELECT place_id FROM {google_places}""",
    "newest_finds": """
        SELECT candidate_id, source_key, found_at FROM {discovery_candidate} ORDER BY found_at DESC NULLS LAST, candidate_id LIMIT 50""",
    "unreviewed_first": """
        SELECT id, completeness_score, updated_at FROM {lawyer_enrichment} ORDER BY (manually_curated IS NULL), completeness_score DESC NULLS LAST, updated_at DESC, id LIMIT 100""",
    "flag_forms": """
        SELECT count(*) FILTER (WHERE manually_curated = false) AS is_false, count(*) FILTER (WHERE NOT coalesce(manually_curated, false)) AS not_true, count(*) FILTER (WHERE manually_curated IS NULL) AS unset FROM {lawyer_enrichment}""",
    "licences_with_spread": """
        SELECT license_state, upper(trim(bar_number)) AS bar, count(*) AS n, count(DISTINCT full_name) AS names, max(updated_at) AS newest
        FROM {lawyer_enrichment} WHERE bar_number IS NOT NULL AND license_state IS NOT NULL GROUP BY license_state, upper(trim(bar_number)) HAVING count(*) > 1""",
    # --- star schema ---------------------------------------------------------------------------------------------
    "pricing_summary": """
        SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS decimal(18,4))) AS double) AS sum_qty, CAST(sum(CAST(l_extendedprice AS decimal(18,4))) AS double) AS sum_price, count(*) AS n
        FROM {lineitem} WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus""",
    "revenue_by_region": """
        SELECT r.r_name, n.n_name, count(DISTINCT o.o_orderkey) AS orders, CAST(sum(CAST(o.o_totalprice AS decimal(18,4))) AS double) AS total
        FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey JOIN {nation} n ON n.n_nationkey = c.c_nationkey JOIN {region} r ON r.r_regionkey = n.n_regionkey GROUP BY r.r_name, n.n_name""",
    "customers_without_large_orders": """
        SELECT c_custkey, c_name FROM {customer} c WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 200000 AND o.o_orderstatus = 'O')""",
    "status_rollup": """
        SELECT coalesce(o_orderstatus, 'all') AS status, coalesce(o_orderpriority, 'all') AS priority, count(*) AS n FROM {orders} GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
    "latest_event_per_user": """
        SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM {events}) e WHERE rn = 1""",
    "session_gaps": """
        WITH marked AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL '30' MINUTE THEN 0 ELSE 1 END AS fresh FROM {events} WHERE user_id IS NOT NULL),
        numbered AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session FROM marked)
        SELECT user_id, CAST(session AS bigint) AS session, count(*) AS events, min(ts) AS start_ts, max(ts) AS end_ts FROM numbered GROUP BY user_id, session""",
}

_TABLE = re.compile(r"\{(\w+)\}")


def tables_of(sql: str) -> list[str]:
    return sorted(set(_TABLE.findall(sql)))


def run_sql(name: str, sql: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query of (spark, sf_dir) that runs ``sql`` over the tables that it names in braces."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables_of(sql)})

    run.__name__ = name
    return run


def without_braces(sql: str) -> str:
    return _TABLE.sub(r"\1", sql).strip()


def report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return run_sql(name, REPORTS[name])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: report(name) for name in REPORTS}


def oracle_sql() -> dict[str, str]:
    return {name: without_braces(sql) for name, sql in REPORTS.items()}
