"""Views of requests, batches and workers over the parsing log, each one query.

The log of parses stands for the queue: each parse is a request of one source for one profile, its states follow from its number, so that
every state, source and batch occurs at every size. ``clock`` is the newest time of the log, which relative times refer to; the log is
sparse, so the hourly view looks 30 days back.
Texts that the two engines write differently come as a pair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dossier.plans.reports import run_sql, without_braces

_QUEUE = """requests AS (
    SELECT parse_id AS request_id, lawyer_enrichment_id AS profile_id, CASE parse_id % 3 WHEN 0 THEN 'justia' WHEN 1 THEN 'avvo' ELSE 'google_maps' END AS source_key, CASE WHEN parse_id % 3 = 2 THEN 4 ELSE 3 END AS layer,
           CASE parse_id % 7 WHEN 1 THEN 'manual' WHEN 2 THEN 'candidates' WHEN 3 THEN 'not_found' WHEN 4 THEN 'pending' WHEN 6 THEN 'skipped' ELSE 'found' END AS discovery_status,
           CASE parse_id % 5 WHEN 0 THEN 'completed' WHEN 1 THEN 'failed' WHEN 2 THEN 'no_data' WHEN 3 THEN 'queued' ELSE 'pending' END AS scrape_status,
           CAST(parse_id % 4 AS int) AS attempts, CAST(parse_id % 6 AS int) AS priority, parsed_at AS created_at, CASE WHEN parse_id % 5 < 3 THEN parsed_at + INTERVAL '3' HOUR END AS scraped_at,
           CASE WHEN parse_id % 11 > 0 THEN parse_id % 11 END AS batch_id, CASE WHEN parse_id % 7 IN (0, 1, 5) THEN concat('https://pages.example/p-', CAST(lawyer_enrichment_id AS varchar(20)), '.html') END AS url
    FROM {parsed_name}),
clock AS (SELECT max(parsed_at) AS now_ts FROM {parsed_name}),
batches AS (
    SELECT batch_id, min(created_at) AS started_at, max(scraped_at) AS completed_at, count(*) AS total, count(*) FILTER (WHERE scrape_status = 'completed') AS processed, count(*) FILTER (WHERE scrape_status = 'failed') AS failed,
           CASE WHEN count(*) FILTER (WHERE scrape_status IN ('pending', 'queued')) > 0 THEN 'running' ELSE 'completed' END AS status
    FROM requests WHERE batch_id IS NOT NULL GROUP BY batch_id)"""
_PCT = "CAST(round(100.0 * CAST({} AS double) / nullif({}, 0), 1) AS double)"
_DISCOVERY = f"""discovery_rates AS (
    SELECT source_key, layer, count(*) AS total_requests, count(*) FILTER (WHERE discovery_status = 'found') AS found, count(*) FILTER (WHERE discovery_status = 'candidates') AS needs_review,
           count(*) FILTER (WHERE discovery_status = 'not_found') AS not_found, count(*) FILTER (WHERE discovery_status = 'pending') AS pending,
           {_PCT.format("count(*) FILTER (WHERE discovery_status = 'found')", "count(*) FILTER (WHERE discovery_status IN ('found', 'not_found', 'candidates'))")} AS success_rate_pct
    FROM requests GROUP BY source_key, layer)"""
_SCRAPING = f"""scraping_rates AS (
    SELECT source_key, layer, count(*) AS total_requests, count(*) FILTER (WHERE scrape_status = 'completed') AS completed, count(*) FILTER (WHERE scrape_status = 'failed') AS failed,
           count(*) FILTER (WHERE scrape_status = 'no_data') AS no_data, count(*) FILTER (WHERE scrape_status IN ('pending', 'queued')) AS queued,
           {_PCT.format("count(*) FILTER (WHERE scrape_status = 'completed')", "count(*) FILTER (WHERE scrape_status IN ('completed', 'failed', 'no_data'))")} AS success_rate_pct,
           avg(CAST(attempts AS double)) FILTER (WHERE scrape_status = 'completed') AS avg_attempts_success, avg(CAST(attempts AS double)) FILTER (WHERE scrape_status = 'failed') AS avg_attempts_failed
    FROM requests WHERE discovery_status IN ('found', 'manual') GROUP BY source_key, layer)"""
_COST = """daily_cost AS (
    SELECT CAST(created_at AS date) AS batch_date, count(*) FILTER (WHERE discovery_status IN ('found', 'manual')) AS find_place_calls, count(*) FILTER (WHERE scrape_status = 'completed') AS place_details_calls,
           count(DISTINCT batch_id) AS batch_count, round(CAST(count(*) FILTER (WHERE discovery_status IN ('found', 'manual')) AS double) / 1000 * 17, 2) AS find_cost,
           round(CAST(count(*) FILTER (WHERE scrape_status = 'completed') AS double) / 1000 * 17, 2) AS details_cost,
           round(CAST(count(*) FILTER (WHERE discovery_status IN ('found', 'manual')) + count(*) FILTER (WHERE scrape_status = 'completed') AS double) / 1000 * 17, 2) AS total_cost
    FROM requests CROSS JOIN clock WHERE source_key = 'google_maps' AND created_at >= now_ts - INTERVAL '30' DAY GROUP BY CAST(created_at AS date))"""
_HAS = "coalesce({} LIKE '%\"{}\"%', false)".format
_RAW = lambda source: _HAS("raw_data_by_source", source)

VIEWS: dict[str, str | tuple[str, str]] = {
    "view_discovery_rates": f"WITH {_QUEUE}, {_DISCOVERY} SELECT * FROM discovery_rates",
    "view_scraping_rates": f"WITH {_QUEUE}, {_SCRAPING} SELECT * FROM scraping_rates",
    "view_needs_review": f"""
        WITH {_QUEUE} SELECT r.request_id, l.full_name, l.bar_number, l.license_state, l.completeness_score, r.source_key, r.discovery_status, r.created_at AS request_created_at
        FROM requests r JOIN {{lawyer_enrichment}} l ON l.id = r.profile_id WHERE r.discovery_status = 'candidates'""",
    "view_field_conflicts": (
        """SELECT id, full_name, bar_number, license_state, completeness_score, manually_curated_fields AS conflicting_fields, CAST(size(coalesce(manually_curated_fields, array())) AS bigint) AS n, updated_at
        FROM {lawyer_enrichment} WHERE size(coalesce(manually_curated_fields, array())) > 0""",
        """SELECT id, full_name, bar_number, license_state, completeness_score, manually_curated_fields AS conflicting_fields, len(coalesce(manually_curated_fields, [])) AS n, updated_at
        FROM {lawyer_enrichment} WHERE len(coalesce(manually_curated_fields, [])) > 0""",
    ),
    "view_daily_cost": f"WITH {_QUEUE}, {_COST} SELECT * FROM daily_cost",
    "view_progress": f"""
        WITH {_QUEUE}, done AS (SELECT DISTINCT source_key, profile_id FROM requests WHERE scrape_status = 'completed'),
        parts AS (SELECT 'listed' AS layer_name, 1 AS layer_num, id, completeness_score AS s FROM {{lawyer_enrichment}} WHERE enrichment_level >= 1
            UNION ALL SELECT 'detailed', 2, id, completeness_score FROM {{lawyer_enrichment}} WHERE enrichment_level >= 2
            UNION ALL SELECT d.source_key, 3, l.id, l.completeness_score FROM done d JOIN {{lawyer_enrichment}} l ON l.id = d.profile_id),
        labels AS (SELECT 'listed' AS label UNION ALL SELECT 'detailed' UNION ALL SELECT 'justia' UNION ALL SELECT 'avvo' UNION ALL SELECT 'google_maps')
        SELECT label AS layer_name, max(layer_num) AS layer_num, count(id) AS profile_count, CAST(round(avg(CAST(s AS double)), 1) AS double) AS avg_completeness FROM labels LEFT JOIN parts ON layer_name = label GROUP BY label""",
    "view_worker_hours": f"""
        WITH {_QUEUE} SELECT source_key, CAST(date_trunc('hour', scraped_at) AS timestamp) AS hour_ts, count(*) AS profiles_scraped, CAST(round(avg(CAST(attempts AS double)), 2) AS double) AS avg_attempts,
               count(*) FILTER (WHERE scrape_status = 'completed') AS successful, count(*) FILTER (WHERE scrape_status = 'failed') AS failed, {_PCT.format("count(*) FILTER (WHERE scrape_status = 'completed')", "count(*)")} AS success_rate_pct,
               CAST(round(CAST(count(*) AS double) / 60, 1) AS double) AS profiles_per_minute
        FROM requests CROSS JOIN clock WHERE scraped_at IS NOT NULL AND scraped_at >= now_ts - INTERVAL '720' HOUR GROUP BY source_key, date_trunc('hour', scraped_at)""",
    "view_alerts": f"""
        WITH {_QUEUE}, {_DISCOVERY}, {_SCRAPING}, {_COST}
        SELECT 'low_discovery_rate' AS alert_type, 'warning' AS severity, source_key, concat('discovery ', CAST(success_rate_pct AS varchar(20)), ' %') AS message FROM discovery_rates WHERE success_rate_pct < 60 AND total_requests > 10
        UNION ALL SELECT 'low_scraping_rate', 'error', source_key, concat('scraping ', CAST(success_rate_pct AS varchar(20)), ' %') FROM scraping_rates WHERE success_rate_pct < 90 AND total_requests > 10
        UNION ALL SELECT 'cost', 'error', 'google_maps', concat('spent ', CAST(total_cost AS varchar(20))) FROM daily_cost CROSS JOIN clock WHERE batch_date = CAST(now_ts AS date) AND total_cost > 50
        UNION ALL SELECT 'backlog', 'info', source_key, concat(CAST(count(*) AS varchar(20)), ' wait for review') FROM requests WHERE discovery_status = 'candidates' GROUP BY source_key HAVING count(*) > 20""",
    "view_funnel": f"""
        SELECT coalesce(license_state, state) AS state_code, count(*) FILTER (WHERE {_RAW('google_discovery')}) AS discovered, count(*) FILTER (WHERE {_HAS('merged_data', 'phone')}) AS selected,
               count(*) FILTER (WHERE {_RAW('justia')} OR {_RAW('counselpages')}) AS enriched, count(*) FILTER (WHERE ready_for_promotion) AS ready_for_promotion,
               count(*) FILTER (WHERE NOT coalesce(promotion_blocked, false) AND promotion_blocked IS NOT NULL) AS unblocked
        FROM {{lawyer_enrichment}} GROUP BY coalesce(license_state, state)""",
    "view_quality": f"""
        SELECT CAST(round(100.0 * CAST(count(*) FILTER (WHERE {_HAS('merged_data', 'phone')}) AS double) / nullif(count(*) FILTER (WHERE {_RAW('state_bar')}), 0), 2) AS double) AS selection_rate_pct,
               CAST(round(100.0 * CAST(count(*) FILTER (WHERE ready_for_promotion) AS double) / nullif(count(*), 0), 2) AS double) AS pass_rate_pct, CAST(round(avg(CAST(completeness_score AS double)), 2) AS double) AS avg_completeness
        FROM {{lawyer_enrichment}} WHERE {_HAS('merged_data', 'full_name')}""",
    "view_state_stats": """
        SELECT license_state, count(*) AS total_profiles, CAST(round(avg(CAST(completeness_score AS double)), 2) AS double) AS avg_completeness, count(*) FILTER (WHERE completeness_score >= 80) AS ready,
               count(*) FILTER (WHERE completeness_score < 40) AS needs_enrichment, count(*) FILTER (WHERE promotion_blocked) AS blocked
        FROM {lawyer_enrichment} GROUP BY license_state""",
    "view_batches": f"WITH {_QUEUE} SELECT * FROM batches ORDER BY started_at DESC, batch_id LIMIT 50",
    "view_job_seconds": (
        f"WITH {_QUEUE} SELECT batch_id, status, CAST(round(unix_timestamp(coalesce(completed_at, now_ts)) - unix_timestamp(started_at)) AS bigint) AS duration_seconds FROM batches CROSS JOIN clock ORDER BY started_at DESC, batch_id LIMIT 100",
        f"WITH {_QUEUE} SELECT batch_id, status, CAST(floor(epoch(coalesce(completed_at, now_ts))) - floor(epoch(started_at)) AS bigint) AS duration_seconds FROM batches CROSS JOIN clock ORDER BY started_at DESC, batch_id LIMIT 100",
    ),
    "view_review_backlog": f"""
        WITH {_QUEUE} SELECT source_key, count(*) AS waiting, min(created_at) AS oldest, max(attempts) AS most_attempts FROM requests WHERE discovery_status = 'candidates' GROUP BY source_key""",
    "view_workers": (
        f"""WITH {_QUEUE}, beats AS (SELECT source_key AS worker, max(created_at) AS last_beat FROM requests GROUP BY source_key)
        SELECT worker, CASE WHEN unix_timestamp(now_ts) - unix_timestamp(last_beat) <= 90 THEN 'RUNNING' ELSE 'STOPPED' END AS state, date_format(last_beat, 'yyyy-MM-dd HH:mm') AS seen FROM beats CROSS JOIN clock""",
        f"""WITH {_QUEUE}, beats AS (SELECT source_key AS worker, max(created_at) AS last_beat FROM requests GROUP BY source_key)
        SELECT worker, CASE WHEN floor(epoch(now_ts)) - floor(epoch(last_beat)) <= 90 THEN 'RUNNING' ELSE 'STOPPED' END AS state, strftime(last_beat, '%Y-%m-%d %H:%M') AS seen FROM beats CROSS JOIN clock""",
    ),
    "view_overview": """
        SELECT count(*) AS total, CAST(round(avg(CAST(completeness_score AS double)), 2) AS double) AS average, count(*) FILTER (WHERE completeness_score >= 80) AS high, count(*) FILTER (WHERE completeness_score < 60) AS low,
               count(DISTINCT license_state) AS states, max(updated_at) AS last_update FROM {lawyer_enrichment}""",
    "view_usage_today": f"""
        WITH {_QUEUE}, used AS (SELECT count(*) FILTER (WHERE discovery_status IN ('found', 'manual')) AS find_calls, count(*) FILTER (WHERE scrape_status = 'completed') AS detail_calls
            FROM requests CROSS JOIN clock WHERE source_key = 'google_maps' AND CAST(created_at AS date) = CAST(now_ts AS date))
        SELECT find_calls, detail_calls, find_calls + detail_calls AS total_calls, round(CAST(find_calls + detail_calls AS double) * 0.017, 2) AS estimated_cost, greatest(50 - (find_calls + detail_calls), 0) AS remaining_calls FROM used""",
    "view_ready_sample": "SELECT id, full_name, license_state, completeness_score FROM {lawyer_enrichment} WHERE ready_for_promotion AND promotion_blocked = false ORDER BY completeness_score DESC NULLS LAST, id LIMIT 20",
    "view_needs_enrichment": "SELECT license_state, count(*) AS profiles FROM {lawyer_enrichment} WHERE completeness_score < 40 AND license_state IS NOT NULL GROUP BY license_state",
    # --- the queue as a dataflow --------------------------------------------------------------------------------------
    "queue_to_discover": f"""
        WITH {_QUEUE} SELECT r.request_id, r.source_key, l.full_name, l.city FROM requests r JOIN {{lawyer_enrichment}} l ON l.id = r.profile_id
        WHERE r.discovery_status = 'pending' AND r.attempts < 3 AND r.source_key = 'justia' ORDER BY r.priority DESC, r.created_at, r.request_id LIMIT 20""",
    "queue_to_scrape": f"""
        WITH {_QUEUE} SELECT request_id, source_key, url FROM requests WHERE scrape_status IN ('pending', 'queued') AND url IS NOT NULL AND url LIKE 'https://%' AND url NOT LIKE 'https://other%' AND attempts < 3 ORDER BY priority DESC, created_at, request_id LIMIT 10""",
    "queue_one_request": f"""
        WITH {_QUEUE} SELECT r.request_id, l.full_name, CASE WHEN r.url IS NULL THEN 'no_url' WHEN r.scrape_status NOT IN ('pending', 'queued') THEN 'not_waiting' END AS not_processable
        FROM requests r JOIN {{lawyer_enrichment}} l ON l.id = r.profile_id WHERE r.request_id = (SELECT min(request_id) FROM requests)""",
    "queue_after_failures": f"""
        WITH {_QUEUE} SELECT request_id, attempts + 1 AS attempts, CASE WHEN attempts + 1 >= 3 THEN 'failed' ELSE 'pending' END AS scrape_status FROM requests WHERE scrape_status = 'failed'""",
    "queue_batch_counters": f"""
        WITH {_QUEUE} SELECT batch_id, processed, failed, total, CAST(round(100.0 * CAST(processed + failed AS double) / nullif(total, 0), 2) AS double) AS progress_pct, status FROM batches""",
    "queue_sweep_slots": """
        SELECT c.state_code, c.city_name, coalesce(d.hits, 0) AS found, CASE WHEN d.last_seen IS NULL OR d.last_seen < x.now_ts - INTERVAL '30' DAY THEN true ELSE false END AS due
        FROM {city_ref} c LEFT JOIN (SELECT upper(trim(state)) AS st, city, count(*) AS hits, max(discovered_at) AS last_seen FROM {google_discovery} GROUP BY upper(trim(state)), city) d ON d.st = c.state_code AND d.city = c.city_name
        CROSS JOIN (SELECT max(discovered_at) AS now_ts FROM {google_discovery}) x""",
    "queue_requests_upserted": f"""
        WITH {_QUEUE}, wanted AS (SELECT l.id AS profile_id, s.source_key, 5 AS priority FROM {{lawyer_enrichment}} l CROSS JOIN (SELECT 'justia' AS source_key UNION ALL SELECT 'avvo') s WHERE l.full_name IS NOT NULL),
        old AS (SELECT profile_id, source_key, max(priority) AS priority FROM requests GROUP BY profile_id, source_key)
        SELECT coalesce(o.profile_id, w.profile_id) AS profile_id, coalesce(o.source_key, w.source_key) AS source_key, CASE WHEN w.profile_id IS NULL THEN 'kept' WHEN o.profile_id IS NULL THEN 'inserted' ELSE 'reset' END AS outcome, greatest(o.priority, w.priority) AS priority
        FROM old o FULL OUTER JOIN wanted w ON o.profile_id = w.profile_id AND o.source_key = w.source_key""",
    # --- orders and sets ----------------------------------------------------------------------------------------------
    "towns_by_size": "SELECT city_id, city_name, population FROM {city_ref} WHERE state_code = 'CA' ORDER BY population DESC, city_name LIMIT 25",
    "states_in_listed_order": (
        "SELECT city_id, state_code FROM {city_ref} WHERE array_position(array('NY', 'CA', 'TX'), state_code) > 0 ORDER BY array_position(array('NY', 'CA', 'TX'), state_code), city_id LIMIT 40",
        "SELECT city_id, state_code FROM {city_ref} WHERE list_position(['NY', 'CA', 'TX'], state_code) > 0 ORDER BY list_position(['NY', 'CA', 'TX'], state_code), city_id LIMIT 40",
    ),
    "counts_side_by_side": "SELECT (SELECT count(*) FROM {lawyer_enrichment}) AS profiles, (SELECT count(*) FROM {parsed_name}) AS parses, (SELECT count(*) FROM {discovery_candidate}) AS finds",
    "prefixes_of_two_letters": (
        "SELECT concat(a.c, b.c) AS prefix FROM (SELECT chr(97 + i) AS c FROM (SELECT explode(sequence(0, 25)) AS i)) a CROSS JOIN (SELECT chr(97 + i) AS c FROM (SELECT explode(sequence(0, 25)) AS i)) b",
        "SELECT chr(CAST(97 + a.i AS int)) || chr(CAST(97 + b.i AS int)) AS prefix FROM range(26) a(i) CROSS JOIN range(26) b(i)",
    ),
    "layers_united": (
        "SELECT license_state, array_sort(array_distinct(flatten(collect_list(enrichment_layers)))) AS layers, bool_or(arrays_overlap(enrichment_layers, array('google_places', 'justia'))) AS known FROM {lawyer_enrichment} GROUP BY license_state",
        "SELECT license_state, list_sort(list_distinct(flatten(list(enrichment_layers)))) AS layers, bool_or(list_has_any(enrichment_layers, ['google_places', 'justia'])) AS known FROM {lawyer_enrichment} GROUP BY license_state",
    ),
}


def view(name: str) -> Callable[[SparkSession, str], DataFrame]:
    text = VIEWS[name]
    return run_sql(name, text if isinstance(text, str) else text[0])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: view(name) for name in VIEWS}


def oracle_sql() -> dict[str, str]:
    return {name: without_braces(text if isinstance(text, str) else text[1]) for name, text in VIEWS.items()}
