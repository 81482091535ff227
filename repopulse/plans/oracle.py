"""The same queries in SQL, written independently of the operators, for DuckDB."""

from __future__ import annotations

FORTNIGHT_START = "TIMESTAMP '2024-01-08 00:00:00'"
FORTNIGHT_END = "TIMESTAMP '2024-01-22 00:00:00'"
FIRST = "TIMESTAMP '2024-01-01 00:00:00'"
SECOND = "TIMESTAMP '2024-01-10 00:00:00'"
OPEN_END = "TIMESTAMP '9999-12-31 23:59:59'"

IN_FORTNIGHT = f"ingested_at >= {FORTNIGHT_START} AND ingested_at < {FORTNIGHT_END}"
ON_TIME = "ingested_at = date_trunc('hour', created_at)"

BRONZE = """
bronze AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
    CASE event_type WHEN 'purchase' THEN 'WatchEvent' WHEN 'signup' THEN 'ForkEvent'
      WHEN 'error' THEN 'PullRequestEvent' WHEN 'view' THEN 'IssuesEvent'
      WHEN 'click' THEN 'PushEvent' ELSE event_type END AS type,
    CASE event_type WHEN 'purchase' THEN 'started' WHEN 'error' THEN 'opened'
      WHEN 'view' THEN 'closed' END AS action,
    user_id AS actor_id,
    'user' || user_id || CASE WHEN value < 5 THEN '[bot]' ELSE '' END AS actor_login,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS repo_id,
    'owner' || user_id || '/repo' || json_extract_string(props, '$.k') AS repo_name,
    ts AS created_at,
    date_trunc('hour', ts)
      + CASE WHEN value >= 150 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS ingested_at
  FROM events
)"""

_KEPT_TYPES = "'WatchEvent', 'ForkEvent', 'PullRequestEvent', 'PushEvent', 'IssuesEvent'"
SILVER = f"""
silver AS (
  SELECT id AS event_id, repo_id, actor_id, type AS event_type, action, created_at, ingested_at
  FROM bronze
  WHERE repo_id IS NOT NULL AND actor_id IS NOT NULL
    AND type IN ({_KEPT_TYPES}) AND actor_login NOT LIKE '%[bot]'
)"""

ACTOR_META = """
actor_meta AS (
  SELECT actor_id, 'avatars/' || actor_id AS avatar_url, actor_login AS actor_display_login,
    '' AS actor_gravatar_id, actor_login, 'users/' || actor_id AS actor_url,
    created_at, ingested_at, type
  FROM bronze
)"""

REPO_META = """
repo_meta AS (
  SELECT repo_id, repo_name, 'repos/' || repo_id AS repo_url, created_at, ingested_at, type
  FROM bronze
)"""

PLACES = """
places AS (
  SELECT lower(n_name) AS token, n_name AS country, n_nationkey AS priority
  FROM nation WHERE n_name <> 'NATION_7'
  UNION ALL
  SELECT lower(r_name), r_name, r_regionkey + 100 FROM region
),
codes AS (
  SELECT n_name AS country, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code
  FROM nation
)"""


def _title(value: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({value}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def _stripped(value: str) -> str:
    without_at = f"regexp_replace({value}, '^@', '')"
    return rf"regexp_replace({without_at}, '[^\p{{L}}\p{{N}}\s\-_&,().]', '', 'g')"


def _location_words(value: str) -> str:
    spaced = rf"regexp_replace({value}, '[()\[\],]', ' ', 'g')"
    return rf"trim(regexp_replace({spaced}, '\s+', ' ', 'g'))"


def _raw_details(name: str, batch: str) -> str:
    first = batch == FIRST
    moved = "''" if first else "CASE WHEN c_acctbal < 2000 THEN ' & new!' ELSE '' END"
    condition = "WHERE c_mktsegment <> 'BUILDING'" if first else ""
    return f"""
{name} AS (
  SELECT c_custkey AS user_id, 'user' || c_custkey AS login, c_name AS name,
    '@' || lower(c_mktsegment) || ' works, inc.' || {moved} AS company,
    CASE WHEN c_acctbal >= 0
      THEN c_mktsegment || ' (near), ' || n_name || '  [' || r_name || ']' END AS location,
    CAST(c_nationkey AS BIGINT) AS followers_count,
    CAST(n_regionkey AS BIGINT) AS following_count,
    {FIRST} AS user_created_at, {batch} AS user_updated_at, {batch} AS ingested_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  {condition}
)"""


def _located(name: str, raw: str) -> str:
    return f"""
{name}_words AS (
  SELECT DISTINCT location, unnest(string_split(lower({_location_words('location')}), ' ')) AS token
  FROM {raw} WHERE location IS NOT NULL
),
{name} AS (
  SELECT location, arg_min(country, priority) AS country
  FROM {name}_words JOIN places USING (token) GROUP BY location
)"""


def _prepared(name: str, raw: str, valid_from: str) -> str:
    return f"""{_located(f'{name}_located', raw)},
{name}_cleaned AS (
  SELECT r.* REPLACE (trim({_title(_stripped('company'))}) AS company), l.country,
    coalesce(c.country_code, 'UNKNOWN') AS country_code
  FROM {raw} r LEFT JOIN {name}_located l ON r.location = l.location
  LEFT JOIN codes c ON l.country = c.country
),
{name} AS (
  SELECT *, {valid_from} AS valid_from, {OPEN_END} AS valid_to, TRUE AS is_current,
    sha256(concat_ws('|', coalesce(name, ''), coalesce(country, ''), coalesce(company, '')))
      AS hash_diff
  FROM {name}_cleaned
)"""


def _batches(first: str = FIRST, second: str = SECOND) -> str:
    return ",".join(
        [
            PLACES,
            _raw_details("raw1", FIRST),
            _raw_details("raw2", SECOND),
            _prepared("batch1", "raw1", first),
            _prepared("batch2", "raw2", second),
        ]
    )


SHOWN = "* REPLACE (strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to)"

DIMENSION = """
dimension AS (
  SELECT o.* REPLACE (
      CASE WHEN n.hash_diff <> o.hash_diff THEN n.valid_from ELSE o.valid_to END AS valid_to,
      coalesce(n.hash_diff = o.hash_diff, TRUE) AS is_current)
  FROM batch1 o LEFT JOIN batch2 n ON o.user_id = n.user_id
  UNION ALL BY NAME
  SELECT n.* FROM batch2 n LEFT JOIN batch1 o ON o.user_id = n.user_id
  WHERE o.user_id IS NULL OR n.hash_diff <> o.hash_diff
)"""


_COUNTED = {
    "star": "WatchEvent",
    "fork": "ForkEvent",
    "pr": "PullRequestEvent",
    "issues": "IssuesEvent",
    "push": "PushEvent",
}


def _counts(suffix: str, kinds: tuple[str, ...] = tuple(_COUNTED)) -> str:
    return ", ".join(
        f"CAST(count(*) FILTER (WHERE event_type = '{_COUNTED[kind]}') AS BIGINT)"
        f" AS {kind}{suffix}"
        for kind in kinds
    )


def _hourly(source: str, name: str) -> str:
    """Counts, ranks, trend of every hour of ``source``; ends in CTE ``name``."""
    return f"""
{name}_counts AS (
  SELECT repo_id, date_trunc('hour', ingested_at) AS ingested_at,
    {_counts('_count', ('star', 'fork'))}
  FROM {source} WHERE event_type IN ('WatchEvent', 'ForkEvent')
  GROUP BY ALL
),
{name}_ranked AS (
  SELECT *,
    CAST(rank() OVER (PARTITION BY ingested_at ORDER BY star_count DESC, repo_id) AS INTEGER)
      AS star_rank,
    CAST(rank() OVER (PARTITION BY ingested_at ORDER BY fork_count DESC, repo_id) AS INTEGER)
      AS fork_rank
  FROM {name}_counts
),
{name} AS (
  SELECT c.*, p.star_count AS prev_star_count, p.fork_count AS prev_fork_count,
    p.star_rank AS prev_star_rank, p.fork_rank AS prev_fork_rank,
    p.star_rank IS NULL AS is_new,
    coalesce(p.star_rank - c.star_rank, 0) AS star_trend,
    coalesce(p.fork_rank - c.fork_rank, 0) AS fork_trend
  FROM {name}_ranked c LEFT JOIN {name}_ranked p
    ON c.repo_id = p.repo_id AND p.ingested_at = c.ingested_at - INTERVAL 1 HOUR
)"""


def _named(source: str) -> str:
    return f"""SELECT p_name AS repo_name, m.*
  FROM {source} m LEFT JOIN part ON m.repo_id = p_partkey"""


def _daily(source: str) -> str:
    return f"""SELECT repo_id, CAST(created_at AS DATE) AS created_date, {_counts('_count')}
  FROM {source} GROUP BY ALL"""


def _contribution(source: str) -> str:
    return f"""SELECT repo_id, country_code, CAST(e.ingested_at AS DATE) AS created_date,
    {_counts('_event_count')}
  FROM {source} e JOIN dimension d ON e.actor_id = d.user_id
    AND e.created_at >= d.valid_from AND e.created_at < d.valid_to
    AND d.ingested_at < CAST(e.ingested_at AS DATE) + INTERVAL 1 DAY
  WHERE country_code <> 'UNKNOWN' AND country_code IS NOT NULL
  GROUP BY ALL"""


def _latest(source: str, key: str, order: list[str], condition: str = "TRUE") -> str:
    ordering = ", ".join(f"{name} DESC NULLS LAST" for name in order)
    return f"""SELECT * FROM {source} WHERE {key} IS NOT NULL AND {condition}
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {ordering}) = 1"""


ACTOR_ORDER = ["created_at", "ingested_at", "actor_display_login"]
REPO_ORDER = ["created_at", "ingested_at", "repo_name"]
BEFORE = "type IN ('PushEvent', 'PullRequestEvent')"


def _upserted(meta: str, key: str, order: list[str]) -> str:
    return f"""
old AS ({_latest(meta, key, order, BEFORE)}),
new AS ({_latest(meta, key, order, f'NOT ({BEFORE})')})
SELECT * EXCLUDE (type) FROM old
WHERE {key} NOT IN (SELECT n.{key} FROM new n JOIN old o USING ({key})
  WHERE o.created_at < n.created_at)
UNION ALL
SELECT * EXCLUDE (type) FROM new
WHERE {key} NOT IN (SELECT o.{key} FROM old o JOIN new n USING ({key})
  WHERE NOT coalesce(o.created_at < n.created_at, FALSE))"""


def _replaced(keys: str) -> str:
    return f"""
SELECT * FROM served WHERE ({keys}) NOT IN (SELECT ({keys}) FROM staged)
UNION ALL BY NAME SELECT * FROM staged"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


SERVED_SILVER = f"""
on_time AS (SELECT * FROM silver WHERE {ON_TIME}),
recounted AS (SELECT * FROM silver WHERE {IN_FORTNIGHT})"""

_SECONDS_SILVER = """
SELECT id AS event_id, repo_id, actor_id, type AS event_type, action,
  date_trunc('second', created_at) AS created_at, ingested_at"""

ORACLE: dict[str, str] = {
    "q_window_filter": f"""{_with(BRONZE)}
SELECT id, type, ingested_at FROM bronze WHERE {IN_FORTNIGHT}""",
    "q_window_counts": f"""{_with(BRONZE, SILVER)}
SELECT date_trunc('hour', ingested_at) AS ingested_at, event_type, count(*) AS n_events
FROM silver GROUP BY ALL""",
    "q_hour_gaps": f"""{_with(BRONZE)},
spine AS (
  SELECT unnest(generate_series(date_trunc('hour', min(ingested_at)),
    date_trunc('hour', max(ingested_at)), INTERVAL 1 HOUR)) AS hour FROM bronze
)
SELECT hour, 'raw/archive/' || strftime(hour, '%Y-%m-%d-%H') || '.json.gz' AS archive_key,
  strftime(hour, '%Y-%m-%d-') || extract('hour' FROM hour) || '.json.gz' AS remote_file
FROM spine
WHERE hour NOT IN (SELECT date_trunc('hour', ingested_at) FROM bronze
  WHERE type = 'WatchEvent' AND NOT ({ON_TIME}))""",
    "q_ingest_landed": f"""{_with(BRONZE)}
SELECT id, type,
  '{{' || coalesce('"action":"' || action || '",', '') || '"k":' || repo_id || '}}' AS payload_raw,
  strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at, ingested_at
FROM bronze""",
    "q_ingest_bronze": f"""{_with(BRONZE)}
SELECT id, type, actor_id, actor_login, repo_id, repo_name,
  '{{' || coalesce('"action":"' || action || '",', '') || '"k":' || repo_id || '}}' AS payload_raw,
  strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at, ingested_at
FROM bronze""",
    "q_ingest_to_silver": f"""{_with(BRONZE)}
{_SECONDS_SILVER} FROM bronze
WHERE type IN ({_KEPT_TYPES}) AND actor_login NOT LIKE '%[bot]'""",
    "q_actor_meta": f"""{_with(BRONZE, ACTOR_META)}
SELECT * EXCLUDE (type) FROM actor_meta""",
    "q_repo_meta": f"""{_with(BRONZE, REPO_META)}
SELECT * EXCLUDE (type) FROM repo_meta""",
    "q_silver_events": f"{_with(BRONZE, SILVER)} SELECT * FROM silver",
    "q_unified_events": f"{_with(BRONZE, SILVER)} SELECT * FROM silver",
    "q_dedup_latest_actor": f"""{_with(BRONZE, ACTOR_META)}
SELECT * EXCLUDE (type) FROM ({_latest('actor_meta', 'actor_id', ACTOR_ORDER)})""",
    "q_dedup_latest_repo": f"""{_with(BRONZE, REPO_META)}
SELECT * EXCLUDE (type) FROM ({_latest('repo_meta', 'repo_id', REPO_ORDER)})""",
    "q_dedup_latest_detail": f"""{_with(_raw_details('raw1', FIRST), _raw_details('raw2', SECOND))},
both_batches AS (SELECT * FROM raw1 UNION ALL BY NAME SELECT * FROM raw2)
SELECT user_id, login, company, ingested_at
FROM ({_latest('both_batches', 'user_id', ['ingested_at'])})""",
    "q_upsert_actor_master": f"{_with(BRONZE, ACTOR_META)},{_upserted('actor_meta', 'actor_id', ACTOR_ORDER)}",
    "q_upsert_repo_master": f"{_with(BRONZE, REPO_META)},{_upserted('repo_meta', 'repo_id', REPO_ORDER)}",
    "q_company_clean": f"""{_with(_raw_details('raw2', SECOND))}
SELECT user_id, {_stripped('company')} AS company_stripped,
  trim({_title(_stripped('company'))}) AS company_clean
FROM raw2""",
    "q_change_hash": f"""{_with(_raw_details('raw2', SECOND))}
SELECT user_id,
  sha256(concat_ws('|', coalesce(name, ''), coalesce(location, ''), coalesce(company, '')))
    AS hash_diff
FROM raw2""",
    "q_location_clean": f"""{_with(_raw_details('raw2', SECOND))}
SELECT user_id, {_location_words('location')} AS location FROM raw2""",
    "q_gazetteer": """
WITH named AS (
  SELECT c_custkey AS position, lower(c_mktsegment || '-' || n_regionkey) AS token, n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name <> 'NATION_7'
)
SELECT token, arg_max(country, position) AS country, min(position) AS priority
FROM named GROUP BY token""",
    "q_country_extract": f"""{_with(PLACES, _raw_details('raw2', SECOND), _located('located', 'raw2'))}
SELECT user_id, country FROM raw2 LEFT JOIN located USING (location)""",
    "q_country_code": f"""{_with(PLACES, _raw_details('raw2', SECOND), _located('located', 'raw2'))}
SELECT user_id, coalesce(country_code, 'UNKNOWN') AS country_code
FROM raw2 LEFT JOIN located USING (location) LEFT JOIN codes USING (country)""",
    "q_node_id": """
SELECT c_custkey AS user_id, base64(CAST('04:User' || c_custkey AS BLOB)) AS node_id
FROM customer""",
    "q_active_actors": f"{_with(BRONZE, SILVER)} SELECT DISTINCT actor_id FROM silver",
    "q_partition_enrich": f"""{_with(BRONZE, SILVER)}
SELECT c_custkey AS user_id, c_name AS login, CAST(NULL AS VARCHAR) AS company,
  CAST(CASE WHEN c_acctbal >= 0 THEN c_nationkey ELSE 0 END AS BIGINT) AS followers_count,
  CAST(0 AS BIGINT) AS following_count,
  CASE WHEN c_acctbal >= 5000 THEN TIMESTAMP '2021-03-04 05:06:07' END AS user_created_at
FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_custkey IN (SELECT actor_id FROM silver)""",
    "q_api_flatten": """
SELECT c_custkey AS user_id, c_name AS login, CAST(NULL AS VARCHAR) AS company,
  CAST(CASE WHEN c_acctbal >= 0 THEN c_nationkey ELSE 0 END AS BIGINT) AS followers_count,
  CAST(0 AS BIGINT) AS following_count,
  CASE WHEN c_acctbal >= 5000 THEN TIMESTAMP '2021-03-04 05:06:07' END AS user_created_at
FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
    "q_scd2_changes": f"""{_with(_batches())}
SELECT n.user_id, n.company, n.country, n.hash_diff, n.valid_from,
  CASE WHEN o.user_id IS NULL THEN 'insert' ELSE 'update' END AS change
FROM batch2 n LEFT JOIN batch1 o ON o.user_id = n.user_id
WHERE o.user_id IS NULL OR n.hash_diff <> o.hash_diff""",
    "q_scd2_apply": f"{_with(_batches(), DIMENSION)} SELECT {SHOWN} FROM dimension",
    "q_scd2_current": f"{_with(_batches(), DIMENSION)} SELECT {SHOWN} FROM dimension WHERE is_current",
    "q_scd2_late_batch": f"""{_with(_batches(), _prepared("batch3", "raw1", "TIMESTAMP '2024-01-20 00:00:00'"))},
seen AS (
  SELECT *, lag(hash_diff) OVER (PARTITION BY user_id ORDER BY valid_from) AS before,
    row_number() OVER (PARTITION BY user_id ORDER BY valid_from) AS nth
  FROM (SELECT * FROM batch1 UNION ALL BY NAME SELECT * FROM batch2
        UNION ALL BY NAME SELECT * FROM batch3)),
kept AS (SELECT * EXCLUDE (before, nth) FROM seen WHERE nth = 1 OR before <> hash_diff),
dimension AS (
  SELECT * REPLACE (
    coalesce(lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from), {OPEN_END}) AS valid_to,
    lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from) IS NULL AS is_current)
  FROM kept)
SELECT {SHOWN} FROM dimension""",
    "q_current_actor_view": f"""{_with(_batches(), DIMENSION)}
SELECT user_id, company, country, hash_diff, valid_from FROM dimension WHERE is_current""",
    "q_scd2_merge_table": f"{_with(_batches(), DIMENSION)} SELECT {SHOWN} FROM dimension",
    "q_pit_join": f"""{_with(BRONZE, SILVER, _batches(), DIMENSION)}
SELECT event_id, actor_id, created_at, company, country, valid_from
FROM silver e JOIN dimension d ON e.actor_id = d.user_id
  AND e.created_at >= d.valid_from AND e.created_at < d.valid_to""",
    "q_pit_join_orders": f"""{_with(_batches("TIMESTAMP '1996-01-01'", "TIMESTAMP '1998-01-01'"), DIMENSION)}
SELECT company, valid_from, count(*) AS n_orders
FROM orders JOIN dimension ON o_custkey = user_id
  AND o_orderdate >= valid_from AND o_orderdate < valid_to
GROUP BY ALL""",
    "q_contribution_daily": f"""{_with(BRONZE, SILVER, _batches(), DIMENSION)}
{_contribution('silver')}""",
    "q_repo_metrics_hourly_counts": f"""{_with(BRONZE, SILVER, _hourly('silver', 'hourly'))}
SELECT * FROM hourly_counts""",
    "q_rank_stars": f"""{_with(BRONZE, SILVER)},
totals AS (SELECT repo_id, {_counts('_count', ('star', 'fork'))} FROM silver GROUP BY ALL)
SELECT repo_id, star_count,
  CAST(rank() OVER (ORDER BY star_count DESC, repo_id) AS INTEGER) AS star_rank
FROM totals""",
    "q_rank_forks": f"""{_with(BRONZE, SILVER)},
totals AS (SELECT repo_id, {_counts('_count', ('star', 'fork'))} FROM silver GROUP BY ALL)
SELECT repo_id, fork_count,
  CAST(rank() OVER (ORDER BY fork_count DESC, repo_id) AS INTEGER) AS fork_rank
FROM totals""",
    "q_rank_hashed_ids": """
SELECT md5(CAST(l_partkey AS VARCHAR)) AS part_hash, count(*) AS n_lines,
  CAST(rank() OVER (ORDER BY count(*) DESC, md5(CAST(l_partkey AS VARCHAR))) AS INTEGER) AS part_rank
FROM lineitem GROUP BY l_partkey""",
    "q_rank_parts": """
WITH lines AS (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY ALL)
SELECT *, CAST(rank() OVER (ORDER BY n_lines DESC, l_partkey) AS INTEGER) AS part_rank
FROM lines""",
    "q_repo_rank_first_load": f"""{_with(BRONZE, SILVER, _hourly('silver', 'hourly'))}
SELECT *, CAST(NULL AS BIGINT) AS prev_star_count, CAST(NULL AS BIGINT) AS prev_fork_count,
  CAST(NULL AS INTEGER) AS prev_star_rank, CAST(NULL AS INTEGER) AS prev_fork_rank,
  TRUE AS is_new, 0 AS star_trend, 0 AS fork_trend
FROM hourly_ranked""",
    "q_repo_rank_trend": f"""{_with(BRONZE, SILVER, _hourly('silver', 'hourly'))}
SELECT * FROM hourly""",
    "q_repo_metrics_hourly": f"""{_with(BRONZE, SILVER, _hourly('silver', 'hourly'))}
{_named('hourly')}""",
    "q_hourly_top20": f"""{_with(BRONZE, SILVER, _hourly('silver', 'hourly'))}
SELECT repo_id, ingested_at, star_count, fork_count, star_rank
FROM hourly_ranked WHERE star_rank <= 20""",
    "q_hourly_top3": f"""{_with(BRONZE, SILVER, _hourly('silver', 'hourly'))}
SELECT repo_id, ingested_at, star_count, fork_count, star_rank
FROM hourly_ranked WHERE star_rank <= 3""",
    "q_repo_metrics_daily": f"{_with(BRONZE, SILVER)} {_daily('silver')}",
    "q_repo_metrics_daily_job": f"{_with(BRONZE, SILVER)} {_daily('silver')}",
    "q_repo_metrics_hourly_late": f"""{_with(BRONZE, SILVER, _hourly('silver', 'hourly'))}
SELECT * FROM hourly""",
    "q_repo_metrics_daily_top500": f"""{_with(BRONZE, SILVER)}
{_daily('silver')} ORDER BY star_count DESC, repo_id, created_date LIMIT 500""",
    "q_stage_daily": f"""{_with(BRONZE, SILVER)}
SELECT * FROM ({_daily('silver')}) WHERE created_date = DATE '2024-01-15'""",
    "q_stage_hourly": f"""{_with(BRONZE, SILVER, _hourly('silver', 'hourly'))}
SELECT * FROM ({_named('hourly')}) WHERE {IN_FORTNIGHT}""",
    "q_oltp_upsert_hourly": f"""{_with(BRONZE, SILVER, SERVED_SILVER,
        _hourly('on_time', 'early'), _hourly('recounted', 'recount'))},
served AS ({_named('early')}), staged AS ({_named('recount')})
{_replaced('repo_id, ingested_at')}""",
    "q_oltp_upsert_daily": f"""{_with(BRONZE, SILVER, SERVED_SILVER)},
served AS ({_daily('on_time')}), staged AS ({_daily('recounted')})
{_replaced('repo_id, created_date')}""",
    "q_serving_table_daily": f"""{_with(BRONZE, SILVER, SERVED_SILVER)},
served AS ({_daily('on_time')}), staged AS ({_daily('recounted')})
{_replaced('repo_id, created_date')}""",
    "q_oltp_upsert_contribution": f"""{_with(BRONZE, SILVER, SERVED_SILVER, _batches(), DIMENSION)},
served AS ({_contribution('on_time')}), staged AS ({_contribution('recounted')})
{_replaced('repo_id, created_date, country_code')}""",
    "q_sink_roundtrip": f"""{_with(BRONZE, SILVER)}
SELECT *, CAST(strftime(ingested_at, '%Y%m%d%H') AS INTEGER) AS ingested_hour FROM silver""",
    "q_partition_overwrite": f"""{_with(BRONZE, SILVER)}
SELECT date_trunc('hour', ingested_at) AS ingested_at, event_type, count(*) AS n_events
FROM silver WHERE {ON_TIME} OR ({IN_FORTNIGHT}) GROUP BY ALL""",
    "q_recompute_window": f"""{_with(BRONZE, SILVER)}
SELECT * FROM silver WHERE {ON_TIME}
  OR (ingested_at >= TIMESTAMP '2024-01-15 09:00:00' AND ingested_at < TIMESTAMP '2024-01-15 12:00:00')""",
    "q_schema_evolve": f"""{_with(BRONZE, SILVER)}
SELECT * REPLACE (CASE WHEN ingested_at >= {FORTNIGHT_END} THEN action END AS action) FROM silver""",
    "q_wap_publish": f"{_with(BRONZE)} SELECT id, type, created_at, ingested_at FROM bronze",
    "q_dq_report": f"""{_with(BRONZE)}
SELECT 'run-1' AS run_id, 'not_null' AS check_name, 'ingested_at' AS column_name,
  count(*) AS n_rows, CAST(count(*) - count(ingested_at) AS BIGINT) AS n_bad,
  count(*) = count(ingested_at) AS passed FROM bronze
UNION ALL
SELECT 'run-1', 'row_count', NULL, count(*), CAST(0 AS BIGINT), TRUE FROM bronze
UNION ALL
SELECT 'run-1', 'unique', 'id', CAST(coalesce(sum(n), 0) AS BIGINT),
  CAST(coalesce(sum(n) FILTER (WHERE n > 1 AND id IS NOT NULL), 0) AS BIGINT),
  coalesce(sum(n) FILTER (WHERE n > 1 AND id IS NOT NULL), 0) = 0
FROM (SELECT id, count(*) AS n FROM bronze GROUP BY id)""",
    "q_dq_report_lineitem": """
SELECT 'run-2' AS run_id, 'not_null' AS check_name, 'l_shipdate' AS column_name,
  count(*) AS n_rows, CAST(count(*) - count(l_shipdate) AS BIGINT) AS n_bad,
  count(*) = count(l_shipdate) AS passed FROM lineitem
UNION ALL
SELECT 'run-2', 'row_count', NULL, count(*),
  CAST(greatest(1 - count(*), 0) + greatest(count(*) - 1000, 0) AS BIGINT),
  count(*) BETWEEN 1 AND 1000 FROM lineitem
UNION ALL
SELECT 'run-2', 'unique', 'l_orderkey', CAST(coalesce(sum(n), 0) AS BIGINT),
  CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT),
  coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY ALL)""",
    "q_dq_duplicates": """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem
WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1""",
}
