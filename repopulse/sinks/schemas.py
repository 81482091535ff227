"""Declared columns of the lake's tables: what an empty table reads as."""

_ACTOR_META = (
    "actor_id BIGINT, avatar_url STRING, actor_display_login STRING, actor_gravatar_id STRING, "
    "actor_login STRING, actor_url STRING, created_at STRING, ingested_at TIMESTAMP_NTZ"
)
_REPO_META = (
    "repo_id BIGINT, repo_name STRING, repo_url STRING, created_at STRING, "
    "ingested_at TIMESTAMP_NTZ"
)
_ACTOR_DETAIL = (
    "user_id BIGINT, login STRING, name STRING, company STRING, location STRING, "
    "followers_count BIGINT, following_count BIGINT, user_created_at TIMESTAMP_NTZ, "
    "user_updated_at TIMESTAMP_NTZ, ingested_at TIMESTAMP_NTZ"
)
_ACTOR_ROW = f"{_ACTOR_DETAIL}, country STRING, country_code STRING"
_HOUR = "ingested_hour INT"
_BLOCK = "ingested_block INT"
_BATCH = "batch INT"

TABLE_SCHEMAS = {
    "bronze/events": (
        "id STRING, type STRING, "
        "actor STRUCT<id: BIGINT, login: STRING, display_login: STRING, gravatar_id: STRING, "
        "url: STRING, avatar_url: STRING>, "
        "repo STRUCT<id: BIGINT, name: STRING, url: STRING>, "
        "org STRUCT<id: BIGINT, login: STRING, gravatar_id: STRING, url: STRING, "
        "avatar_url: STRING>, public BOOLEAN, "
        f"created_at STRING, payload_raw STRING, ingested_at TIMESTAMP_NTZ, {_HOUR}"
    ),
    "bronze/arrivals": "ingested_at TIMESTAMP_NTZ, arrival STRING",
    "bronze/malformed_lines": f"id STRING, line STRING, ingested_at TIMESTAMP_NTZ, {_HOUR}",
    "bronze/actor_meta": f"{_ACTOR_META}, {_HOUR}",
    "bronze/repo_meta": f"{_REPO_META}, {_HOUR}",
    "bronze/actor_detail_raw": f"{_ACTOR_DETAIL}, {_HOUR}",
    "bronze/actor_fetch_log": (
        "actor_id BIGINT, status STRING, node STRING, error STRING, "
        f"ingested_at TIMESTAMP_NTZ, {_HOUR}"
    ),
    "silver/events": (
        "event_id STRING, repo_id BIGINT, actor_id BIGINT, action STRING, "
        f"created_at TIMESTAMP_NTZ, ingested_at TIMESTAMP_NTZ, event_type STRING, {_BLOCK}"
    ),
    "silver/event_dates": f"created_date DATE, {_BLOCK}, n_events BIGINT, month INT",
    "silver/actor_master": f"{_ACTOR_META}, {_BATCH}",
    "silver/repo_master": f"{_REPO_META}, {_BATCH}",
    "silver/actor_detail_scd": f"{_ACTOR_ROW}, valid_from TIMESTAMP_NTZ, hash_diff STRING, {_BATCH}",
    "gold/repo_metrics_hourly": (
        "repo_name STRING, repo_id BIGINT, ingested_at TIMESTAMP_NTZ, star_count BIGINT, "
        "fork_count BIGINT, star_rank INT, fork_rank INT, prev_star_count BIGINT, "
        "prev_fork_count BIGINT, prev_star_rank INT, prev_fork_rank INT, is_new BOOLEAN, "
        f"star_trend INT, fork_trend INT, {_BLOCK}"
    ),
    "gold/repo_metrics_daily": (
        "repo_id BIGINT, star_count BIGINT, fork_count BIGINT, pr_count BIGINT, "
        "issues_count BIGINT, push_count BIGINT, created_date DATE"
    ),
    "gold/repo_contribution_metrics_daily": (
        "repo_id BIGINT, country_code STRING, star_event_count BIGINT, fork_event_count BIGINT, "
        "pr_event_count BIGINT, issues_event_count BIGINT, push_event_count BIGINT, "
        "created_date DATE"
    ),
    "quality/results": (
        "run_id STRING, check_name STRING, column_name STRING, n_rows BIGINT, n_bad BIGINT, "
        "passed BOOLEAN, run STRING"
    ),
}
