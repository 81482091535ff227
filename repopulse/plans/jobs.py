"""The hourly and daily jobs: operators chained over a lake, one window at a time.

Every job may run again for the same window with the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from repopulse.functions.timeframes import (
    HOUR,
    Interval,
    contiguous,
    floor_to,
    hour_key,
    hour_key_of,
    ntz_literal,
    parse_utc,
)
from repopulse.operators import metrics
from repopulse.operators.actors import prepare_actor_details
from repopulse.operators.enrich import (
    FAILED,
    REQUEST_PARTITIONS,
    REQUEST_SIZE,
    REQUESTS_IN_FLIGHT,
    Lookup,
    best_answers,
    fetch_nodes,
    fetch_summary,
    flatten_nodes,
)
from repopulse.operators.events import (
    EVENT_TABLES,
    actor_attributes,
    repo_attributes,
    typed_events,
)
from repopulse.operators.latest import latest_per_key
from repopulse.operators.quality import (
    EVENT_CHECKS,
    Check,
    QualityError,
    failed_checks,
    observed,
    run_checks,
)
from repopulse.operators.rank import rank_trend, with_star_and_fork_ranks
from repopulse.sinks.keyed import (
    compact,
    compact_dimension,
    create_current_view,
    read_dimension,
    read_keyed,
    scd2_merge_table,
    upsert_table,
)
from repopulse.sinks.lake import BLOCK_HOURS, BLOCK_PARTITION, Lake
from repopulse.sinks.serving import (
    JdbcTarget,
    merge_statements,
    run_statements,
    stage,
    staged_day,
    staged_window,
    upsert_served,
)
from repopulse.sources.archive import (
    ARCHIVE_NAME,
    FILE_PATH,
    archive_path,
    as_bronze,
    hour_in_path,
    hours_of_interval,
    malformed,
    missing_hours,
    read_raw_events,
    well_formed,
)
from repopulse.streaming.landing import landed_files
from repopulse.streaming.microbatch import (
    LATE_HOURS,
    previous_hour,
    recompute_interval,
    replace_window,
)

BRONZE_EVENTS = "bronze/events"
MALFORMED = "bronze/malformed_lines"
ARRIVALS = "bronze/arrivals"
ACTOR_META = "bronze/actor_meta"
REPO_META = "bronze/repo_meta"
ACTOR_DETAIL_RAW = "bronze/actor_detail_raw"
ACTOR_FETCH_LOG = "bronze/actor_fetch_log"
SILVER_EVENTS = "silver/events"
EVENT_DATES = "silver/event_dates"
ACTOR_MASTER = "silver/actor_master"
REPO_MASTER = "silver/repo_master"
ACTOR_DETAIL = "silver/actor_detail_scd"
# The view of current actors in the session's catalog.
CURRENT_ACTORS = "current_actor_detail"
MASTER_KEYS = {ACTOR_MASTER: "actor_id", REPO_MASTER: "repo_id"}
REPO_HOURLY = "gold/repo_metrics_hourly"
REPO_DAILY = "gold/repo_metrics_daily"
CONTRIBUTION_DAILY = "gold/repo_contribution_metrics_daily"
QUALITY_RESULTS = "quality/results"


# -- ingest ----------------------------------------------------------------------


def _counted(df: DataFrame, **totals: Column) -> tuple[DataFrame, Observation]:
    """Count rows (or other totals) while they are written, without another pass."""
    seen = Observation()
    totals = totals or {"rows": F.count(F.lit(1))}
    return df.observe(seen, *[total.alias(name) for name, total in totals.items()]), seen


def ingest_hour(lake: Lake, source_path: str | list[str], interval_start: str) -> int:
    """One raw hour into bronze; returns the row count, taken while writing.

    An archive file is read by one task and becomes one file of its hour: the
    payloads are never shuffled. Lines that are no JSON object go to a side table.
    The hour is noted as arrived until silver and gold have taken it up.
    """
    stamp = ntz_literal(parse_utc(interval_start))
    return _ingest(lake, read_raw_events(lake.spark, source_path), stamp, [stamp])["n_rows"]


def _ingest(lake: Lake, raw: DataFrame, stamp: Column, hours: list[Column]) -> dict[str, int]:
    """Raw lines into bronze under the hours ``stamp`` gives; what the checks count, taken
    while writing."""
    bronze, seen = observed(as_bronze(well_formed(raw), stamp), EVENT_CHECKS)
    lake.overwrite_hours(bronze.drop(FILE_PATH), BRONZE_EVENTS, balance=False)
    bad_lines = malformed(raw.withColumn("ingested_at", stamp)).select("id", "line", "ingested_at")
    lake.overwrite_hours(bad_lines, MALFORMED, balance=False)
    arrived = lake.spark.range(1).select(F.explode(F.array(*hours)).alias("ingested_at"))
    lake.replace_partition(arrived, ARRIVALS, f"arrival={uuid4().hex}")
    return seen.get


def check_events(
    lake: Lake,
    interval: Interval,
    run_id: str,
    checks: Iterable[Check] = EVENT_CHECKS,
    mode: str = "fail",
    seen: dict[str, int] | None = None,
) -> list[str]:
    """Run the checks on a bronze window and keep the report; ``fail`` mode raises on a failure.

    ``seen`` holds what was counted while the window was written.
    """
    if mode not in ("fail", "warn"):
        raise ValueError(f"mode must be fail or warn, not {mode!r}")
    window = lake.read_window(BRONZE_EVENTS, interval.aligned("hour"))
    report = run_checks(window, tuple(checks), run_id, seen).withColumn("run", F.lit(run_id))
    # One partition per run: running it again replaces its report.
    lake.overwrite_partitions(report, QUALITY_RESULTS, ["run"])
    failures = failed_checks(lake.read_partition(QUALITY_RESULTS, f"run={run_id}"))
    if failures and mode == "fail":
        raise QualityError("; ".join(failures))
    return failures


def _gated(lake: Lake, raw: DataFrame, stamp: Column, hours: list[datetime], run_id: str) -> int:
    """Write, audit, publish: the hours land in a side folder and are moved in if all checks pass.

    Nulls and rows are counted by the write; the audit reads the ids alone.
    """
    staged = lake.staging(f"ingest-{run_id}")
    staged.discard()
    seen = _ingest(staged, raw, stamp, [ntz_literal(hour) for hour in hours])
    whole = Interval(min(hours), max(hours) + HOUR)
    check_events(staged, whole, run_id, seen=seen)
    lake.publish(staged, [BRONZE_EVENTS, MALFORMED, QUALITY_RESULTS, ARRIVALS])
    staged.discard()
    return seen["n_rows"]


def ingest_hour_gated(
    lake: Lake, source_path: str | list[str], interval_start: str, run_id: str
) -> int:
    """One raw hour, published if all checks pass; returns the row count."""
    hour = parse_utc(interval_start)
    raw = read_raw_events(lake.spark, source_path)
    return _gated(lake, raw, ntz_literal(hour), [hour], run_id)


def ingest_landed(
    lake: Lake,
    folder: str,
    progress: str,
    run_id: str,
    files_at_once: int = 168,
    names: tuple[str, str] = ARCHIVE_NAME,
) -> int:
    """Every archive file of a folder that was not ingested yet, through the gate, once.

    A file stream lists the folder and keeps in ``progress`` which files are done;
    each batch is one gated ingest of its hours. A batch that broke off is repeated with the
    same files, and replaces its hours. Returns the row count.
    """
    rows = 0

    def take(batch: DataFrame, number: int) -> None:
        nonlocal rows
        files = batch.select("path", hour_in_path("path", names).alias("hour")).collect()
        if unnamed := [file.path for file in files if file.hour is None]:
            raise ValueError(f"no hour in the name of {unnamed[:3]}")
        if files:
            raw = read_raw_events(lake.spark, [file.path for file in files], with_path=True)
            stamp = hour_in_path(FILE_PATH, names)
            hours = sorted({file.hour for file in files})
            rows += _gated(lake, raw, stamp, hours, f"{run_id}-{number}")

    landed_files(lake.spark, folder, progress, files_at_once, take)
    return rows


def hours_to_load(lake: Lake, interval: Interval) -> list[str]:
    """Starts of the interval's hours that bronze does not hold, in order."""
    landed = lake.read_window(BRONZE_EVENTS, interval.aligned("hour")).select("ingested_at")
    missing = missing_hours(hours_of_interval(lake.spark, interval), landed)
    return [row.hour.isoformat() for row in missing.orderBy("hour").collect()]


def load_missing_hours(lake: Lake, folder: str, interval: Interval, run_id: str) -> int:
    """Ingest every hour of the interval that is not there yet; returns the row count."""
    return sum(
        ingest_hour_gated(lake, archive_path(parse_utc(hour), folder), hour, f"{run_id}-{n}")
        for n, hour in enumerate(hours_to_load(lake, interval))
    )


def _extract_meta(
    lake: Lake, interval: Interval, attributes: Callable[[DataFrame], DataFrame], table: str
) -> int:
    meta = attributes(lake.read_window(BRONZE_EVENTS, interval.aligned("hour")))
    meta, seen = _counted(meta)
    lake.overwrite_hours(meta, table)
    return seen.get["rows"]


def extract_actor_meta(lake: Lake, interval: Interval) -> int:
    """Actor attributes of the window's events; returns how many rows."""
    return _extract_meta(lake, interval, actor_attributes, ACTOR_META)


def extract_repo_meta(lake: Lake, interval: Interval) -> int:
    """Repo attributes of the window's events; returns how many rows."""
    return _extract_meta(lake, interval, repo_attributes, REPO_META)


# -- silver ----------------------------------------------------------------------


def _load_master(lake: Lake, interval: Interval, meta: str, master: str) -> None:
    key = MASTER_KEYS[master]
    hours = interval.aligned("hour")
    latest = latest_per_key(lake.read_window(meta, hours), key, ["created_at", "ingested_at"])
    upsert_table(lake, latest, master, hour_key_of(hours.start), key)


def load_actor_master(lake: Lake, interval: Interval) -> None:
    _load_master(lake, interval, ACTOR_META, ACTOR_MASTER)


def load_repo_master(lake: Lake, interval: Interval) -> None:
    _load_master(lake, interval, REPO_META, REPO_MASTER)


def transform_silver_events(
    lake: Lake,
    interval: Interval,
    event_types: Iterable[str] = tuple(EVENT_TABLES),
    late_hours: int = LATE_HOURS,
) -> None:
    """Typed events of the window and the late hours before it.

    All types share one table, so bronze is read once for all of them; each typed
    table is a slice of it.
    """
    window = recompute_interval(interval, late_hours)
    write_silver(lake, typed_events(lake.read_window(BRONZE_EVENTS, window), event_types), window)


def write_silver(lake: Lake, events: DataFrame, window: Interval) -> None:
    """Make the window's hours of silver hold ``events``, and note the days they were created on.

    The note, a row per folder and creation date in a file a month, is what finds all
    events of a date later, however late some of them came.
    """
    replace_window(lake, events, SILVER_EVENTS, window, ["event_type"])
    keys = window.hour_keys(BLOCK_HOURS)
    block = F.col(BLOCK_PARTITION)
    inside = block.between(keys[0], keys[-1])
    month = F.expr(f"{BLOCK_PARTITION} div 10000").cast("int")
    noted = (
        lake.read_keys(SILVER_EVENTS, keys)
        .groupBy(
            F.to_date("created_at").alias("created_date"),
            hour_key("ingested_at", BLOCK_HOURS).alias(BLOCK_PARTITION),
        )
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    months = sorted({key // 10000 for key in keys})
    others = lake.read(EVENT_DATES).where(F.col("month").isin(months) & ~inside).drop("month")
    aside = lake.staging(f"dates-{keys[0]}-{keys[-1]}")
    aside.discard()
    notes = noted.unionByName(others).withColumn("month", month)
    aside.overwrite_partitions(notes, EVENT_DATES, ["month"])
    lake.replace_partitions(aside, EVENT_DATES, [f"month={m}" for m in months])


def events_of_type(lake: Lake, event_type: str) -> DataFrame:
    """One typed event table: a slice of the shared one."""
    return lake.read(SILVER_EVENTS).where(F.col("event_type") == event_type).drop(BLOCK_PARTITION)


def register_event_views(lake: Lake) -> None:
    """``unified_events`` and the five typed tables as temporary views."""
    lake.read(SILVER_EVENTS).drop(BLOCK_PARTITION).createOrReplaceTempView("unified_events")
    for event_type, table in EVENT_TABLES.items():
        events_of_type(lake, event_type).createOrReplaceTempView(table.split("/")[-1])


def read_master(lake: Lake, master: str, only: DataFrame | None = None) -> DataFrame:
    """The newest row of each actor or repo, or of those in ``only``."""
    return read_keyed(lake, master, MASTER_KEYS[master], "created_at", only)


def compact_masters(lake: Lake) -> None:
    """Fold the hourly batches of both masters; run by schedule, at any time."""
    for master, key in MASTER_KEYS.items():
        compact(lake, master, key, "created_at")


# -- actor details -----------------------------------------------------------------


def fetch_actor_details(
    lake: Lake,
    target: str,
    lookup: Lookup,
    *,
    partitions: int = REQUEST_PARTITIONS,
    request_size: int = REQUEST_SIZE,
    in_flight: int = REQUESTS_IN_FLIGHT,
) -> dict[str, int]:
    """Look up the actors active in the target hour; returns how many were found, missing, failed.

    Answers are written first and read back, so the source is asked once. Run
    again, it asks only for actors without an answer.
    """
    hour = Interval.hour(target)
    stamp = ntz_literal(hour.start)
    answered = lake.read_window(ACTOR_FETCH_LOG, hour).where(F.col("status") != FAILED)
    active = metrics.active_actors(lake.read_window(SILVER_EVENTS, hour))
    asked = active.join(answered.select("actor_id"), "actor_id", "left_anti")
    answers = fetch_nodes(
        asked, lookup, partitions=partitions, request_size=request_size, in_flight=in_flight
    )
    lake.append_hours(answers.withColumn("ingested_at", stamp), ACTOR_FETCH_LOG)
    kept = best_answers(lake.read_window(ACTOR_FETCH_LOG, hour))
    lake.overwrite_hours(flatten_nodes(kept).withColumn("ingested_at", stamp), ACTOR_DETAIL_RAW)
    return {row.status: row.n_actors for row in fetch_summary(kept).collect()}


def merge_actor_dimension(lake: Lake, target: str, places: DataFrame, codes: DataFrame) -> None:
    """Details loaded in the target hour into the actor dimension, valid from the target time.

    Hours may come in any order and more than once.
    """
    raw = lake.read_window(ACTOR_DETAIL_RAW, Interval.hour(target))
    batch = prepare_actor_details(raw, places, codes, parse_utc(target))
    scd2_merge_table(lake, batch, ACTOR_DETAIL, hour_key_of(Interval.hour(target).start))
    create_current_view(lake, ACTOR_DETAIL, CURRENT_ACTORS)


def register_actor_view(lake: Lake, name: str = "actor_detail") -> DataFrame:
    """Current actor versions as a temporary view."""
    current = read_dimension(lake, ACTOR_DETAIL).where("is_current")
    current.createOrReplaceTempView(name)
    return current


def compact_actor_dimension(lake: Lake, before: str) -> None:
    """Fold the hours before ``before`` to their versions; hours older than that are not
    merged in full any more. Run by schedule."""
    compact_dimension(lake, ACTOR_DETAIL, "user_id", hour_key_of(Interval.hour(before).start))


# -- gold ------------------------------------------------------------------------


def update_repo_metrics_hourly(lake: Lake, interval: Interval) -> dict[str, int]:
    """Counts, ranks and movement for every hour of the interval; returns stars and forks seen."""
    window = interval.aligned("hour")
    counts = metrics.hourly_star_fork_counts(lake.read_window(SILVER_EVENTS, window))
    # Only the hours' repos are looked up: the rest of the master stays out of the shuffle.
    names = read_master(lake, REPO_MASTER, only=counts.select("repo_id"))
    ranked = metrics.with_repo_names(with_star_and_fork_ranks(counts), names)
    previous = previous_hour(lake, REPO_HOURLY, window).select(*ranked.columns)
    if window.end - window.start > HOUR:
        previous = previous.unionByName(ranked)
    busiest_first = [F.col("star_count").desc(), F.col("fork_count").desc()]
    result, seen = _counted(
        rank_trend(ranked, previous),
        stars=F.coalesce(F.sum("star_count"), F.lit(0)),
        forks=F.coalesce(F.sum("fork_count"), F.lit(0)),
    )
    replace_window(lake, result, REPO_HOURLY, window, busiest_first)
    return seen.get


def update_repo_metrics_daily(
    lake: Lake, interval: Interval, top: int | None = metrics.DAILY_TOP
) -> list[date]:
    """The most starred repos of each creation date, complete.

    The dates are those of the events ingested in the interval, so a late event
    brings its earlier date up again. Each date is counted over all its events,
    whenever they were ingested; of silver only the folders that hold such events are
    read. ``top=None`` keeps every repo. Returns the dates.
    """
    days = interval.aligned("day")
    noted = lake.read(EVENT_DATES).where(F.col("created_date").isNotNull())
    arrived = noted.where(F.col(BLOCK_PARTITION).isin(days.hour_keys(BLOCK_HOURS)))
    # One row per day that the interval's events were created on.
    dates = sorted(row.created_date for row in arrived.select("created_date").distinct().collect())
    if not dates:
        return []
    folders = noted.where(F.col("created_date").isin(dates)).select(BLOCK_PARTITION).distinct()
    events = lake.read_keys(SILVER_EVENTS, [row[0] for row in folders.collect()])
    events = events.where(F.to_date("created_at").isin(dates))
    daily = metrics.daily_repo_metrics(events)
    result = daily if top is None else metrics.top_repos_each_day(daily, top)
    lake.overwrite_partitions(result, REPO_DAILY, ["created_date"])
    return dates


def update_contribution_daily(lake: Lake, interval: Interval) -> None:
    """Per-country activity for every day of the interval."""
    days = interval.aligned("day")
    events = lake.read_window(SILVER_EVENTS, days)
    active = metrics.active_actors(events).select(F.col("actor_id").alias("user_id"))
    result = metrics.daily_country_contributions(
        events, read_dimension(lake, ACTOR_DETAIL, only=active)
    )
    lake.overwrite_partitions(result, CONTRIBUTION_DAILY, ["created_date"])


# -- serving -----------------------------------------------------------------------


def stage_hourly(
    lake: Lake, interval: Interval, target: JdbcTarget, table: str = "repo_metrics_hourly_staging"
) -> None:
    gold = lake.read_window(REPO_HOURLY, interval.aligned("hour"))
    stage(staged_window(gold, interval.aligned("hour")), target, table)


def stage_daily(
    lake: Lake, source: str, day: str, target: JdbcTarget, table: str, column: str = "created_date"
) -> None:
    on = floor_to(parse_utc(day), "day").date()
    stage(staged_day(lake.read(source), on, column), target, table)


def merge_staged(lake: Lake, table: str, target: JdbcTarget) -> None:
    """Upsert ``<table>_staging`` into ``table`` on the serving database, then drop it."""
    run_statements(lake.spark, target, merge_statements(table))


def serve_hourly(lake: Lake, interval: Interval) -> None:
    """Upsert the window's hourly metrics into the serving table kept in the lake."""
    gold = lake.read_window(REPO_HOURLY, interval.aligned("hour"))
    upsert_served(lake, gold, "repo_metrics_hourly")


def serve_daily(lake: Lake, *days: str | date) -> None:
    """Upsert the days' metrics and contributions into the serving tables kept in the lake."""
    dates = [floor_to(parse_utc(str(day)), "day").date() for day in days]
    for source in (REPO_DAILY, CONTRIBUTION_DAILY):
        rows = lake.read(source).where(F.col("created_date").isin(dates))
        upsert_served(lake, rows, source.split("/")[-1])


# -- chains ------------------------------------------------------------------------


def arrivals(lake: Lake) -> dict[str, list[datetime]]:
    """Hours that bronze took in and silver and gold have yet to follow, by arrival."""
    opened: dict[str, list[datetime]] = {}
    for row in lake.read(ARRIVALS).orderBy("ingested_at").collect():
        opened.setdefault(row.arrival, []).append(row.ingested_at)
    return opened


def take_up(lake: Lake, interval: Interval, late_hours: int = LATE_HOURS) -> list[Interval]:
    """Bring silver, hourly gold and serving up to date; returns the stretches recomputed.

    These are the interval with the late hours before it and every hour that arrived since
    the last run, however old it is. The hour after a stretch goes with it, for its trend. An
    arrival counts as open until all is done, so a run that breaks off is made up for.
    """
    opened = arrivals(lake)
    window = recompute_interval(interval, late_hours)
    hours = [Interval.hour(at) for arrived in opened.values() for at in arrived]
    for hour in contiguous(hours, joined=False):
        for step in (extract_actor_meta, extract_repo_meta, load_actor_master, load_repo_master):
            step(lake, hour)
    done = []
    for stretch in contiguous([window, *hours]):
        transform_silver_events(lake, stretch, late_hours=0)
        followed = Interval(stretch.start, stretch.end + HOUR)
        update_repo_metrics_hourly(lake, followed)
        serve_hourly(lake, followed)
        done.append(followed)
    lake.drop_partitions(ARRIVALS, [f"arrival={arrival}" for arrival in opened])
    return done


def run_hour(
    lake: Lake,
    source_path: str | list[str],
    hour: str,
    run_id: str,
    late_hours: int = LATE_HOURS,
) -> int:
    """Raw file to served hourly gold, in one application.

    Silver and gold are computed for the late hours before this one as well, and for
    every other hour that arrived since the last run.
    """
    rows = ingest_hour_gated(lake, source_path, hour, run_id)
    take_up(lake, Interval.hour(hour), late_hours)
    return rows


def run_actor_hour(
    lake: Lake, hour: str, lookup: Lookup, places: DataFrame, codes: DataFrame
) -> dict[str, int]:
    """Fetch the hour's active actors and merge them into the dimension."""
    summary = fetch_actor_details(lake, hour, lookup)
    merge_actor_dimension(lake, hour, places, codes)
    return summary


def run_day(lake: Lake, day: str) -> None:
    """Daily gold tables for one day, and the earlier dates its events belong to, served."""
    interval = Interval.day(day)
    dates = update_repo_metrics_daily(lake, interval)
    update_contribution_daily(lake, interval)
    serve_daily(lake, *{interval.start.date(), *dates})
