"""Star, fork and activity counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.functions.timeframes import hour_of
from repopulse.operators.point_in_time import point_in_time_join
from repopulse.operators.rank import (
    rank_trend_over_history,
    with_star_and_fork_ranks,
)

# The count each event type feeds.
COUNTED_TYPES = {
    "star": "WatchEvent",
    "fork": "ForkEvent",
    "pr": "PullRequestEvent",
    "issues": "IssuesEvent",
    "push": "PushEvent",
}
UNKNOWN_COUNTRY = "UNKNOWN"
DAILY_TOP = 500
HOURLY_TOP = 20


def type_counts(suffix: str, kinds: Sequence[str] = tuple(COUNTED_TYPES)) -> list[Column]:
    return [
        F.count_if(F.col("event_type") == COUNTED_TYPES[kind]).alias(f"{kind}{suffix}")
        for kind in kinds
    ]


def hourly_star_fork_counts(events: DataFrame) -> DataFrame:
    """Stars and forks per repo and ingest hour, one scan for both types."""
    both = [COUNTED_TYPES["star"], COUNTED_TYPES["fork"]]
    return (
        events.where(F.col("event_type").isin(*both))
        .groupBy("repo_id", hour_of("ingested_at").alias("ingested_at"))
        .agg(*type_counts("_count", ("star", "fork")))
    )


def with_repo_names(metrics: DataFrame, repos: DataFrame) -> DataFrame:
    """Left lookup of the repo name; ``repos`` holds one row per repo_id."""
    names = repos.select("repo_id", "repo_name")
    return metrics.join(names, "repo_id", "left").select(names["repo_name"], *metrics.columns)


def hourly_repo_metrics(events: DataFrame, repos: DataFrame) -> DataFrame:
    """Counts, both ranks, rank movement and name for every hour of ``events``."""
    ranked = with_star_and_fork_ranks(hourly_star_fork_counts(events))
    return rank_trend_over_history(with_repo_names(ranked, repos))


def hourly_top(ranked: DataFrame, n: int = HOURLY_TOP) -> DataFrame:
    """The n most starred repos of each hour, off the rank already computed."""
    return ranked.where(F.col("star_rank") <= n)


def daily_repo_metrics(events: DataFrame) -> DataFrame:
    """Five activity counts per repo and creation date."""
    return events.groupBy("repo_id", F.to_date("created_at").alias("created_date")).agg(
        *type_counts("_count")
    )


def top_repos(daily: DataFrame, n: int = DAILY_TOP) -> DataFrame:
    """Most starred rows over all dates present, ties by repo_id (then date)."""
    return daily.orderBy(F.col("star_count").desc(), "repo_id", "created_date").limit(n)


def top_repos_each_day(daily: DataFrame, n: int = DAILY_TOP) -> DataFrame:
    """Most starred repos of each date, ties by repo_id."""
    busiest_first = Window.partitionBy("created_date").orderBy(F.col("star_count").desc(), "repo_id")
    return (
        daily.withColumn("_position", F.row_number().over(busiest_first))
        .where(F.col("_position") <= n)
        .drop("_position")
    )


def known_countries(versions: DataFrame) -> DataFrame:
    code = F.col("country_code")
    return versions.where(code.isNotNull() & (code != UNKNOWN_COUNTRY))


def daily_country_contributions(events: DataFrame, versions: DataFrame) -> DataFrame:
    """Five activity counts per repo, country of the actor at event time, and ingest day.

    Each day knows only the versions loaded before it ended, so a backfill of
    many days gives what the daily runs gave.
    """
    known = known_countries(versions).select(
        "user_id",
        "country_code",
        "valid_from",
        "valid_to",
        F.col("ingested_at").alias("_version_loaded_at"),
    )
    dated = events.select(
        "actor_id",
        "repo_id",
        "event_type",
        "created_at",
        F.to_date("ingested_at").alias("created_date"),
    )
    day_end = F.date_add("created_date", 1).cast("timestamp_ntz")
    return (
        point_in_time_join(dated, known)
        .where(F.col("_version_loaded_at") < day_end)
        .groupBy("repo_id", "country_code", "created_date")
        .agg(*type_counts("_event_count"))
    )


def active_actors(events: DataFrame) -> DataFrame:
    return events.select("actor_id").where(F.col("actor_id").isNotNull()).distinct()


def counts_per_hour(events: DataFrame) -> DataFrame:
    """Row counts per ingest hour and type."""
    return events.groupBy(hour_of("ingested_at").alias("ingested_at"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events")
    )
