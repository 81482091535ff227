"""Projections of bronze events and the typed event tables."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.functions.text import is_person
from repopulse.functions.timeframes import event_time

# Event types and the table each is kept in.
EVENT_TABLES = {
    "WatchEvent": "silver/watch_events",
    "ForkEvent": "silver/fork_events",
    "PullRequestEvent": "silver/pull_request_events",
    "PushEvent": "silver/push_events",
    "IssuesEvent": "silver/issues_events",
}


def actor_attributes(bronze: DataFrame) -> DataFrame:
    """Actor struct of each event as flat columns."""
    actor = {
        "id": "actor_id",
        "avatar_url": "avatar_url",
        "display_login": "actor_display_login",
        "gravatar_id": "actor_gravatar_id",
        "login": "actor_login",
        "url": "actor_url",
    }
    return bronze.select(
        *[F.col(f"actor.{field}").alias(name) for field, name in actor.items()],
        "created_at",
        "ingested_at",
    )


def repo_attributes(bronze: DataFrame) -> DataFrame:
    """Repo struct of each event as flat columns."""
    return bronze.select(
        *[F.col(f"repo.{field}").alias(f"repo_{field}") for field in ("id", "name", "url")],
        "created_at",
        "ingested_at",
    )


def typed_events(bronze: DataFrame, event_types: Iterable[str] = tuple(EVENT_TABLES)) -> DataFrame:
    """Slim rows of the wanted types: known repo and actor, no bots, action pulled out.

    All types come from one scan; the filters read plain columns and struct
    fields only, so they reach the files.
    """
    kept = bronze.where(
        F.col("repo.id").isNotNull()
        & F.col("actor.id").isNotNull()
        & F.col("type").isin(*event_types)
        & is_person("actor.login")
    )
    created_type = bronze.schema["created_at"].dataType.simpleString()
    return kept.select(
        F.col("id").alias("event_id"),
        F.col("repo.id").alias("repo_id"),
        F.col("actor.id").alias("actor_id"),
        F.col("type").alias("event_type"),
        F.get_json_object("payload_raw", "$.action").alias("action"),
        event_time("created_at", created_type).alias("created_at"),
        "ingested_at",
    )


def union_events(tables: Iterable[DataFrame]) -> DataFrame:
    """All rows of all tables, by column name; a column missing in an old table reads as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
