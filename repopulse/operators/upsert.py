"""Keyed upserts for tables without a row-level MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_newest(target: DataFrame, source: DataFrame, key: str, version: str) -> DataFrame:
    """State of ``target`` after merging ``source``; both hold one row per key.

    A matched row is replaced only when its ``version`` is strictly older.
    Equal or null versions on either side keep the target row. New keys are
    inserted; null keys match nothing.

    Both sides are stacked and the winner of a key is picked by an aggregate, which
    combines in the tasks first: no join, and one shuffle for both sides.
    """
    columns = target.columns
    stacked = target.withColumn("_kept", F.lit(1)).unionByName(
        source.select(*columns, F.lit(0).alias("_kept"))
    )
    # A target row without version stays whatever comes.
    stays = ((F.col("_kept") == 1) & F.col(version).isNull()).cast("int")
    strength = F.struct(stays, F.col(version), F.col("_kept"))
    unmatched = F.when(F.col(key).isNull(), F.col("_kept"))
    return (
        stacked.groupBy(key, unmatched.alias("_side"))
        .agg(F.max_by(F.struct(*columns), strength).alias("_row"))
        .select("_row.*")
    )


def upsert_replace(target: DataFrame, staging: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State of ``target`` after every staged row replaced or joined it by ``keys``."""
    kept = target.join(staging.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(staging.select(*target.columns))


def upsert_statement(target: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """The same upsert as one statement for a serving database (PostgreSQL dialect)."""
    column_list = ", ".join(columns)
    updates = ", ".join(f"{name} = excluded.{name}" for name in columns if name not in keys)
    return (
        f"INSERT INTO {target} ({column_list}) SELECT {column_list} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {updates}"
    )
