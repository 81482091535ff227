"""Slowly changing dimension, type 2."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.functions.timeframes import ntz_literal

# Fixed value: the open end of a current version.
OPEN_END = datetime(9999, 12, 31, 23, 59, 59)

VERSION_COLUMNS = ("valid_from", "valid_to", "is_current")


def first_versions(df: DataFrame, batch_time: datetime) -> DataFrame:
    """Stamp every row as the current version from ``batch_time`` on."""
    return df.withColumns(
        {
            "valid_from": ntz_literal(batch_time),
            "valid_to": ntz_literal(OPEN_END),
            "is_current": F.lit(True),
        }
    )


def _compared(current: DataFrame, batch: DataFrame, key: str, how: str) -> DataFrame:
    old = current.select(F.col(key), F.struct(*current.columns).alias("_old"))
    new = batch.select(F.col(key), F.struct(*current.columns).alias("_new"))
    first_seen = F.col("_old").isNull() & F.col("_new").isNotNull()
    changed = (F.col("_old.hash_diff") != F.col("_new.hash_diff")) & (
        F.col("_new.valid_from") > F.col("_old.valid_from")
    )
    return new.join(old, key, how).select(
        "_old",
        "_new",
        first_seen.alias("_first_seen"),
        F.coalesce(changed, F.lit(False)).alias("_changed"),
    )


def scd2_changes(current: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Batch rows that start a new version, with ``change`` = insert or update.

    A batch that is not newer than the current version changes nothing.
    """
    compared = _compared(current, batch, key, "left")
    return compared.where(F.col("_first_seen") | F.col("_changed")).select(
        "_new.*", F.when(F.col("_first_seen"), "insert").otherwise("update").alias("change")
    )


def scd2_step(current: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Current versions and one batch, merged: the new current rows and the rows just closed.

    One join gives both: each pair yields the old row (closed when replaced)
    and, for first or changed keys, the new one.
    """
    columns = current.columns
    old = {name: F.col(f"_old.{name}") for name in columns}
    old["valid_to"] = F.when(F.col("_changed"), F.col("_new.valid_from")).otherwise(old["valid_to"])
    old["is_current"] = ~F.col("_changed")
    old_row = F.struct(*[value.alias(name) for name, value in old.items()])
    rows = F.array_compact(
        F.array(
            F.when(F.col("_old").isNotNull(), old_row),
            F.when(F.col("_first_seen") | F.col("_changed"), F.col("_new")),
        )
    )
    return (
        _compared(current, batch, key, "full")
        .select(F.explode(rows).alias("_row"))
        .select("_row.*")
    )


def scd2_apply(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The whole dimension after a batch; closed versions pass through unread by the join."""
    closed = target.where(~F.col("is_current"))
    return closed.unionByName(scd2_step(current_versions(target), batch, key))


def current_versions(dimension: DataFrame) -> DataFrame:
    return dimension.where(F.col("is_current"))
