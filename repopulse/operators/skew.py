"""Equi-join that splits heavy keys of the left side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key a single join task should see at most.
HOT_ROWS = 1_000_000
# Tasks that share the rows without a key.
NULL_KEY_SALTS = 1024


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    condition: Column | None = None,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join on ``on`` (same names on both sides); ``how`` is inner or left.

    Keys with more than ``hot_rows`` rows on the left are cut into
    ``ceil(n / hot_rows)`` salts. Their rows on the right are repeated once per
    salt, all other keys stay as they are. The heavy-key list has at most
    ``rows / hot_rows`` entries, so the broadcast has a bound that does not
    depend on the number of keys.

    The salt hashes row content and input partition, never ``rand``: a retried
    task gives every row the salt it had before. Rows without a key match
    nothing and are spread just the same.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    on = list(on)
    heavy = (
        left.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(*on, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_salts"))
    )
    heavy = F.broadcast(heavy)

    salts = F.coalesce(F.col("_salts"), F.lit(1))
    no_key = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in on])
    spread = F.xxhash64(*left.columns, F.spark_partition_id())
    salted_left = (
        left.join(heavy, on, "left")
        .withColumn("_salt", F.pmod(spread, F.when(no_key, NULL_KEY_SALTS).otherwise(salts)).cast("int"))
        .drop("_salts")
    )
    repeated_right = (
        right.join(heavy, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )

    keys = [*on, "_salt"]
    match = reduce(lambda a, b: a & b, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys])
    if condition is not None:
        match = match & condition
    kept_right = [F.col(f"r.{name}") for name in right.columns if name not in on]
    return (
        salted_left.alias("l")
        .join(repeated_right.alias("r"), match, how)
        .select(*[F.col(f"l.{name}") for name in left.columns], *kept_right)
    )
