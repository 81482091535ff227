"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns of each non-null ``key``.

    The remaining columns break ties, so the answer is the same on every run.
    The ``row_number() = 1`` form lets Spark keep one row per key before the
    shuffle (WindowGroupLimit), so a key holding a third of the rows arrives as
    one row per input task.
    """
    ties = [name for name in df.columns if name != key and name not in order]
    newest_first = Window.partitionBy(key).orderBy(
        *[F.col(name).desc_nulls_last() for name in [*order, *ties]]
    )
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_position", F.row_number().over(newest_first))
        .where(F.col("_position") == 1)
        .drop("_position")
    )
