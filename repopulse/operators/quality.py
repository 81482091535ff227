"""Named data-quality checks over a DataFrame, reported as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REPORT_COLUMNS = ("run_id", "check_name", "column_name", "n_rows", "n_bad", "passed")


class QualityError(RuntimeError):
    """A gated batch failed at least one check."""


@dataclass(frozen=True)
class NotNull:
    column: str
    name = "not_null"


@dataclass(frozen=True)
class Unique:
    """Non-null values must occur once; every row of a repeated value is bad."""

    column: str
    name = "unique"


@dataclass(frozen=True)
class RowCount:
    """Row count in [minimum, maximum]; ``n_bad`` is the distance to the range."""

    minimum: int = 0
    maximum: int | None = None
    name = "row_count"
    column = None


Check = NotNull | Unique | RowCount

EVENT_CHECKS: tuple[Check, ...] = (NotNull("ingested_at"), Unique("id"), RowCount(0))


def duplicated(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count; null does not count as a value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def _range_miss(check: RowCount) -> Column:
    rows = F.col("n_rows")
    short = F.greatest(F.lit(check.minimum) - rows, F.lit(0))
    over = F.lit(0) if check.maximum is None else F.greatest(rows - F.lit(check.maximum), F.lit(0))
    return (short + over).cast("bigint")


def _totals(checks: Sequence[NotNull | RowCount]) -> list[Column]:
    nulls = [
        F.count_if(F.col(c.column).isNull()).alias(f"_null_{i}")
        for i, c in enumerate(checks)
        if isinstance(c, NotNull)
    ]
    return [F.count(F.lit(1)).alias("n_rows"), *nulls]


def _one_pass(checks: Sequence[Check]) -> list[NotNull | RowCount]:
    return [c for c in checks if not isinstance(c, Unique)]


def observed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation]:
    """``df`` with the counts of all null and row-count checks taken while it is written.

    Pass what the observation got to :func:`run_checks`, which then reads the rows for
    the unique checks alone. Only the write itself may use ``df``.
    """
    seen = Observation()
    return df.observe(seen, *_totals(_one_pass(checks))), seen


def _one_pass_report(totals: DataFrame, checks: Sequence[NotNull | RowCount]) -> DataFrame:
    """All null and row-count checks from one row of totals."""
    entries = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(c.column).cast("string").alias("column_name"),
            (F.col(f"_null_{i}") if isinstance(c, NotNull) else _range_miss(c)).alias("n_bad"),
        )
        for i, c in enumerate(checks)
    ]
    return totals.select("n_rows", F.explode(F.array(*entries)).alias("e")).select("e.*", "n_rows")


def _unique_report(df: DataFrame, check: Unique) -> DataFrame:
    """Two-level hash aggregate: rows per value, then totals. Copies collapse before the shuffle."""
    per_value = df.groupBy(check.column).agg(F.count(F.lit(1)).alias("_n"))
    repeated = F.col(check.column).isNotNull() & (F.col("_n") > 1)
    return per_value.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("n_bad"),
    ).select(
        F.lit(check.name).alias("check_name"),
        F.lit(check.column).alias("column_name"),
        "n_bad",
        "n_rows",
    )


def run_checks(
    df: DataFrame, checks: Sequence[Check], run_id: str, seen: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per check: rows seen, rows at fault, passed.

    ``seen`` is what an observation of the same checks counted while the rows were written.
    """
    single = _one_pass(checks)
    if seen is None:
        totals = df.agg(*_totals(single))
    else:
        counted = [F.lit(n).cast("bigint").alias(name) for name, n in seen.items()]
        totals = df.sparkSession.range(1).select(*counted)
    parts = [_one_pass_report(totals, single)] if single else []
    parts += [_unique_report(df, c) for c in checks if isinstance(c, Unique)]
    report = reduce(DataFrame.unionByName, parts)
    return report.select(
        F.lit(run_id).alias("run_id"),
        "check_name",
        "column_name",
        "n_rows",
        "n_bad",
        (F.col("n_bad") == 0).alias("passed"),
    )


def failed_checks(report: DataFrame) -> list[str]:
    """Names of failed checks. A report has one row per check, so this may come to the driver."""
    bad = report.where(~F.col("passed")).select("check_name", "column_name", "n_bad").collect()
    return [f"{r.check_name}({r.column_name or ''}): {r.n_bad} bad rows" for r in bad]
