"""What stands in for a stream: hourly windows, recomputed and replaced.

Late rows are picked up by recomputing the last hours on every run, state
across windows is the previous hour of the table itself, and exactly-once
results come from replacing whole hour partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from repopulse.functions.timeframes import Interval
from repopulse.sinks.lake import Lake

# Fixed value: hours recomputed before the current one.
LATE_HOURS = 2


def recompute_interval(interval: Interval, late_hours: int = LATE_HOURS) -> Interval:
    """The hour-aligned run window with the late hours before it."""
    return interval.aligned("hour").reaching_back(late_hours)


def replace_window(
    lake: Lake,
    df: DataFrame,
    table: str,
    interval: Interval,
    sort: Sequence[str | Column] = (),
) -> None:
    """Make the hours of ``interval`` hold the rows of ``df`` that lie in it, and no others."""
    lake.replace_hours(df, table, interval, sort)


def previous_hour(lake: Lake, table: str, interval: Interval) -> DataFrame:
    """Rows of the hour before the interval; none before the first load."""
    return lake.read_window(table, interval.before(1))
