"""Half-open batch intervals and the columns derived from event time."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = timedelta(hours=1)
DAY = timedelta(days=1)


def parse_utc(value: str | datetime) -> datetime:
    """ISO text (or a datetime) as naive UTC."""
    parsed = datetime.fromisoformat(value) if isinstance(value, str) else value
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(timezone.utc).replace(tzinfo=None)
    return parsed


def floor_to(value: datetime, unit: str) -> datetime:
    if unit == "hour":
        return value.replace(minute=0, second=0, microsecond=0)
    if unit == "day":
        return value.replace(hour=0, minute=0, second=0, microsecond=0)
    raise ValueError(f"unit must be hour or day, not {unit!r}")


@dataclass(frozen=True)
class Interval:
    """``[start, end)`` in naive UTC."""

    start: datetime
    end: datetime

    @classmethod
    def of(cls, start: str | datetime, end: str | datetime) -> Interval:
        return cls(parse_utc(start), parse_utc(end))

    @classmethod
    def hour(cls, at: str | datetime) -> Interval:
        start = floor_to(parse_utc(at), "hour")
        return cls(start, start + HOUR)

    @classmethod
    def day(cls, at: str | datetime) -> Interval:
        start = floor_to(parse_utc(at), "day")
        return cls(start, start + DAY)

    def aligned(self, unit: str) -> Interval:
        """Both ends moved back to the start of their hour or day.

        A run that starts at 11:20 for 11:20-12:20 therefore covers 11:00-12:00.
        """
        return Interval(floor_to(self.start, unit), floor_to(self.end, unit))

    def reaching_back(self, hours: int) -> Interval:
        return Interval(self.start - hours * HOUR, self.end)

    def before(self, hours: int = 1) -> Interval:
        """The stretch of ``hours`` hours that ends where this interval starts."""
        return Interval(self.start - hours * HOUR, self.start)

    def hour_keys(self, every: int = 1) -> list[int]:
        """The keys of all hours, or of all blocks of ``every`` hours, the interval touches."""
        first = floor_to(self.start, "hour") - self.start.hour % every * HOUR
        step = every * HOUR
        blocks = -(-(self.end - first) // step) if self.end > self.start else 0
        return [hour_key_of(first + n * step) for n in range(blocks)]

    def covers(self, key: int, every: int) -> bool:
        """Whether the block of ``every`` hours from the hour of ``key`` on lies inside."""
        first = datetime.strptime(str(key), "%Y%m%d%H")
        return self.start <= first and first + every * HOUR <= self.end

    def contains(self, column: Column | str) -> Column:
        col = F.col(column) if isinstance(column, str) else column
        return (col >= ntz_literal(self.start)) & (col < ntz_literal(self.end))


def contiguous(intervals: Iterable[Interval], joined: bool = True) -> list[Interval]:
    """The intervals in order, without repeats; overlapping and adjoining ones as one if ``joined``."""
    out: list[Interval] = []
    for one in sorted(set(intervals), key=lambda i: (i.start, i.end)):
        if joined and out and one.start <= out[-1].end:
            out[-1] = Interval(out[-1].start, max(out[-1].end, one.end))
        else:
            out.append(one)
    return out


def ntz_literal(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def hour_key_of(value: datetime) -> int:
    return int(value.strftime("%Y%m%d%H"))


def hour_of(column: Column | str) -> Column:
    """Start of the hour. ``date_trunc`` answers with a zoned type; go back to NTZ."""
    return F.date_trunc("hour", column).cast("timestamp_ntz")


def hour_key(column: Column | str, every: int = 1) -> Column:
    """yyyyMMddHH of the hour, or of the first hour of its block of ``every``, as an integer:
    the partition value of hourly tables. ``every`` divides 24."""
    if every == 1:
        return F.date_format(column, "yyyyMMddHH").cast("int")
    day, hour = F.date_format(column, "yyyyMMdd").cast("int"), F.hour(column)
    return day * 100 + hour - hour % every


def event_time(column: Column | str, dtype: str) -> Column:
    """Event time as TIMESTAMP_NTZ; malformed text becomes null, it does not fail the job."""
    col = F.col(column) if isinstance(column, str) else column
    parsed = F.try_to_timestamp(col) if dtype == "string" else col
    return parsed.cast("timestamp_ntz")
