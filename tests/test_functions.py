from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from repopulse.functions import text
from repopulse.functions.timeframes import (
    Interval,
    event_time,
    hour_key,
    hour_of,
    parse_utc,
)
from repopulse.streaming.microbatch import recompute_interval


def values(df, name="v"):
    return [row[name] for row in df.collect()]


def test_parse_utc_turns_offsets_into_utc():
    assert parse_utc("2025-09-17T11:20:00+09:00") == datetime(2025, 9, 17, 2, 20)
    assert parse_utc("2025-09-17 11:20:00") == datetime(2025, 9, 17, 11, 20)


def test_interval_alignment_and_neighbours():
    run = Interval.of("2025-09-17T11:20:00Z", "2025-09-17T12:20:00Z")
    assert run.aligned("hour") == Interval(datetime(2025, 9, 17, 11), datetime(2025, 9, 17, 12))
    assert run.aligned("day") == Interval(datetime(2025, 9, 17), datetime(2025, 9, 17))
    assert run.aligned("hour").before() == Interval(datetime(2025, 9, 17, 10), datetime(2025, 9, 17, 11))
    assert Interval.day("2025-09-17T05:00:00").end == datetime(2025, 9, 18)
    with pytest.raises(ValueError):
        run.aligned("week")


def test_recompute_reaches_two_hours_back():
    run = Interval.of("2025-09-17T11:20:00", "2025-09-17T12:20:00")
    assert recompute_interval(run) == Interval(datetime(2025, 9, 17, 9), datetime(2025, 9, 17, 12))


def test_window_is_half_open(spark):
    times = ["2025-09-17 11:00:00", "2025-09-17 11:59:59.999999", "2025-09-17 12:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t STRING").select(
        F.col("t").cast("timestamp_ntz").alias("t")
    )
    hour = Interval.hour("2025-09-17 11:00:00")
    assert df.where(hour.contains("t")).count() == 2
    unaligned = Interval.of("2025-09-17 11:30:00", "2025-09-17 12:30:00")
    assert df.where(unaligned.contains("t")).count() == 2
    assert hour.hour_keys() == [2025091711] and unaligned.hour_keys() == [2025091711, 2025091712]
    assert Interval(hour.end, hour.start).hour_keys() == []


def test_hour_of_keeps_wall_clock(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2025-09-17 11:59:59.5' AS t")
    out = df.select(hour_of("t").alias("v"), hour_key("t").alias("k"))
    assert out.schema["v"].dataType.simpleString() == "timestamp_ntz"
    assert out.first() == (datetime(2025, 9, 17, 11), 2025091711)


def test_event_time_reads_offsets_and_survives_bad_text(spark):
    rows = [("2025-09-17T11:00:00Z",), ("2025-09-17T11:00:00+09:00",), ("yesterday",), (None,)]
    df = spark.createDataFrame(rows, "t STRING").select(event_time("t", "string").alias("v"))
    assert values(df) == [datetime(2025, 9, 17, 11), datetime(2025, 9, 17, 2), None, None]


def test_company_cleaning(spark):
    rows = [("@acme-corp, inc.!",), ("@@x",), (None,), ("  Ünïted (labs) & co_1 ✨",)]
    df = spark.createDataFrame(rows, "c STRING").select(text.clean_company("c").alias("v"))
    assert values(df) == ["Acme-corp, Inc.", "X", None, "Ünïted (labs) & Co_1"]


def test_location_cleaning(spark):
    rows = [("(near) [Seoul],  Korea ",), ("null",), ("NaN",), ("",), (None,), (",",)]
    df = spark.createDataFrame(rows, "l STRING").select(text.clean_location("l").alias("v"))
    assert values(df) == ["near Seoul Korea", None, None, None, None, ""]


def test_location_blanks_of_all_kinds(spark):
    kinds = "\u00a0\u1680\u2003\u2028\u202f\u205f\u3000\t\x0b"
    rows = [(f"{blank}Kyoto{blank}{blank}Japan{blank}",) for blank in kinds]
    df = spark.createDataFrame(rows, "l STRING").select(text.clean_location("l").alias("v"))
    assert set(values(df)) == {"Kyoto Japan"}


def test_node_id(spark):
    df = spark.range(1).select(text.user_node_id(F.lit("31415926")).alias("v"))
    assert values(df) == ["MDQ6VXNlcjMxNDE1OTI2"]


def test_change_hash_reads_null_as_empty(spark):
    df = spark.createDataFrame(
        [("a", None, "c"), ("a", "", "c"), ("a", "b", "c")], "name STRING, country STRING, company STRING"
    ).select(text.change_hash().alias("v"))
    first, second, third = values(df)
    assert first == second != third
    assert len(first) == 64


def test_bots_and_unknown_logins_are_not_people(spark):
    rows = [("a",), ("dep[bot]",), (None,), ("[bot]x",)]
    df = spark.createDataFrame(rows, "l STRING").where(text.is_person("l"))
    assert sorted(values(df, "l")) == ["[bot]x", "a"]
