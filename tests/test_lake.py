from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from repopulse.functions.timeframes import Interval

COLUMNS = "id STRING, ingested_at TIMESTAMP_NTZ"


def hours(spark, *rows):
    return spark.createDataFrame([(i, datetime(2025, 9, 17, h, 30)) for i, h in rows], COLUMNS)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_overwrite_replaces_only_the_hours_present(spark, lake):
    lake.overwrite_hours(hours(spark, ("a", 9), ("b", 10)), "t/x")
    lake.overwrite_hours(hours(spark, ("c", 10), ("d", 11)), "t/x")
    assert ids(lake.read("t/x")) == ["a", "c", "d"]
    lake.overwrite_hours(hours(spark), "t/x")
    assert ids(lake.read("t/x")) == ["a", "c", "d"]


def test_append_and_replace(spark, lake):
    lake.append_hours(hours(spark, ("a", 9)), "t/x")
    lake.append_hours(hours(spark, ("b", 9)), "t/x")
    assert ids(lake.read("t/x")) == ["a", "b"]
    lake.replace(hours(spark, ("z", 9)), "t/x")
    assert ids(lake.read("t/x")) == ["z"]
    lake.append(hours(spark, ("y", 9)), "t/x")
    assert ids(lake.read("t/x")) == ["y", "z"]
    lake.drop("t/x")
    assert not lake.exists("t/x")


def test_window_read_lists_only_its_hours(spark, lake):
    first = datetime(2025, 9, 17)
    stamps = [(str(n), first + timedelta(hours=n)) for n in range(1000)]
    many = spark.createDataFrame(stamps, COLUMNS).repartition(1)
    lake.overwrite_hours(many, "t/x", balance=False)
    window = lake.read_window("t/x", Interval.of("2025-09-17T09:00:00", "2025-09-17T11:00:00"))
    assert ids(window) == ["10", "9"]
    assert len(window.inputFiles()) == 2
    assert window.columns == ["id", "ingested_at"]
    assert lake.read("t/x").count() == 1000
    none = lake.read_window("t/x", Interval.of("2020-03-03T09:00:00", "2020-03-03T11:00:00"))
    assert none.count() == 0 and none.columns == ["id", "ingested_at"]


def test_hours_are_replaced_inside_their_block(spark, lake):
    rows = hours(spark, ("a", 9), ("b", 10), ("c", 13))
    whole, ten = Interval.day("2025-09-17"), Interval.hour("2025-09-17T10:00:00")
    lake.replace_hours(rows, "t/y", whole)
    assert sorted(lake._children(lake.path("t/y"))) == ["ingested_block=2025091706", "ingested_block=2025091712"]
    assert ids(lake.read_window("t/y", ten)) == ["b"]
    # The hour 10 gets no rows: its old ones go, hour 9 and the other block stay.
    lake.replace_hours(rows.where("id = 'a'"), "t/y", ten)
    assert ids(lake.read("t/y")) == ["a", "c"]
    # From the table itself, across both blocks.
    grown = lake.read_window("t/y", whole).unionByName(hours(spark, ("d", 12)))
    lake.replace_hours(grown, "t/y", Interval.of("2025-09-17T09:00:00", "2025-09-17T14:00:00"))
    assert ids(lake.read("t/y")) == ["a", "c", "d"]
    lake.replace_hours(rows.where("id = 'a'"), "t/y", whole)
    assert ids(lake.read("t/y")) == ["a"]
    assert lake._children(lake.path("t/y")) == ["ingested_block=2025091706"]


def test_a_month_is_a_hundred_files_and_one_listing(spark, lake):
    first = datetime(2025, 9, 1)
    stamps = [(str(n), first + timedelta(hours=n)) for n in range(720)]
    month = Interval.of(first, first + timedelta(days=30))
    lake.replace_hours(spark.createDataFrame(stamps, COLUMNS), "t/m", month)
    assert len(lake.read("t/m").inputFiles()) == 120
    listed = []
    spy = type(lake)(lake.spark, lake.root)
    object.__setattr__(spy, "_children", lambda path: (listed.append(path), lake._children(path))[1])
    assert spy.read_window("t/m", month).count() == 720
    assert listed == [lake.path("t/m")]
    assert spy.read_window("t/m", Interval.of("2025-09-05T05:00:00", "2025-09-05T07:00:00")).count() == 2


def test_publishing_again_after_a_break(spark, lake):
    """The old partition was put aside, its successor not yet moved in: the next call does it."""
    lake.overwrite_hours(hours(spark, ("a", 10)), "t/x")
    staged = lake.staging("audit")
    staged.overwrite_hours(hours(spark, ("c", 10)), "t/x")
    filesystem, path = lake._hadoop(lake.path("t/x/ingested_hour=2025091710"))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    filesystem.rename(path, hadoop(lake.path("t/x/_replaced-ingested_hour=2025091710")))
    assert ids(lake.read_window("t/x", Interval.hour("2025-09-17T10:00:00"))) == []
    lake.publish(staged, ["t/x"])
    assert ids(lake.read("t/x")) == ["c"]


def test_declared_tables_are_empty_before_the_first_write(lake):
    assert lake.read("silver/events").count() == 0
    assert "event_type" in lake.read("silver/events").columns
    assert not lake.exists("silver/events")


def test_schema_grows(spark, lake):
    lake.overwrite_hours(hours(spark, ("a", 9)), "t/x")
    lake.overwrite_hours(hours(spark, ("b", 10)).withColumn("extra", F.lit("e")), "t/x")
    rows = {r.id: r.extra for r in lake.read("t/x", merge_schema=True).collect()}
    assert rows == {"a": None, "b": "e"}


def test_views(spark, lake):
    lake.overwrite_hours(hours(spark, ("a", 9), ("b", 10)), "t/x")
    lake.register_view("t/x", "late_view", "id = 'b'")
    assert spark.sql("SELECT id FROM late_view").collect()[0].id == "b"


def test_staged_batch_is_invisible_until_published(spark, lake):
    lake.overwrite_hours(hours(spark, ("a", 9), ("b", 10)), "t/x")
    staged = lake.staging("audit")
    staged.overwrite_hours(hours(spark, ("c", 10)), "t/x")
    assert ids(staged.read("t/x")) == ["c"]
    assert ids(lake.read("t/x")) == ["a", "b"]
    lake.publish(staged, ["t/x", "t/never_written"])
    staged.discard()
    assert ids(lake.read("t/x")) == ["a", "c"]
    assert not staged.exists("t/x") and not lake.exists("t/never_written")


def test_only_staged_batches_are_discarded(lake):
    with pytest.raises(ValueError):
        lake.discard()
