from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from repopulse.operators import country, events, metrics, quality, upsert
from repopulse.operators.latest import latest_per_key
from repopulse.operators.point_in_time import point_in_time_join
from repopulse.operators.rank import (
    _position,
    _slice_between,
    distributed_ranks,
    rank_trend,
    rank_trend_over_history,
    ranks_of_any_ids,
)
from repopulse.operators.skew import salted_join

BRONZE = (
    "id STRING, type STRING, actor STRUCT<id: BIGINT, login: STRING>, "
    "repo STRUCT<id: BIGINT, name: STRING>, payload_raw STRING, created_at STRING, "
    "ingested_at TIMESTAMP_NTZ"
)
HOUR = datetime(2025, 9, 17, 11)


def as_tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# -- events ------------------------------------------------------------------------


def event(id, type="WatchEvent", actor=(1, "a"), repo=(7, "r"), payload="{}"):
    return (id, type, actor, repo, payload, "2025-09-17T10:59:00Z", HOUR)


def test_typed_events_keeps_known_people_of_wanted_types(spark):
    rows = [
        event("kept", payload='{"action":"started","x":{"action":"inner"}}'),
        event("bot", actor=(2, "dep[bot]")),
        event("no-login", actor=(3, None)),
        event("no-repo", repo=(None, "r")),
        event("no-actor", actor=(None, "a")),
        event("other", type="GollumEvent"),
        event("no-action", type="ForkEvent"),
    ]
    out = events.typed_events(spark.createDataFrame(rows, BRONZE))
    assert as_tuples(out, "event_id", "action") == [("kept", "started"), ("no-action", None)]
    assert out.first().created_at == datetime(2025, 9, 17, 10, 59)
    watch = events.typed_events(spark.createDataFrame(rows, BRONZE), ["WatchEvent"])
    assert [r.event_id for r in watch.collect()] == ["kept"]


def test_union_of_tables_with_an_older_shape(spark):
    old = spark.createDataFrame([("a", 1)], "event_id STRING, repo_id INT")
    new = spark.createDataFrame([(2, "b", "x")], "repo_id INT, event_id STRING, action STRING")
    rows = {r.event_id: (r.repo_id, r.action) for r in events.union_events([old, new]).collect()}
    assert rows == {"a": (1, None), "b": (2, "x")}


# -- latest and upsert -----------------------------------------------------------------


def test_latest_per_key_with_ties_and_null_keys(spark):
    rows = [
        (1, "2026-01-01", 1, "old"),
        (1, "2026-01-02", 1, "new"),
        (2, "2026-01-01", 1, "early"),
        (2, "2026-01-01", 2, "late"),
        (3, "2026-01-01", 1, "a"),
        (3, "2026-01-01", 1, "b"),
        (4, None, 9, "undated"),
        (4, "2026-01-01", 1, "dated"),
        (None, "2026-01-01", 1, "nobody"),
    ]
    df = spark.createDataFrame(rows, "id INT, created_at STRING, ingested_at INT, v STRING")
    out = latest_per_key(df, "id", ["created_at", "ingested_at"])
    assert as_tuples(out, "id", "v") == [(1, "new"), (2, "late"), (3, "b"), (4, "dated")]


def test_upsert_newest_only_replaces_older_rows(spark):
    target = spark.createDataFrame(
        [(1, 10, "t"), (2, 10, "t"), (3, 10, "t"), (4, None, "t"), (5, 10, "t"), (7, 1, "t")],
        "id INT, version INT, v STRING",
    )
    source = spark.createDataFrame(
        [(1, 11, "s"), (2, 10, "s"), (3, 9, "s"), (4, 5, "s"), (5, None, "s"), (6, None, "s")],
        "id INT, version INT, v STRING",
    )
    out = upsert.upsert_newest(target, source, "id", "version")
    expected = [(1, "s"), (2, "t"), (3, "t"), (4, "t"), (5, "t"), (6, "s"), (7, "t")]
    assert as_tuples(out, "id", "v") == expected
    again = upsert.upsert_newest(out, source, "id", "version")
    assert as_tuples(again, "id", "v") == expected


def test_upsert_replace_by_three_keys(spark):
    schema = "repo_id INT, created_date STRING, country_code STRING, n INT"
    target = spark.createDataFrame([(1, "d", "KOR", 1), (1, "d", "USA", 1)], schema)
    staging = spark.createDataFrame([(1, "d", "USA", 5), (2, "d", "USA", 6)], schema)
    out = upsert.upsert_replace(target, staging, ["repo_id", "created_date", "country_code"])
    assert as_tuples(out, "repo_id", "country_code", "n") == [(1, "KOR", 1), (1, "USA", 5), (2, "USA", 6)]


# -- skew and point in time ----------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join_with_a_hot_key(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit(0)).when(F.col("id") < 1100, None).otherwise(
            F.col("id") % 50
        ).alias("k"),
        F.lit("copy").alias("v"),
        (F.col("id") % 3).alias("w"),
    )
    right = spark.range(40).select(F.col("id").alias("k"), F.col("id").alias("lo"))
    right = right.unionByName(right.withColumn("lo", F.col("lo") + 100))
    salted = salted_join(left, right, ["k"], how=how, hot_rows=64)
    plain = left.join(right, "k", how)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0
    assert plain.exceptAll(salted).count() == 0


def test_salted_join_spreads_the_hot_key(spark):
    left = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(1, "x")], "k INT, r STRING")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, ["k"], hot_rows=10)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 1000
    assert len(sizes) > 1


def test_salted_join_rejects_other_join_types(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        salted_join(df, df, ["id"], how="full")


def test_point_in_time_bounds(spark):
    versions = spark.createDataFrame(
        [(1, 10, 20, "A"), (1, 20, 99, "B")], "user_id INT, valid_from INT, valid_to INT, code STRING"
    )
    happened = spark.createDataFrame(
        [(1, 9), (1, 10), (1, 19), (1, 20), (1, 99), (2, 15)], "actor_id INT, created_at INT"
    )
    out = point_in_time_join(happened, versions)
    assert as_tuples(out, "created_at", "code") == [(10, "A"), (19, "A"), (20, "B")]
    kept = point_in_time_join(happened, versions, how="left")
    assert kept.count() == 6
    assert kept.where(F.col("code").isNull()).count() == 3
    odd = spark.createDataFrame([(None, 15), (1, None)], "actor_id INT, created_at INT")
    assert point_in_time_join(odd, versions).count() == 0
    assert {r.code for r in point_in_time_join(odd, versions, how="left").collect()} == {None}
    # An empty version gives way to the one that begins with it; an expired one is none.
    more = spark.createDataFrame(
        [(1, 5, 5, "none"), (1, 5, 6, "X"), (1, 40, 45, "Y")], "user_id INT, valid_from INT, valid_to INT, code STRING"
    )
    out = point_in_time_join(happened.unionByName(odd.selectExpr("1 AS actor_id", "5 AS created_at")), more, stretch=3)
    assert as_tuples(out, "created_at", "code") == [(5, "X"), (5, "X")]


def test_point_in_time_reads_events_once_and_spreads_a_key(spark):
    """One key with all events: its stretches are dealt apart, and both steps share a shuffle."""
    happened = spark.range(20_000).select(F.lit(1).alias("actor_id"), F.col("id").alias("created_at"))
    versions = spark.range(20).select(
        F.lit(1).alias("user_id"), (F.col("id") * 1000).alias("valid_from"),
        (F.col("id") * 1000 + 1000).alias("valid_to"), F.col("id").alias("number"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = point_in_time_join(happened, versions, stretch=500)
        assert out.where(F.col("number") != F.floor(F.col("created_at") / 1000)).count() == 0
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "ReusedExchange" in plan and "ShuffledHashJoin" in plan
        # Not all rows in one of the shuffle's partitions.
        dealt = out.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(dealt) > 1 or spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") != "false"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -- rank and trend ---------------------------------------------------------------------------


def test_ranks_break_ties_by_id(spark):
    df = spark.createDataFrame(
        [(1, 5, 0), (2, 9, 0), (3, 5, 2), (4, 0, 2)], "repo_id BIGINT, star INT, fork INT"
    )
    out = distributed_ranks(df, {"s": "star", "f": "fork"}, "repo_id", id_slice=2)
    assert as_tuples(out, "repo_id", "s", "f") == [(1, 2, 3), (2, 1, 4), (3, 3, 1), (4, 4, 2)]


def ranked_rows(spark, rows):
    schema = "repo_id INT, h INT, star_count BIGINT, star_rank INT"
    return spark.createDataFrame(rows, schema).select(
        "repo_id",
        (F.lit(HOUR).cast("timestamp_ntz") + F.make_interval(hours=F.col("h"))).alias("ingested_at"),
        "star_count",
        F.col("star_count").alias("fork_count"),
        "star_rank",
        F.col("star_rank").alias("fork_rank"),
    )


def test_trend_needs_the_hour_before(spark):
    rows = ranked_rows(spark, [(1, 0, 5, 1), (2, 0, 3, 2), (1, 1, 2, 2), (2, 1, 4, 1), (1, 3, 9, 1), (3, 1, 1, 3)])
    joined = rank_trend(rows, rows)
    lagged = rank_trend_over_history(rows)
    columns = ["repo_id", "ingested_at", "prev_star_count", "prev_star_rank", "is_new", "star_trend", "fork_trend"]
    assert as_tuples(joined.na.fill(-1), *columns) == as_tuples(lagged.na.fill(-1), *columns)
    movement = {(r.repo_id, r.ingested_at.hour): (r.is_new, r.star_trend) for r in lagged.collect()}
    assert movement == {
        (1, 11): (True, 0), (2, 11): (True, 0), (1, 12): (False, -1), (2, 12): (False, 1),
        (1, 14): (True, 0), (3, 12): (True, 0),
    }


def test_first_load_defaults(spark):
    rows = ranked_rows(spark, [(1, 0, 5, 1)])
    row = rank_trend(rows, rows.where(F.lit(False))).first()
    assert (row.is_new, row.star_trend, row.fork_trend, row.prev_star_rank) == (True, 0, 0, None)


# -- metrics ----------------------------------------------------------------------------------


def test_daily_top_breaks_ties_by_repo(spark):
    df = spark.createDataFrame(
        [(i, datetime(2025, 9, 17).date(), 1 if i > 5 else 2) for i in range(1, 11)],
        "repo_id INT, created_date DATE, star_count INT",
    )
    assert [r.repo_id for r in metrics.top_repos(df, 7).collect()] == [1, 2, 3, 4, 5, 6, 7]


def test_contributions_know_only_versions_loaded_by_the_end_of_the_day(spark):
    day = datetime(2025, 9, 17)
    silver = spark.createDataFrame(
        [("e1", 7, 1, "WatchEvent", day, day), ("e2", 7, 2, "PushEvent", day, day), ("e3", 7, 3, "PushEvent", day, day)],
        "event_id STRING, repo_id INT, actor_id INT, event_type STRING, "
        "created_at TIMESTAMP_NTZ, ingested_at TIMESTAMP_NTZ",
    )
    end = datetime(9999, 12, 31)
    versions = spark.createDataFrame(
        [
            (1, "KOR", day, end, datetime(2025, 9, 17, 23)),
            (2, "USA", day, end, datetime(2025, 9, 18)),
            (3, "UNKNOWN", day, end, day),
        ],
        "user_id INT, country_code STRING, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, "
        "ingested_at TIMESTAMP_NTZ",
    )
    rows = metrics.daily_country_contributions(silver, versions).collect()
    assert [(r.repo_id, r.country_code, r.star_event_count, r.push_event_count) for r in rows] == [
        (7, "KOR", 1, 0)
    ]


# -- country --------------------------------------------------------------------------------------


def places(spark):
    return spark.createDataFrame(
        [("seoul", "Korea", 1), ("texas", "United States", 2), ("new york", "United States", 3)],
        "token STRING, country STRING, priority INT",
    )


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_country_of_free_text(spark, hot_rows):
    rows = [
        (1, "(Seoul), KR"), (2, "texas or seoul"), (3, "New York"), (4, ""), (5, "null"),
        (6, None), (7, "Seoulful"), (8, "TEXAS"), (9, "(Seoul), KR"),
    ]
    df = spark.createDataFrame(rows, "user_id INT, location STRING")
    out = {r.user_id: r.country for r in country.with_country(df, places(spark), hot_rows).collect()}
    assert out == {
        1: "Korea", 2: "Korea", 3: None, 4: None, 5: None, 6: None, 7: None,
        8: "United States", 9: "Korea",
    }


def test_country_codes(spark):
    listed = spark.createDataFrame(
        [("KR", "KOR", "Korea", None), ("US", "USA", "United States", "United States of America"), ("XK", "KOS", "Kosovo", "kr")],
        "alpha_2 STRING, alpha_3 STRING, name STRING, official_name STRING",
    )
    codes = country.country_codes(listed)
    df = spark.createDataFrame(
        [("Korea",), ("united states of america",), ("KR",), ("Atlantis",), (None,)], "country STRING"
    )
    out = {r.country: r.country_code for r in country.with_country_code(df, codes).collect()}
    assert out == {
        "Korea": "KOR", "united states of america": "USA", "KR": "KOR",
        "Atlantis": "UNKNOWN", None: "UNKNOWN",
    }


def test_gazetteer_takes_last_country_and_first_place(spark):
    subdivisions = spark.createDataFrame(
        [(1, "Central", "AA"), (2, "North", "BB"), (3, "central", "BB"), (4, "Lost", "ZZ")],
        "position INT, name STRING, country_code STRING",
    )
    countries = spark.createDataFrame([("AA", "Aland"), ("BB", "Beland")], "alpha_2 STRING, name STRING")
    out = country.gazetteer(subdivisions, countries)
    assert as_tuples(out, "token", "country", "priority") == [("central", "Beland", 1), ("north", "Beland", 2)]


# -- quality ------------------------------------------------------------------------------------------


def report(df, *checks):
    rows = quality.run_checks(df, checks or quality.EVENT_CHECKS, "run").collect()
    return {r.check_name: (r.n_rows, r.n_bad, r.passed) for r in rows}


def test_quality_report(spark):
    rows = [("a", HOUR), ("a", HOUR), ("b", None), (None, HOUR), (None, HOUR)]
    df = spark.createDataFrame(rows, "id STRING, ingested_at TIMESTAMP_NTZ")
    assert report(df) == {
        "not_null": (5, 1, False), "unique": (5, 2, False), "row_count": (5, 0, True),
    }


def test_quality_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id STRING, ingested_at TIMESTAMP_NTZ")
    assert all(passed for _, _, passed in report(df).values())
    assert report(df, quality.RowCount(2, 5)) == {"row_count": (0, 2, False)}
    seven = spark.range(7)
    assert report(seven, quality.RowCount(2, 5)) == {"row_count": (7, 2, False)}


def test_failed_checks_are_named(spark):
    df = spark.createDataFrame([("a", None)], "id STRING, ingested_at TIMESTAMP_NTZ")
    assert quality.failed_checks(quality.run_checks(df, quality.EVENT_CHECKS, "r")) == [
        "not_null(ingested_at): 1 bad rows"
    ]


@pytest.mark.parametrize("kind", ["sparse", "text", "alike"])
def test_ranks_of_any_ids(spark, kind):
    rng = random.Random(kind)
    make = {
        "sparse": lambda: rng.choice([-1, 1]) * rng.getrandbits(62),
        "text": lambda: "".join(rng.choices("aéz漢\x01", k=rng.randint(0, 9))),
        "alike": lambda: "the same beginning " + str(rng.getrandbits(40)),
    }[kind]
    ids = sorted({make() for _ in range(400)}, key=lambda i: str(i).encode() if kind != "sparse" else i)
    rows = [(h, i, rng.choice([0, 1, 1, 1, 5])) for h in (1, 2) for i in ids]
    df = spark.createDataFrame(rows, f"hour INT, id {'BIGINT' if kind == 'sparse' else 'STRING'}, score INT")
    out = ranks_of_any_ids(df.repartition(3), {"place": "score"}, "id", ["hour"], slices=16)
    expected = set()
    for hour in (1, 2):
        place = {i: n for n, i in enumerate(ids)}
        ranked = sorted((-s, place[i], i) for h, i, s in rows if h == hour)
        expected |= {(hour, i, -s, n) for n, (s, _, i) in enumerate(ranked, 1)}
    assert {(r.hour, r.id, r.score, r.place) for r in out.collect()} == expected


def test_any_ids_are_sliced_evenly(spark):
    """A tie of hashed ids is cut into ranges of like size, one offset per score and range."""
    df = spark.range(8000).select(F.xxhash64("id").alias("id"), F.lit(1).alias("score"))
    bounds = df.agg(F.percentile_approx(_position("id", "bigint"), [n / 8 for n in range(1, 8)], 160).alias("b"))
    sliced = df.withColumn("s", _slice_between(_position("id", "bigint"), sorted(bounds.first().b)))
    sizes = [r["count"] for r in sliced.groupBy("s").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1300
    assert ranks_of_any_ids(df.limit(0), {"r": "score"}, "id").count() == 0


def test_checks_counted_by_the_write(spark, tmp_path):
    rows = [("a", 1), ("a", None), (None, 3)]
    df = spark.createDataFrame(rows, "id STRING, ingested_at INT")
    checks = (*quality.EVENT_CHECKS, quality.RowCount(4))
    counted, seen = quality.observed(df, checks)
    counted.write.parquet(str(tmp_path / "t"))
    written = spark.read.parquet(str(tmp_path / "t"))
    report = quality.run_checks(written, checks, "r", seen.get)
    assert set(report.collect()) == set(quality.run_checks(written, checks, "r").collect())
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Project [id#" in plan


def test_upsert_keeps_null_keys_apart_and_joins_nothing(spark):
    target = spark.createDataFrame([(1, 1, "t"), (None, 5, "t")], "id INT, version INT, tag STRING")
    source = spark.createDataFrame([(None, 9, "s"), (2, None, "s"), (1, None, "s")], target.schema)
    out = upsert.upsert_newest(target, source, "id", "version")
    assert {tuple(r) for r in out.collect()} == {(1, 1, "t"), (None, 5, "t"), (None, 9, "s"), (2, None, "s")}
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
