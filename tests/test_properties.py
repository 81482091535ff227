"""Randomised checks against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from repopulse.operators.point_in_time import point_in_time_join
from repopulse.operators.rank import distributed_ranks
from repopulse.operators.scd2 import first_versions, scd2_apply
from repopulse.operators.upsert import upsert_newest

RUNS = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
small = st.integers(0, 4)


@RUNS
@given(rows=st.dictionaries(st.tuples(small, st.integers(0, 60)), st.tuples(small, small), min_size=1, max_size=60),
       id_slice=st.integers(1, 20))
def test_distributed_rank_is_rank(spark, rows, id_slice):
    data = [(hour, repo, stars, forks) for (hour, repo), (stars, forks) in rows.items()]
    df = spark.createDataFrame(data, "h INT, repo_id BIGINT, s INT, f INT")
    out = distributed_ranks(df, {"sr": "s", "fr": "f"}, "repo_id", ["h"], id_slice)
    got = {(r.h, r.repo_id): (r.sr, r.fr) for r in out.collect()}
    expected = defaultdict(list)
    for position in (2, 3):
        for hour in {row[0] for row in data}:
            ordered = sorted((r for r in data if r[0] == hour), key=lambda r: (-r[position], r[1]))
            for place, row in enumerate(ordered, 1):
                expected[row[:2]].append(place)
    assert got == {key: tuple(places) for key, places in expected.items()}


versions = st.dictionaries(small, st.one_of(st.none(), small), max_size=5)


@RUNS
@given(target=versions, source=versions)
def test_upsert_is_idempotent_and_never_goes_back(spark, target, source):
    def frame(rows, tag):
        return spark.createDataFrame([(k, v, tag) for k, v in rows.items()], "id INT, version INT, tag STRING")

    s = frame(source, "s")
    once = upsert_newest(frame(target, "t"), s, "id", "version")
    rows = {r.id: (r.version, r.tag) for r in once.collect()}
    expected = {k: (v, "t") for k, v in target.items()}
    for key, version in source.items():
        old = expected.get(key)
        if old is None or (old[0] is not None and version is not None and old[0] < version):
            expected[key] = (version, "s")
    assert rows == expected
    assert {r.id: (r.version, r.tag) for r in upsert_newest(once, s, "id", "version").collect()} == rows


@RUNS
@given(batches=st.lists(st.tuples(st.integers(0, 5), st.dictionaries(small, st.sampled_from("xyz"), max_size=4)),
                        min_size=1, max_size=4))
def test_dimension_has_one_current_row_and_no_overlap(spark, batches):
    start = datetime(2026, 1, 1)
    dimension = first_versions(spark.createDataFrame([], "user_id INT, hash_diff STRING"), start)
    for day, values in batches:
        df = spark.createDataFrame(list(values.items()), "user_id INT, hash_diff STRING")
        dimension = scd2_apply(dimension, first_versions(df, start + timedelta(days=day)), "user_id")
    by_key = defaultdict(list)
    for r in dimension.collect():
        by_key[r.user_id].append((r.valid_from, r.valid_to, r.is_current))
    assert set(by_key) == {key for _, values in batches for key in values}
    for spans in by_key.values():
        spans.sort()
        assert [current for *_, current in spans].count(True) == 1
        assert all(a < b for a, b, _ in spans)
        assert all(first[1] == second[0] for first, second in zip(spans, spans[1:]))


@RUNS
@given(happened=st.lists(st.tuples(small, st.integers(0, 20)), max_size=40),
       cuts=st.dictionaries(small, st.sets(st.integers(0, 20), min_size=2, max_size=5), max_size=5),
       stretch=st.integers(1, 25))
def test_point_in_time_join_across_stretches(spark, happened, cuts, stretch):
    spans = [(key, a, b) for key, points in cuts.items() for a, b in zip(sorted(points), sorted(points)[1:])]
    df = spark.createDataFrame(happened, "actor_id INT, created_at INT")
    dim = spark.createDataFrame(spans, "user_id INT, valid_from INT, valid_to INT")
    out = point_in_time_join(df, dim, stretch=stretch)
    got = Counter((r.actor_id, r.created_at, r.valid_from) for r in out.collect())
    assert got == Counter((k, t, a) for k, t in happened for key, a, b in spans if key == k and a <= t < b)


def test_hourly_counts_add_up_to_daily_counts(spark):
    from repopulse.operators import metrics
    from repopulse.sources.driver_tables import silver_events

    silver = silver_events(spark, "/root/testdata/sf0.001")
    hourly = metrics.hourly_star_fork_counts(silver).agg(F.sum("star_count"), F.sum("fork_count")).first()
    daily = metrics.daily_repo_metrics(silver).agg(F.sum("star_count"), F.sum("fork_count")).first()
    assert tuple(hourly) == tuple(daily)
