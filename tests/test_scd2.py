from __future__ import annotations

import itertools
import random
from datetime import datetime

from pyspark.sql import functions as F

from repopulse.operators.actors import DIMENSION_COLUMNS, prepare_actor_details
from repopulse.operators.scd2 import OPEN_END, current_versions, first_versions, scd2_apply, scd2_changes
from repopulse.operators.upsert import upsert_newest
from repopulse.sinks.keyed import (
    _folded,
    compact,
    compact_dimension,
    create_current_view,
    read_dimension,
    read_keyed,
    scd2_merge_table,
    size_classes,
    upsert_table,
)

T1, T2, T3 = (datetime(2025, 9, day) for day in (1, 2, 3))


def batch(spark, at, **hashes):
    df = spark.createDataFrame(list(hashes.items()), "user_id STRING, hash_diff STRING")
    return first_versions(df, at)


def state(df):
    rows = df.collect()
    return sorted((r.user_id, r.hash_diff, r.valid_from, r.valid_to, r.is_current) for r in rows)


def test_insert_keep_close_and_replay(spark):
    target = batch(spark, T1, a="1", b="1", c="1")
    change = batch(spark, T2, a="1", b="2", d="1")
    out = scd2_apply(target, change, "user_id")
    expected = [
        ("a", "1", T1, OPEN_END, True),
        ("b", "1", T1, T2, False),
        ("b", "2", T2, OPEN_END, True),
        ("c", "1", T1, OPEN_END, True),
        ("d", "1", T2, OPEN_END, True),
    ]
    assert state(out) == expected
    assert state(scd2_apply(out, change, "user_id")) == expected
    kinds = {r.user_id: r.change for r in scd2_changes(target, change, "user_id").collect()}
    assert kinds == {"b": "update", "d": "insert"}


def test_a_stale_batch_changes_nothing(spark):
    target = batch(spark, T2, a="2")
    out = scd2_apply(target, batch(spark, T1, a="1"), "user_id")
    assert state(out) == [("a", "2", T2, OPEN_END, True)]
    assert scd2_changes(target, batch(spark, T1, a="1"), "user_id").count() == 0


def test_a_closed_key_can_change_again(spark):
    dimension = batch(spark, T1, a="1")
    for at, value in ((T2, "2"), (T3, "1")):
        dimension = scd2_apply(dimension, batch(spark, at, a=value), "user_id")
    assert state(dimension) == [
        ("a", "1", T1, T2, False),
        ("a", "1", T3, OPEN_END, True),
        ("a", "2", T2, T3, False),
    ]
    assert current_versions(dimension).count() == 1


RAW = (
    "user_id BIGINT, login STRING, name STRING, company STRING, location STRING, "
    "followers_count BIGINT, following_count BIGINT, user_created_at TIMESTAMP_NTZ, "
    "user_updated_at TIMESTAMP_NTZ, ingested_at TIMESTAMP_NTZ"
)


def prepared(spark, at, rows):
    raw = spark.createDataFrame(
        [(i, f"l{i}", f"n{i}", company, where, 0, 0, None, None, at) for i, company, where in rows], RAW
    )
    places = spark.createDataFrame([("seoul", "Korea", 1)], "token STRING, country STRING, priority INT")
    codes = spark.createDataFrame([("Korea", "KOR")], "country STRING, country_code STRING")
    return prepare_actor_details(raw, places, codes, at)


def test_prepared_details(spark):
    rows = prepared(spark, T1, [(1, "@acme", "Seoul"), (2, None, None)]).orderBy("user_id").collect()
    assert tuple(rows[0].__fields__) == DIMENSION_COLUMNS
    assert (rows[0].company, rows[0].country, rows[0].country_code) == ("Acme", "Korea", "KOR")
    assert (rows[1].company, rows[1].country, rows[1].country_code) == (None, None, "UNKNOWN")


def test_dimension_table_survives_replay(spark, lake):
    table = "silver/actor_detail_scd"
    first = prepared(spark, T1, [(i, "a", "Seoul") for i in range(20)])
    second = prepared(spark, T2, [(i, "b" if i < 10 else "a", "Seoul") for i in range(25)])
    scd2_merge_table(lake, first, table, 1)
    expected = state(scd2_apply(first, second, "user_id"))
    for batch, number in ((second, 2), (second, 2), (first, 1)):
        scd2_merge_table(lake, batch, table, number)
        assert state(read_dimension(lake, table).select(*first.columns)) == expected
    some = spark.createDataFrame([(3,), (24,)], "user_id BIGINT")
    assert read_dimension(lake, table, only=some).count() == 3


LATE = {1: {1: "a", 2: "a"}, 2: {1: "b", 3: "a"}, 3: {1: "a", 2: "b", 3: "a"}, 4: {2: "b", 1: "a"}}


def sighted(spark, lake, table, numbers):
    for n in numbers:
        rows = [(i, company, "Seoul") for i, company in LATE[n].items()]
        scd2_merge_table(lake, prepared(spark, datetime(2025, 9, n), rows), table, n)


def test_batches_in_any_order_leave_one_history(spark, lake):
    by_step = None
    for n in LATE:
        rows = [(i, company, "Seoul") for i, company in LATE[n].items()]
        batch = prepared(spark, datetime(2025, 9, n), rows)
        by_step = batch if by_step is None else scd2_apply(by_step, batch, "user_id").checkpoint()
    expected = state(by_step)
    assert len(expected) == 6
    for order in [(*first, 4) for first in itertools.permutations((1, 2, 3))] + [(4, 3, 2, 1)]:
        table = "t/" + "".join(map(str, order))
        sighted(spark, lake, table, order)
        assert state(read_dimension(lake, table)) == expected


def test_sightings_are_folded(spark, lake):
    sighted(spark, lake, "t/d", [1, 2, 4, 3])
    expected = state(read_dimension(lake, "t/d"))
    compact_dimension(lake, "t/d", "user_id", 4)
    assert lake.partitions("t/d") == ["batch=3", "batch=4"]
    assert lake.read("t/d").where("batch = 3").count() == 6
    for _ in range(2):
        assert state(read_dimension(lake, "t/d")) == expected
        compact_dimension(lake, "t/d", "user_id", 9)
    assert lake.partitions("t/d") == ["batch=4"]


def test_the_current_view_follows_the_files(spark, lake):
    sighted(spark, lake, "t/v", [1])
    create_current_view(lake, "t/v", "current_people")
    sighted(spark, lake, "t/v", [3, 2])
    create_current_view(lake, "t/v", "current_people")
    shown = {(r.user_id, r.company, r.valid_from) for r in spark.table("current_people").collect()}
    current = read_dimension(lake, "t/v").where("is_current").collect()
    assert shown == {(r.user_id, r.company, r.valid_from) for r in current}
    assert spark.catalog.tableExists("current_people")
    assert not spark.catalog.getTable("current_people").isTemporary


def test_upserts_write_their_rows_only(spark, lake):
    table = "t/master"
    target = spark.range(100).select("id", F.lit(1).alias("version"))
    upsert_table(lake, target, table, 1)
    source = spark.createDataFrame([(5, 2), (7, 0), (500, 1), (8, None)], "id BIGINT, version INT")
    before = lake.read(table).inputFiles()
    for _ in range(2):
        upsert_table(lake, source, table, 2)
    assert set(before) < set(lake.read(table).inputFiles())
    assert lake.read(table).count() == 104
    merged = state_of(upsert_newest(target, source, "id", "version"))
    assert state_of(read_keyed(lake, table, "id", "version")) == merged
    for _ in range(2):
        compact(lake, table, "id", "version", fan=2)
        assert state_of(read_keyed(lake, table, "id", "version")) == merged
    assert lake.partitions(table) == ["batch=2"]
    one = spark.createDataFrame([(5,)], "id BIGINT")
    assert state_of(read_keyed(lake, table, "id", "version", only=one)) == {5: 2}


def test_a_null_version_of_the_first_batch_stays(spark, lake):
    schema = "id BIGINT, version INT"
    upsert_table(lake, spark.createDataFrame([(1, None), (2, 1)], schema), "t/m", 1)
    upsert_table(lake, spark.createDataFrame([(1, 5), (2, None)], schema), "t/m", 2)
    assert state_of(read_keyed(lake, "t/m", "id", "version")) == {1: None, 2: 1}


def test_folding_any_neighbours_changes_nothing(spark, lake):
    """Every way to fold three batches, with null versions and ties, reads as the batches did."""
    rng = random.Random(3)
    values = [None, 1, 2, 3]
    batches = {n: [(i, rng.choice(values), n) for i in range(60) if rng.random() < 0.7] for n in (1, 2, 3)}
    schema = "id INT, version INT, came INT"

    def written(table):
        for n, rows in batches.items():
            upsert_table(lake, spark.createDataFrame(rows, schema), table, n, "id")

    def seen(table):
        return {r.id: (r.version, r.came) for r in read_keyed(lake, table, "id", "version").collect()}

    written("t/plain")
    expected = seen("t/plain")
    for k, names in enumerate((["batch=1", "batch=2"], ["batch=2", "batch=3"], ["batch=1", "batch=2", "batch=3"])):
        written(f"t/{k}")
        rows = lake.read(f"t/{k}").where(F.col("batch").isin([int(n[6:]) for n in names]))
        lake.rewrite_partition(_folded(rows, "id", "version"), f"t/{k}", names[-1])
        lake.drop_partitions(f"t/{k}", names[:-1])
        assert seen(f"t/{k}") == expected


def test_size_classes():
    mb = 1 << 20
    small = [(f"b{n}", mb) for n in range(3)]
    assert size_classes(small, 4) == []
    assert size_classes([*small, ("b3", mb)], 4) == [["b0", "b1", "b2", "b3"]]
    # The large one is left alone until three more of its class follow.
    assert size_classes([("big", 900 * mb), *small, ("b3", mb)], 4) == [["b0", "b1", "b2", "b3"]]
    sixteen = [(f"b{n}", 20 * mb) for n in range(16)]
    assert size_classes(sixteen, 4) == [[name for name, _ in sixteen]]


def test_few_keys_open_few_row_groups(spark, lake):
    """Ten keys out of a million, in a folded table and in a batch of its own."""
    rows = spark.range(1_000_000).select(F.xxhash64("id").alias("id"), F.lit(1).alias("version"), F.lit("x" * 40).alias("pad"))
    upsert_table(lake, rows.repartition(2), "t/keys", 1, "id")
    upsert_table(lake, rows.limit(10), "t/keys", 2, "id")
    compact(lake, "t/keys", "id", "version", fan=2)
    asked = [row.id for row in spark.range(5, 15).select(F.xxhash64("id").alias("id")).collect()]
    found = read_keyed(lake, "t/keys", "id", "version", only=asked)
    assert found.count() == 10
    found.collect()
    scanned = []
    plan = found._jdf.queryExecution().executedPlan()
    leaves = plan.finalPhysicalPlan().collectLeaves() if "Adaptive" in plan.nodeName() else plan.collectLeaves()
    todo = [leaves.apply(k) for k in range(leaves.size())]
    while todo:
        node = todo.pop()
        if "QueryStage" in node.nodeName():
            inner = node.plan().collectLeaves()
            todo += [inner.apply(k) for k in range(inner.size())]
        elif node.nodeName().startswith("Scan"):
            scanned.append(node.metrics().apply("numOutputRows").value())
    assert scanned and sum(scanned) < 300_000
    many = spark.range(5, 3000).select(F.xxhash64("id").alias("id"))
    assert read_keyed(lake, "t/keys", "id", "version", only=many).count() == 2995


def state_of(df):
    return {r.id: r.version for r in df.collect()}
