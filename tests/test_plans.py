"""Plans that must keep their shape to hold at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from repopulse.functions.timeframes import Interval
from repopulse.operators.events import typed_events
from repopulse.operators.latest import latest_per_key
from repopulse.operators.point_in_time import point_in_time_join
from repopulse.operators.rank import distributed_ranks
from repopulse.plans import jobs
from repopulse.plans.catalogue import QUERIES
from repopulse.sources.driver_tables import bronze_events

SF_DIR = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranking_scans_the_events_once(spark):
    plan = final_plan(QUERIES["q_repo_metrics_hourly"](spark, SF_DIR))
    assert plan.count("FileScan parquet [ts#") == 1
    assert "ReusedExchange" in plan


def test_hourly_ranks_never_meet_in_one_partition(spark):
    assert "SinglePartition" not in planned(QUERIES["q_repo_metrics_hourly"](spark, SF_DIR))


def test_global_rank_sends_only_slice_sizes_to_one_partition(spark):
    df = spark.range(1000).select(F.col("id").alias("repo_id"), (F.col("id") % 7).alias("stars"))
    plan = planned(distributed_ranks(df, {"r": "stars"}, "repo_id"))
    before_single = plan.split("SinglePartition")
    assert len(before_single) <= 2
    if len(before_single) == 2:
        assert "HashAggregate" in before_single[1].splitlines()[1]


# These end in a read of the table they wrote; the enrichment is Python by nature.
NOT_PLANNED = {
    "q_ingest_bronze", "q_ingest_to_silver", "q_upsert_repo_master", "q_scd2_merge_table",
    "q_sink_roundtrip", "q_partition_overwrite", "q_recompute_window", "q_schema_evolve",
    "q_serving_table_daily", "q_repo_metrics_daily_job", "q_repo_metrics_hourly_late", "q_wap_publish", "q_partition_enrich",
    "q_ingest_landed", "q_scd2_late_batch", "q_current_actor_view",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NOT_PLANNED))
def test_no_python_and_no_cross_join(spark, name):
    plan = planned(QUERIES[name](spark, SF_DIR))
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    plan = planned(latest_per_key(df, "k", ["t"]))
    limit_after, _, rest = plan.partition("Exchange hashpartitioning")
    assert "WindowGroupLimit" in limit_after and "WindowGroupLimit" in rest


def test_filters_of_silver_reach_the_files(spark, lake):
    source = bronze_events(spark, SF_DIR).withColumn("created_at", F.col("created_at").cast("string"))
    lake.overwrite_hours(source, jobs.BRONZE_EVENTS)
    window = Interval.of("2024-01-15T09:00:00", "2024-01-15T12:00:00")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = planned(typed_events(lake.read_window(jobs.BRONZE_EVENTS, window), ["WatchEvent"]))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    # The other hours' folders are not even listed.
    listed = lake.read_window(jobs.BRONZE_EVENTS, window).inputFiles()
    assert {file.split("ingested_hour=")[1][:10] for file in listed} <= set(map(str, window.hour_keys()))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    for condition in ("EqualTo(type,WatchEvent)", "IsNotNull(repo.id)", "IsNotNull(actor.id)"):
        assert condition in pushed
    columns = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "repo:struct<id:bigint>" in columns
    assert "avatar_url" not in columns


def test_point_in_time_join_is_a_merge(spark):
    happened = spark.range(10).select(F.col("id").alias("actor_id"), F.col("id").alias("created_at"))
    versions = spark.range(10).select(
        F.col("id").alias("user_id"), F.lit(0).alias("valid_from"), F.lit(9).alias("valid_to")
    )
    plan = planned(point_in_time_join(happened, versions))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Window" in plan


def test_contributions_hash_the_slice_of_the_dimension(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = planned(QUERIES["q_contribution_daily"](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin [_key" in plan
