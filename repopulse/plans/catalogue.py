"""Every operator as a query over the test tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.text import (
    change_hash,
    clean_company,
    clean_location,
    strip_company,
    user_node_id,
)
from repopulse.functions.timeframes import (
    DAY,
    HOUR,
    Interval,
    hour_key,
    hour_of,
    ntz_literal,
)
from repopulse.operators import country, enrich, events, metrics, quality, rank, scd2, upsert
from repopulse.operators.actors import prepare_actor_details
from repopulse.operators.latest import latest_per_key
from repopulse.operators.point_in_time import point_in_time_join
from repopulse.plans import jobs
from repopulse.session import scratch_path
from repopulse.sinks.keyed import (
    compact,
    create_current_view,
    read_dimension,
    read_keyed,
    scd2_merge_table,
    upsert_table,
)
from repopulse.sinks.lake import BLOCK_PARTITION, HOUR_PARTITION, Lake
from repopulse.sinks.serving import SERVING_TABLES, staged_day, staged_window, upsert_served
from repopulse.sources import archive, driver_tables as tables
from repopulse.streaming.microbatch import recompute_interval, replace_window

Query = Callable[[SparkSession, str], DataFrame]

# The fortnight, day and hour that window queries ask for.
FORTNIGHT = Interval.of("2024-01-08T00:20:00", "2024-01-22T00:20:00")
STAGED_DAY = "2024-01-15"
LATE_RUN = Interval.of("2024-01-15T11:20:00", "2024-01-15T12:20:00")
THIRD_BATCH = datetime(2024, 1, 20)
MASTER_BEFORE = ("PushEvent", "PullRequestEvent")
LARGE_VOLUME_BATCHES = (datetime(1996, 1, 1), datetime(1998, 1, 1))


def _lake(spark: SparkSession, name: str) -> Lake:
    return Lake(spark, scratch_path(spark, name))


# -- windows and ingest ------------------------------------------------------------


def q_window_filter(spark: SparkSession, sf: str) -> DataFrame:
    bronze = tables.bronze_events(spark, sf)
    return bronze.where(FORTNIGHT.aligned("hour").contains("ingested_at")).select(
        "id", "type", "ingested_at"
    )


def q_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.counts_per_hour(tables.silver_events(spark, sf))


def q_hour_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Hours in which no late star landed."""
    bronze = tables.bronze_events(spark, sf)
    spine = archive.hours_in(archive.hour_bounds(bronze))
    late = F.col("ingested_at") != hour_of("created_at")
    return archive.missing_hours(spine, bronze.where((F.col("type") == "WatchEvent") & late))


def _raw_files(spark: SparkSession, sf: str) -> str:
    """The events as gzip JSON lines, one folder per ingest hour."""
    bronze = tables.bronze_events(spark, sf)
    payload = F.from_json("payload_raw", "action STRING, k BIGINT")
    raw = bronze.select(
        "id",
        "type",
        "actor",
        "repo",
        payload.alias("payload"),
        F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        hour_key("ingested_at").alias(HOUR_PARTITION),
    )
    path = scratch_path(spark, "raw")
    raw.hint("rebalance", F.col(HOUR_PARTITION)).write.mode("overwrite").option(
        "compression", "gzip"
    ).partitionBy(HOUR_PARTITION).json(path)
    return path


def _ingested(spark: SparkSession, sf: str) -> DataFrame:
    raw = archive.read_raw_events(spark, _raw_files(spark, sf))
    stamp = F.to_timestamp_ntz(F.col(HOUR_PARTITION).cast("string"), F.lit("yyyyMMddHH"))
    return archive.as_bronze(raw, stamp).drop(HOUR_PARTITION)


def q_ingest_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return _ingested(spark, sf).select(
        "id",
        "type",
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        "payload_raw",
        "created_at",
        "ingested_at",
    )


def q_ingest_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    return events.typed_events(_ingested(spark, sf))


def q_ingest_landed(spark: SparkSession, sf: str) -> DataFrame:
    """The raw files through the file stream, then once more, when there is nothing new."""
    lake = _lake(spark, "landed")
    folder, progress = _raw_files(spark, sf), scratch_path(spark, "landed-progress")
    names = (rf"{HOUR_PARTITION}=(\d{{10}})", "yyyyMMddHH")
    for run in ("first", "second"):
        jobs.ingest_landed(lake, folder, progress, run, files_at_once=2_000, names=names)
    bronze = lake.read(jobs.BRONZE_EVENTS)
    return bronze.select("id", "type", "payload_raw", "created_at", "ingested_at")


def q_actor_meta(spark: SparkSession, sf: str) -> DataFrame:
    return events.actor_attributes(tables.bronze_events(spark, sf))


def q_repo_meta(spark: SparkSession, sf: str) -> DataFrame:
    return events.repo_attributes(tables.bronze_events(spark, sf))


def q_silver_events(spark: SparkSession, sf: str) -> DataFrame:
    return tables.silver_events(spark, sf)


def q_unified_events(spark: SparkSession, sf: str) -> DataFrame:
    bronze = tables.bronze_events(spark, sf)
    return events.union_events(events.typed_events(bronze, [t]) for t in events.EVENT_TABLES)


# -- masters -----------------------------------------------------------------------


def _latest_actor(bronze: DataFrame) -> DataFrame:
    return latest_per_key(events.actor_attributes(bronze), "actor_id", ["created_at", "ingested_at"])


def _latest_repo(bronze: DataFrame) -> DataFrame:
    return latest_per_key(events.repo_attributes(bronze), "repo_id", ["created_at", "ingested_at"])


def q_dedup_latest_actor(spark: SparkSession, sf: str) -> DataFrame:
    return _latest_actor(tables.bronze_events(spark, sf))


def q_dedup_latest_repo(spark: SparkSession, sf: str) -> DataFrame:
    return _latest_repo(tables.bronze_events(spark, sf))


def q_dedup_latest_detail(spark: SparkSession, sf: str) -> DataFrame:
    both = tables.raw_actor_details(spark, sf, tables.FIRST_BATCH).unionByName(
        tables.raw_actor_details(spark, sf, tables.SECOND_BATCH)
    )
    return latest_per_key(both, "user_id", ["ingested_at"]).select(
        "user_id", "login", "company", "ingested_at"
    )


def _master_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    bronze = tables.bronze_events(spark, sf)
    before = F.col("type").isin(*MASTER_BEFORE)
    return bronze.where(before), bronze.where(~before)


def q_upsert_actor_master(spark: SparkSession, sf: str) -> DataFrame:
    before, after = _master_sides(spark, sf)
    return upsert.upsert_newest(
        _latest_actor(before), _latest_actor(after), "actor_id", "created_at"
    )


def q_upsert_repo_master(spark: SparkSession, sf: str) -> DataFrame:
    """Through the table of batches: three batches, folded, read back."""
    before, after = _master_sides(spark, sf)
    lake = _lake(spark, "repo-master")
    table = "master/repo"
    upsert_table(lake, _latest_repo(before), table, 1, "repo_id")
    for _ in range(2):
        upsert_table(lake, _latest_repo(after), table, 2, "repo_id")
    compact(lake, table, "repo_id", "created_at", fan=2)
    return read_keyed(lake, table, "repo_id", "created_at")


# -- actor details -------------------------------------------------------------------


def q_company_clean(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.raw_actor_details(spark, sf, tables.SECOND_BATCH)
    return raw.select(
        "user_id",
        strip_company("company").alias("company_stripped"),
        clean_company("company").alias("company_clean"),
    )


def q_change_hash(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.raw_actor_details(spark, sf, tables.SECOND_BATCH)
    return raw.select("user_id", change_hash(["name", "location", "company"]).alias("hash_diff"))


def q_location_clean(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.raw_actor_details(spark, sf, tables.SECOND_BATCH)
    return raw.select("user_id", clean_location("location").alias("location"))


def q_gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    customers = tables.read(spark, sf, "customer")
    nations = tables.read(spark, sf, "nation")
    subdivisions = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("position"),
        F.concat("c_mktsegment", F.lit("-"), "n_regionkey").alias("name"),
        F.col("c_nationkey").cast("string").alias("country_code"),
    )
    listed = nations.where(F.col("n_name") != "NATION_7").select(
        F.col("n_nationkey").cast("string").alias("alpha_2"), F.col("n_name").alias("name")
    )
    return country.gazetteer(subdivisions, listed)


def _located(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.raw_actor_details(spark, sf, tables.SECOND_BATCH).select("user_id", "location")
    return country.with_country(raw, tables.places(spark, sf))


def q_country_extract(spark: SparkSession, sf: str) -> DataFrame:
    return _located(spark, sf).select("user_id", "country")


def q_country_code(spark: SparkSession, sf: str) -> DataFrame:
    coded = country.with_country_code(_located(spark, sf), tables.codes(spark, sf))
    return coded.select("user_id", "country_code")


def q_node_id(spark: SparkSession, sf: str) -> DataFrame:
    customers = tables.read(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return customers.select("user_id", user_node_id(F.col("user_id").cast("string")).alias("node_id"))


def q_active_actors(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.active_actors(tables.silver_events(spark, sf))


def q_partition_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Answers made from customers travel beside the ids; the lookup hands them on in batches."""
    actors = metrics.active_actors(tables.silver_events(spark, sf))
    answers = tables.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("actor_id"), _customer_node().alias("answer")
    )
    asked = actors.join(answers, "actor_id", "left")

    def lookup(node_ids: Sequence[str], answer: Sequence[str | None]) -> Sequence[str | None]:
        return list(answer)

    return enrich.flatten_nodes(enrich.fetch_nodes(asked, lookup, beside="answer")).select(
        "user_id", "login", "company", "followers_count", "following_count", "user_created_at"
    )


def _customer_node() -> Column:
    """A customer as the source's JSON object; those of one segment are not to be found."""
    node = F.to_json(
        F.struct(
            F.col("c_custkey").alias("databaseId"),
            F.col("c_name").alias("login"),
            F.when(F.col("c_acctbal") >= 0, F.struct(F.col("c_nationkey").alias("totalCount"))).alias(
                "followers"
            ),
            F.when(F.col("c_acctbal") >= 5000, "2021-03-04T05:06:07Z").alias("createdAt"),
        )
    )
    return F.when(F.col("c_mktsegment") != "MACHINERY", node)


def q_api_flatten(spark: SparkSession, sf: str) -> DataFrame:
    responses = tables.read(spark, sf, "customer").select(_customer_node().alias("node"))
    return enrich.flatten_nodes(responses).select(
        "user_id", "login", "company", "followers_count", "following_count", "user_created_at"
    )


# -- slowly changing dimension ---------------------------------------------------------


def _batch(
    spark: SparkSession, sf: str, raw_batch: datetime, valid_from: datetime | None = None
) -> DataFrame:
    return prepare_actor_details(
        tables.raw_actor_details(spark, sf, raw_batch),
        tables.places(spark, sf),
        tables.codes(spark, sf),
        valid_from or raw_batch,
    )


def _dimension(spark: SparkSession, sf: str) -> DataFrame:
    first = _batch(spark, sf, tables.FIRST_BATCH)
    return scd2.scd2_apply(first, _batch(spark, sf, tables.SECOND_BATCH), "user_id")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written once and read back, as the jobs find it: users of it do not compute it again."""
    lake = _lake(df.sparkSession, name)
    lake.replace(df, f"t/{name}")
    return lake.read(f"t/{name}")


def _shown(versions: DataFrame) -> DataFrame:
    """The open end lies beyond what many clients hold as a timestamp: show it as text."""
    return versions.withColumn("valid_to", F.col("valid_to").cast("string"))


def q_scd2_changes(spark: SparkSession, sf: str) -> DataFrame:
    changes = scd2.scd2_changes(
        _batch(spark, sf, tables.FIRST_BATCH), _batch(spark, sf, tables.SECOND_BATCH), "user_id"
    )
    return changes.select("user_id", "company", "country", "hash_diff", "valid_from", "change")


def q_scd2_apply(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_dimension(spark, sf))


def q_scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(scd2.current_versions(_dimension(spark, sf)))


def q_scd2_merge_table(spark: SparkSession, sf: str) -> DataFrame:
    """Through the table: the second batch before the first, then the second again."""
    lake = _lake(spark, "actor-dimension")
    for batch_time in (tables.SECOND_BATCH, tables.FIRST_BATCH, tables.SECOND_BATCH):
        number = int(batch_time == tables.SECOND_BATCH)
        scd2_merge_table(lake, _batch(spark, sf, batch_time), jobs.ACTOR_DETAIL, number)
    return _shown(read_dimension(lake, jobs.ACTOR_DETAIL))


def q_scd2_late_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches, of which the middle one comes last: customers move and move back."""
    lake = _lake(spark, "late-batch")
    back = _batch(spark, sf, tables.FIRST_BATCH, THIRD_BATCH)
    first = _batch(spark, sf, tables.FIRST_BATCH)
    late = _batch(spark, sf, tables.SECOND_BATCH)
    for number, batch in ((1, first), (3, back), (2, late)):
        scd2_merge_table(lake, batch, jobs.ACTOR_DETAIL, number)
    return _shown(read_dimension(lake, jobs.ACTOR_DETAIL))


def q_current_actor_view(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog's view of current actors, created before the batch that changes them."""
    lake = _lake(spark, "current-view")
    name = "current_customers"
    for number, batch_time in enumerate((tables.FIRST_BATCH, tables.SECOND_BATCH)):
        scd2_merge_table(lake, _batch(spark, sf, batch_time), jobs.ACTOR_DETAIL, number)
        if not number:
            create_current_view(lake, jobs.ACTOR_DETAIL, name)
    return spark.table(name).select("user_id", "company", "country", "hash_diff", "valid_from")


def q_pit_join(spark: SparkSession, sf: str) -> DataFrame:
    versions = _stored(_dimension(spark, sf), "dimension").select(
        "user_id", "company", "country", "valid_from", "valid_to"
    )
    joined = point_in_time_join(tables.silver_events(spark, sf), versions)
    return joined.select("event_id", "actor_id", "created_at", "company", "country", "valid_from")


def q_pit_join_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The same join at order volume: orders and the customer version of their date."""
    first, second = LARGE_VOLUME_BATCHES
    dimension = scd2.scd2_apply(
        _batch(spark, sf, tables.FIRST_BATCH, first),
        _batch(spark, sf, tables.SECOND_BATCH, second),
        "user_id",
    )
    versions = _stored(dimension.select("user_id", "company", "valid_from", "valid_to"), "versions")
    orders = tables.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = point_in_time_join(
        orders, versions, event_key="o_custkey", at="o_orderdate", stretch="year"
    )
    return joined.groupBy("company", "valid_from").agg(F.count(F.lit(1)).alias("n_orders"))


def q_contribution_daily(spark: SparkSession, sf: str) -> DataFrame:
    versions = _stored(_dimension(spark, sf), "dimension")
    return metrics.daily_country_contributions(tables.silver_events(spark, sf), versions)


# -- hourly and daily metrics ------------------------------------------------------------


def _hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.hourly_star_fork_counts(tables.silver_events(spark, sf))


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    return rank.with_star_and_fork_ranks(_hourly_counts(spark, sf))


def q_repo_metrics_hourly_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _hourly_counts(spark, sf)


def _totals(spark: SparkSession, sf: str) -> DataFrame:
    return (
        tables.silver_events(spark, sf)
        .groupBy("repo_id")
        .agg(*metrics.type_counts("_count", ("star", "fork")))
    )


def q_rank_stars(spark: SparkSession, sf: str) -> DataFrame:
    ranked = rank.distributed_ranks(_totals(spark, sf), {"star_rank": "star_count"}, "repo_id")
    return ranked.select("repo_id", "star_count", "star_rank")


def q_rank_forks(spark: SparkSession, sf: str) -> DataFrame:
    ranked = rank.distributed_ranks(_totals(spark, sf), {"fork_rank": "fork_count"}, "repo_id")
    return ranked.select("repo_id", "fork_count", "fork_rank")


def q_rank_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The global rank at line-item volume: parts by number of lines."""
    lines = tables.read(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n_lines")
    )
    return rank.distributed_ranks(lines, {"part_rank": "n_lines"}, "l_partkey")


def q_rank_hashed_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The global rank with ids that are strings all over the place: hashes of part keys."""
    lines = tables.read(spark, sf, "lineitem").groupBy(
        F.md5(F.col("l_partkey").cast("string")).alias("part_hash")
    )
    lines = lines.agg(F.count(F.lit(1)).alias("n_lines"))
    return rank.ranks_of_any_ids(lines, {"part_rank": "n_lines"}, "part_hash")


def q_repo_rank_first_load(spark: SparkSession, sf: str) -> DataFrame:
    ranked = _ranked(spark, sf)
    return rank.rank_trend(ranked, ranked.where(F.lit(False)))


def q_repo_rank_trend(spark: SparkSession, sf: str) -> DataFrame:
    ranked = _ranked(spark, sf)
    return rank.rank_trend(ranked, ranked)


def q_repo_metrics_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.hourly_repo_metrics(
        tables.silver_events(spark, sf), tables.repo_names(spark, sf)
    )


def _star_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return rank.distributed_ranks(
        _hourly_counts(spark, sf), {"star_rank": "star_count"}, "repo_id", ["ingested_at"]
    )


def q_hourly_top20(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.hourly_top(_star_ranked(spark, sf))


def q_hourly_top3(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.hourly_top(_star_ranked(spark, sf), 3)


def q_repo_metrics_daily(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.daily_repo_metrics(tables.silver_events(spark, sf))


def q_repo_metrics_daily_top500(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.top_repos(q_repo_metrics_daily(spark, sf))


def _silver_lake(spark: SparkSession, silver: DataFrame, name: str, hours: Interval) -> Lake:
    lake = _lake(spark, name)
    jobs.write_silver(lake, silver, hours)
    return lake


def _all_hours(silver: DataFrame) -> Interval:
    row = archive.hour_bounds(silver).first()
    return Interval(row.first_hour, row.last_hour + HOUR)


def q_repo_metrics_daily_job(spark: SparkSession, sf: str) -> DataFrame:
    """The daily job over all days, in two runs that late events cross between."""
    silver = tables.silver_events(spark, sf)
    days = _all_hours(silver)
    lake = _silver_lake(spark, silver, "daily-job", days)
    middle = FORTNIGHT.aligned("day").start
    for run in (Interval(days.start, middle), Interval(middle, days.end + DAY)):
        jobs.update_repo_metrics_daily(lake, run, top=None)
    return lake.read(jobs.REPO_DAILY)


def q_repo_metrics_hourly_late(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly gold computed without late events, then again for the hours after they came."""
    silver = tables.silver_events(spark, sf)
    whole = _all_hours(silver)
    lake = _silver_lake(spark, _on_time(silver), "hourly-late", whole)
    jobs.update_repo_metrics_hourly(lake, whole)
    jobs.write_silver(lake, silver, whole)
    jobs.update_repo_metrics_hourly(lake, whole)
    return lake.read(jobs.REPO_HOURLY).drop(BLOCK_PARTITION, "repo_name")


# -- serving -----------------------------------------------------------------------------


def q_stage_daily(spark: SparkSession, sf: str) -> DataFrame:
    shape = SERVING_TABLES["repo_metrics_daily"]
    return staged_day(q_repo_metrics_daily(spark, sf), STAGED_DAY).select(*shape["columns"])


def q_stage_hourly(spark: SparkSession, sf: str) -> DataFrame:
    shape = SERVING_TABLES["repo_metrics_hourly"]
    staged = staged_window(q_repo_metrics_hourly(spark, sf), FORTNIGHT.aligned("hour"))
    return staged.select(*shape["columns"])


def _on_time(df: DataFrame) -> DataFrame:
    return df.where(F.col("ingested_at") == hour_of("created_at"))


def _serving_upsert(table: str, build: Callable[[DataFrame], DataFrame], silver: DataFrame) -> DataFrame:
    """On-time events are served; a recount of the fortnight's events, late ones too, is staged."""
    shape = SERVING_TABLES[table]
    window = FORTNIGHT.aligned("day").contains("ingested_at")
    served = build(_on_time(silver)).select(*shape["columns"])
    staged = build(silver.where(window)).select(*shape["columns"])
    return upsert.upsert_replace(served, staged, shape["keys"])


def q_oltp_upsert_hourly(spark: SparkSession, sf: str) -> DataFrame:
    names = tables.repo_names(spark, sf)
    return _serving_upsert(
        "repo_metrics_hourly",
        lambda silver: metrics.hourly_repo_metrics(silver, names),
        tables.silver_events(spark, sf),
    )


def q_oltp_upsert_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _serving_upsert(
        "repo_metrics_daily", metrics.daily_repo_metrics, tables.silver_events(spark, sf)
    )


def q_serving_table_daily(spark: SparkSession, sf: str) -> DataFrame:
    """The daily upsert through a table: on-time counts served, the recount merged in twice."""
    silver = tables.silver_events(spark, sf)
    recount = metrics.daily_repo_metrics(
        silver.where(FORTNIGHT.aligned("day").contains("ingested_at"))
    )
    lake = _lake(spark, "serving")
    upsert_served(lake, metrics.daily_repo_metrics(_on_time(silver)), "repo_metrics_daily")
    for _ in range(2):
        upsert_served(lake, recount, "repo_metrics_daily")
    return lake.read("serving/repo_metrics_daily")


def q_oltp_upsert_contribution(spark: SparkSession, sf: str) -> DataFrame:
    versions = _stored(_dimension(spark, sf), "dimension")
    return _serving_upsert(
        "repo_contribution_metrics_daily",
        lambda silver: metrics.daily_country_contributions(silver, versions),
        tables.silver_events(spark, sf),
    )


# -- tables and replay ---------------------------------------------------------------------


def q_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Created from the on-time events, the late ones appended, read back."""
    silver = tables.silver_events(spark, sf)
    lake = _lake(spark, "roundtrip")
    lake.overwrite_hours(_on_time(silver), "t/events", sort=["repo_id"])
    late = silver.where(F.col("ingested_at") != hour_of("created_at"))
    lake.append_hours(late, "t/events")
    return lake.read("t/events")


def q_partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """All hours written from on-time events, the fortnight's replaced by a full recount, twice."""
    silver = tables.silver_events(spark, sf)
    window = FORTNIGHT.aligned("hour")
    lake = _lake(spark, "overwrite")
    lake.overwrite_hours(metrics.counts_per_hour(_on_time(silver)), "t/counts")
    for _ in range(2):
        replace_window(lake, metrics.counts_per_hour(silver), "t/counts", window)
    return lake.read("t/counts").drop(HOUR_PARTITION)


def q_recompute_window(spark: SparkSession, sf: str) -> DataFrame:
    """A table that missed all late events, after the run of one hour recomputed three."""
    silver = tables.silver_events(spark, sf)
    lake = _lake(spark, "recompute")
    lake.overwrite_hours(_on_time(silver), "t/events")
    replace_window(lake, silver, "t/events", recompute_interval(LATE_RUN))
    return lake.read("t/events").drop(HOUR_PARTITION)


def q_schema_evolve(spark: SparkSession, sf: str) -> DataFrame:
    """Events before the fortnight's end written without ``action``, later ones with it."""
    silver = tables.silver_events(spark, sf)
    added_from = ntz_literal(FORTNIGHT.aligned("hour").end)
    lake = _lake(spark, "evolve")
    lake.overwrite_hours(silver.where(F.col("ingested_at") < added_from).drop("action"), "t/events")
    lake.overwrite_hours(silver.where(F.col("ingested_at") >= added_from), "t/events")
    return lake.read("t/events", merge_schema=True).drop(HOUR_PARTITION)


def q_wap_publish(spark: SparkSession, sf: str) -> DataFrame:
    """Two staged batches: the one with doubled events fails its checks and is discarded."""
    bronze = tables.bronze_events(spark, sf)
    lake = _lake(spark, "wap")
    attempts = {"doubled": bronze.unionByName(bronze), "clean": bronze}
    for name, batch in attempts.items():
        staged = lake.staging(name)
        staged.overwrite_hours(batch, "t/events")
        report = quality.run_checks(staged.read("t/events"), quality.EVENT_CHECKS, name)
        if not quality.failed_checks(report):
            lake.publish(staged, ["t/events"])
        staged.discard()
    return lake.read("t/events").select("id", "type", "created_at", "ingested_at")


# -- data quality ----------------------------------------------------------------------------


def q_dq_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.run_checks(tables.bronze_events(spark, sf), quality.EVENT_CHECKS, "run-1")


def q_dq_report_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """The same checks where they fail: order keys repeat, and there are too many rows."""
    checks = (
        quality.NotNull("l_shipdate"),
        quality.Unique("l_orderkey"),
        quality.RowCount(1, 1000),
    )
    return quality.run_checks(tables.read(spark, sf, "lineitem"), checks, "run-2")


def q_dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicated(tables.read(spark, sf, "lineitem"), "l_orderkey")


QUERIES: dict[str, Query] = {
    name: value for name, value in list(globals().items()) if name.startswith("q_")
}
