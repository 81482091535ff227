"""The model's input frames, derived from the test tables.

Attributes the tables lack are derived from their values: bot logins and late
arrival from an event's ``value``, actor details from customer and nation. All
rows of a table are used, but for two sets that are left out so that their cases
occur: the customers of one market segment come with the second batch only, and
one nation is missing from the gazetteer.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.timeframes import hour_of, ntz_literal
from repopulse.operators.events import typed_events

EVENT_TYPE_OF = {
    "purchase": "WatchEvent",
    "signup": "ForkEvent",
    "error": "PullRequestEvent",
    "view": "IssuesEvent",
    "click": "PushEvent",
}
ACTION_OF = {"purchase": "started", "error": "opened", "view": "closed"}
BOT_BELOW = 5.0
LATE_FROM = 150.0
FIRST_BATCH = datetime(2024, 1, 1)
SECOND_BATCH = datetime(2024, 1, 10)
JOINS_LATER = "BUILDING"
MOVES_COMPANY_BELOW = 2000.0


# Declared, so that no query pays for a look into the files first.
COLUMNS = {
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(COLUMNS[table]).parquet(f"{sf_dir}/{table}.parquet")


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the shape of the bronze event table."""
    user = F.col("user_id").cast("string")
    repo = F.regexp_extract("props", r"(\d+)", 1)
    login = F.concat(F.lit("user"), user, F.when(F.col("value") < BOT_BELOW, "[bot]").otherwise(""))
    kind = F.col("event_type")
    event_type, action = kind, F.lit("")
    for source, target in EVENT_TYPE_OF.items():
        event_type = F.when(kind == source, target).otherwise(event_type)
    for source, verb in ACTION_OF.items():
        action = F.when(kind == source, f'"action":"{verb}",').otherwise(action)
    late = F.when(F.col("value") >= LATE_FROM, F.expr("INTERVAL 1 HOUR")).otherwise(
        F.expr("INTERVAL 0 HOUR")
    )
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        event_type.alias("type"),
        F.struct(
            F.col("user_id").alias("id"),
            login.alias("login"),
            login.alias("display_login"),
            F.lit("").alias("gravatar_id"),
            F.concat(F.lit("users/"), user).alias("url"),
            F.concat(F.lit("avatars/"), user).alias("avatar_url"),
        ).alias("actor"),
        F.struct(
            repo.cast("bigint").alias("id"),
            F.concat(F.lit("owner"), user, F.lit("/repo"), repo).alias("name"),
            F.concat(F.lit("repos/"), repo).alias("url"),
        ).alias("repo"),
        F.concat(F.lit("{"), action, F.lit('"k":'), repo, F.lit("}")).alias("payload_raw"),
        F.col("ts").alias("created_at"),
        (hour_of("ts") + late).alias("ingested_at"),
    )


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_events(bronze_events(spark, sf_dir))


def repo_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("repo_id"), F.col("p_name").alias("repo_name")
    )


def raw_actor_details(spark: SparkSession, sf_dir: str, batch_time: datetime) -> DataFrame:
    """Customers as actor details of one batch.

    The first batch does not know the customers of one market segment yet; by
    the second, customers with a low balance have moved to another company.
    """
    customers = read(spark, sf_dir, "customer")
    nations = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    if batch_time < SECOND_BATCH:
        customers = customers.where(F.col("c_mktsegment") != JOINS_LATER)
        employer = F.lit("")
    else:
        employer = F.when(F.col("c_acctbal") < MOVES_COMPANY_BELOW, " & new!").otherwise("")
    key = F.col("c_custkey").cast("string")
    location = F.when(
        F.col("c_acctbal") >= 0,
        F.concat("c_mktsegment", F.lit(" (near), "), "n_name", F.lit("  ["), "r_name", F.lit("]")),
    )
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("user"), key).alias("login"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("@"), F.lower("c_mktsegment"), F.lit(" works, inc."), employer).alias("company"),
        location.alias("location"),
        F.col("c_nationkey").cast("bigint").alias("followers_count"),
        F.col("n_regionkey").cast("bigint").alias("following_count"),
        ntz_literal(FIRST_BATCH).alias("user_created_at"),
        ntz_literal(batch_time).alias("user_updated_at"),
        ntz_literal(batch_time).alias("ingested_at"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gazetteer: nations first, then regions; one nation is missing from it."""
    nations = read(spark, sf_dir, "nation").where(F.col("n_name") != "NATION_7")
    regions = read(spark, sf_dir, "region")
    return nations.select(
        F.lower("n_name").alias("token"),
        F.col("n_name").alias("country"),
        F.col("n_nationkey").alias("priority"),
    ).unionByName(
        regions.select(
            F.lower("r_name").alias("token"),
            F.col("r_name").alias("country"),
            (F.col("r_regionkey") + 100).alias("priority"),
        )
    )


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of the nations; regions have none."""
    return read(spark, sf_dir, "nation").select(
        F.col("n_name").alias("country"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("country_code"),
    )
