"""Slices of gold tables staged for, and merged into, a serving database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.timeframes import Interval, hour_key
from repopulse.operators.upsert import upsert_replace, upsert_statement
from repopulse.sinks.lake import HOUR_PARTITION, Lake

# Rows per insert batch, and the most connections that write at once.
BATCH_ROWS = 5000
WRITE_CONNECTIONS = 8

# Columns and keys of the serving tables.
SERVING_TABLES = {
    "repo_metrics_hourly": {
        "columns": (
            "repo_name", "repo_id", "star_count", "fork_count", "ingested_at",
            "star_rank", "fork_rank", "prev_star_count", "prev_fork_count",
            "prev_star_rank", "prev_fork_rank", "star_trend", "fork_trend", "is_new",
        ),
        "keys": ("repo_id", "ingested_at"),
    },
    "repo_metrics_daily": {
        "columns": (
            "repo_id", "star_count", "fork_count", "pr_count", "issues_count",
            "push_count", "created_date",
        ),
        "keys": ("repo_id", "created_date"),
    },
    "repo_contribution_metrics_daily": {
        "columns": (
            "repo_id", "country_code", "star_event_count", "fork_event_count",
            "pr_event_count", "issues_event_count", "push_event_count", "created_date",
        ),
        "keys": ("repo_id", "created_date", "country_code"),
    },
}


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"

    @classmethod
    def from_conf(cls, spark: SparkSession) -> JdbcTarget:
        """Connection settings kept in the session under ``spark.datasource.jdbc.*``."""
        prefix = "spark.datasource.jdbc"
        return cls(
            spark.conf.get(f"{prefix}.url"),
            spark.conf.get(f"{prefix}.user"),
            spark.conf.get(f"{prefix}.password"),
            spark.conf.get(f"{prefix}.driver", cls.driver),
        )

    def write_options(self, table: str) -> dict[str, str]:
        """``truncate`` keeps the staging table's definition when its rows are replaced."""
        return {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "batchsize": str(BATCH_ROWS),
            "truncate": "true",
        }


def staged_day(gold: DataFrame, day: str | date, column: str = "created_date") -> DataFrame:
    return gold.where(F.col(column) == F.lit(str(day)).cast("date"))


def staged_window(gold: DataFrame, interval: Interval, column: str = "ingested_at") -> DataFrame:
    return gold.where(interval.contains(column))


def stage(
    df: DataFrame, target: JdbcTarget, table: str, connections: int = WRITE_CONNECTIONS
) -> None:
    """Replace the rows of a staging table. More connections write in parallel.

    The shuffle before the writer leaves the scan its own number of tasks.
    """
    (
        df.repartition(connections)
        .write.format("jdbc")
        .options(**target.write_options(table))
        .mode("overwrite")
        .save()
    )


def merge_statements(table: str) -> list[str]:
    """What turns a filled ``<table>_staging`` into rows of ``table``."""
    staging = f"{table}_staging"
    shape = SERVING_TABLES[table]
    return [
        upsert_statement(table, staging, shape["columns"], shape["keys"]),
        f"DROP TABLE IF EXISTS {staging}",
    ]


def run_statements(spark: SparkSession, target: JdbcTarget, statements: list[str]) -> None:
    """Run statements on the serving database in one transaction."""
    spark._jvm.java.lang.Class.forName(target.driver)
    connection = spark._jvm.java.sql.DriverManager.getConnection(
        target.url, target.user, target.password
    )
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        connection.commit()
    finally:
        connection.close()


def upsert_served(lake: Lake, staged: DataFrame, table: str) -> None:
    """The same merge for a serving table kept in the lake.

    Only the hours or days that occur in ``staged`` are read and rewritten.
    """
    shape = SERVING_TABLES[table]
    served, keys = f"serving/{table}", shape["keys"]
    rows = staged.select(*shape["columns"])
    partition = "created_date"
    if "ingested_at" in keys:
        partition = HOUR_PARTITION
        rows = rows.withColumn(HOUR_PARTITION, hour_key("ingested_at"))
    if lake.exists(served):
        touched = rows.select(partition).distinct()
        target = lake.read(served).join(touched, partition, "left_semi")
        rows = upsert_replace(target, rows, keys)
    lake.overwrite_partitions(rows, served, [partition])
