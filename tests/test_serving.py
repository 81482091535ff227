from __future__ import annotations

from datetime import date, datetime

from repopulse.functions.timeframes import Interval
from repopulse.sinks import serving


def test_statements():
    upsert, drop = serving.merge_statements("repo_metrics_daily")
    assert upsert == (
        "INSERT INTO repo_metrics_daily "
        "(repo_id, star_count, fork_count, pr_count, issues_count, push_count, created_date) "
        "SELECT repo_id, star_count, fork_count, pr_count, issues_count, push_count, created_date "
        "FROM repo_metrics_daily_staging ON CONFLICT (repo_id, created_date) DO UPDATE SET "
        "star_count = excluded.star_count, fork_count = excluded.fork_count, "
        "pr_count = excluded.pr_count, issues_count = excluded.issues_count, "
        "push_count = excluded.push_count"
    )
    assert drop == "DROP TABLE IF EXISTS repo_metrics_daily_staging"


def test_statement_runs_as_sql():
    """The upsert text is valid beyond its spelling: DuckDB speaks the same dialect here."""
    import duckdb

    db = duckdb.connect()
    shape = ", ".join(f"{c} INT" for c in serving.SERVING_TABLES["repo_metrics_daily"]["columns"])
    db.execute(f"CREATE TABLE repo_metrics_daily ({shape}, PRIMARY KEY (repo_id, created_date))")
    db.execute(f"CREATE TABLE repo_metrics_daily_staging ({shape})")
    db.execute("INSERT INTO repo_metrics_daily VALUES (1, 1, 1, 1, 1, 1, 9)")
    db.execute("INSERT INTO repo_metrics_daily_staging VALUES (1, 2, 2, 2, 2, 2, 9), (1, 3, 3, 3, 3, 3, 8)")
    for text in serving.merge_statements("repo_metrics_daily"):
        db.execute(text)
    rows = db.execute("SELECT star_count, created_date FROM repo_metrics_daily ORDER BY 2").fetchall()
    assert rows == [(3, 8), (2, 9)]


def test_target_from_conf_and_options(spark):
    settings = {"url": "jdbc:postgresql://db/serving", "user": "u", "password": "secret"}
    for key, value in settings.items():
        spark.conf.set(f"spark.datasource.jdbc.{key}", value)
    target = serving.JdbcTarget.from_conf(spark)
    assert "secret" not in repr(target)
    assert target.write_options("t_staging") == {
        "url": "jdbc:postgresql://db/serving", "dbtable": "t_staging", "user": "u",
        "password": "secret", "driver": "org.postgresql.Driver", "batchsize": "5000", "truncate": "true",
    }


def test_slices(spark):
    df = spark.createDataFrame(
        [(1, date(2025, 9, 17), datetime(2025, 9, 17, 11)), (2, date(2025, 9, 18), datetime(2025, 9, 17, 12))],
        "id INT, created_date DATE, ingested_at TIMESTAMP_NTZ",
    )
    assert [r.id for r in serving.staged_day(df, "2025-09-17").collect()] == [1]
    assert [r.id for r in serving.staged_day(df, date(2025, 9, 18)).collect()] == [2]
    assert [r.id for r in serving.staged_window(df, Interval.hour("2025-09-17T12:00:00")).collect()] == [2]
