from __future__ import annotations

import gzip
import json

import pytest

from repopulse import __main__ as cli
from repopulse.plans import jobs
from repopulse.sources.archive import archive_path, as_bronze, hours_of_interval, missing_hours
from repopulse.sources.reference_lists import places_and_codes
from repopulse.functions.timeframes import Interval, parse_utc
from pyspark.sql import functions as F


def test_jobs_from_the_command_line(spark, lake, tmp_path, capsys):
    raw = tmp_path / "2025-09-17-10.json.gz"
    row = {
        "id": "1", "type": "WatchEvent", "actor": {"id": 1, "login": "a"}, "repo": {"id": 7, "name": "r"},
        "payload": {"action": "started"}, "created_at": "2025-09-17T10:00:00Z",
    }
    with gzip.open(raw, "wt") as out:
        out.write(json.dumps(row) + "\n")
    window = ["--data_interval_start", "2025-09-17T10:20:00Z", "--data_interval_end", "2025-09-17T11:20:00Z"]
    root = ["--lake", lake.root]
    cli.main(["ingest-hour", *root, "--source_path", str(raw), "--data_interval_start", "2025-09-17T10:10:00Z"])
    assert capsys.readouterr().out == "ingest-hour: 1\n"
    cli.main(["check-events", *root, *window, "--run_id", "r", "--mode", "fail"])
    for job in ("extract-actor-meta", "extract-repo-meta", "load-actor-master", "load-repo-master",
                "transform-silver", "repo-metrics-hourly"):
        cli.main([job, *root, *window])
    printed = capsys.readouterr().out.splitlines()
    assert "extract-actor-meta: 1" in printed
    assert "repo-metrics-hourly: {'stars': 1, 'forks': 0}" in printed
    cli.main(["repo-metrics-daily", *root, "--target_date", "2025-09-17"])
    assert lake.read(jobs.REPO_HOURLY).first().repo_name == "r"
    assert lake.read(jobs.REPO_DAILY).first().star_count == 1


def test_missing_arguments_are_refused():
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["transform-silver", "--lake", "x"])


def test_reference_lists(spark, tmp_path):
    (tmp_path / "countries.csv").write_text(
        "alpha_2,alpha_3,name,official_name,common_name\nKR,KOR,Korea,Republic of Korea,South Korea\n"
    )
    (tmp_path / "subdivisions.csv").write_text("position,name,country_code\n1,Seoul,KR\n")
    places, codes = places_and_codes(spark, str(tmp_path / "subdivisions.csv"), str(tmp_path / "countries.csv"))
    assert [tuple(r) for r in places.select("token", "country", "priority").collect()] == [("seoul", "Korea", 1)]
    assert {r.country for r in codes.collect()} == {"kr", "kor", "korea", "republic of korea", "south korea"}


def test_parsed_payload_is_written_back_to_text(spark):
    raw = spark.sql(
        "SELECT 'a' AS id, named_struct('action', 'started', 'size', CAST(NULL AS INT)) AS payload"
    )
    row = as_bronze(raw, F.lit("t")).first()
    assert json.loads(row.payload_raw) == {"action": "started"}
    assert "payload" not in row.__fields__


def test_hours_still_to_load(spark):
    interval = Interval.of("2025-09-17T08:10:00", "2025-09-17T11:10:00")
    landed = spark.sql("SELECT TIMESTAMP_NTZ '2025-09-17 09:30:00' AS ingested_at")
    rows = missing_hours(hours_of_interval(spark, interval), landed).orderBy("hour").collect()
    assert [r.archive_key for r in rows] == ["raw/archive/2025-09-17-08.json.gz", "raw/archive/2025-09-17-10.json.gz"]
    assert [r.remote_file for r in rows] == ["2025-09-17-8.json.gz", "2025-09-17-10.json.gz"]
    assert archive_path(parse_utc("2025-09-17T08:00:00"), "raw/archive") == rows[0].archive_key
    empty = Interval.of("2025-09-17T08:10:00", "2025-09-17T08:20:00")
    assert hours_of_interval(spark, empty).count() == 0
