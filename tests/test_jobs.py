"""The jobs end to end: raw files of three hours to gold, with late data and replays."""

from __future__ import annotations

import gzip
import json
from datetime import date, datetime

import pytest

from repopulse.functions.timeframes import Interval
from repopulse.operators.quality import QualityError
from repopulse.plans import jobs
from repopulse.sinks.keyed import read_dimension

H10, H11, H12 = (f"2025-09-17T{h}:00:00" for h in (10, 11, 12))


def raw(id, type, actor, repo, at, login=None, **payload):
    return {
        "id": str(id),
        "type": type,
        "actor": {"id": actor, "login": login or f"u{actor}", "display_login": "d", "url": f"users/{actor}"},
        "repo": {"id": repo, "name": f"o/r{repo}@{id}", "url": f"repos/{repo}"},
        "payload": payload,
        "public": True,
        "created_at": f"2025-09-17T{at}Z",
    }


HOURS = {
    H10: [
        raw(1, "WatchEvent", 1, 100, "10:00:00", action="started"),
        raw(2, "WatchEvent", 2, 100, "10:01:00", action="started"),
        raw(3, "ForkEvent", 1, 200, "10:02:00", forkee={"id": 5}),
        raw(4, "WatchEvent", 9, 200, "10:03:00", login="dep[bot]", action="started"),
        raw(5, "GollumEvent", 1, 300, "10:04:00"),
    ],
    H11: [
        raw(6, "WatchEvent", 3, 200, "11:00:00", action="started"),
        raw(7, "WatchEvent", 1, 200, "11:01:00", action="started"),
        raw(8, "WatchEvent", 1, 100, "10:59:00", action="started"),
        raw(9, "PushEvent", 2, 100, "11:02:00", size=2),
        raw(10, "PullRequestEvent", 2, 100, "11:03:00", action="opened"),
        raw(11, "IssuesEvent", 3, 100, "11:04:00", action="closed"),
    ],
    H12: [raw(12, "ForkEvent", 3, 400, "12:00:00"), raw(13, "WatchEvent", 3, 100, "12:00:01", action="started")],
}


@pytest.fixture
def files(tmp_path):
    paths = {}
    for hour, rows in HOURS.items():
        path = tmp_path / f"{hour[:13].replace('T', '-')}.json.gz"
        with gzip.open(path, "wt") as out:
            out.writelines(json.dumps(row) + "\n" for row in rows)
        paths[hour] = str(path)
    return paths


def lookup(node_ids):
    import base64

    users = [int(base64.b64decode(node_id).decode()[7:]) for node_id in node_ids]
    places = {1: "Seoul", 2: "Texas", 3: "nowhere"}
    return [
        f'{{"databaseId": {u}, "login": "u{u}", "name": "n{u}", "company": "@acme{u}", "location": "{places[u]}"}}'
        for u in users
    ]


def reference_lists(spark):
    places = spark.createDataFrame(
        [("seoul", "Korea", 1), ("texas", "United States", 2)], "token STRING, country STRING, priority INT"
    )
    codes = spark.createDataFrame(
        [("Korea", "KOR"), ("United States", "USA")], "country STRING, country_code STRING"
    )
    return places, codes


def snapshot(df):
    return sorted(map(str, df.collect()))


def gold(lake):
    rows = lake.read(jobs.REPO_HOURLY).collect()
    return {
        (r.ingested_at.hour, r.repo_id): (
            r.repo_name, r.star_count, r.fork_count, r.star_rank, r.fork_rank, r.is_new, r.star_trend, r.fork_trend
        )
        for r in rows
    }


def test_three_hours_and_a_day(spark, lake, files):
    rows = [jobs.run_hour(lake, files[hour], hour, f"run-{i}") for i, hour in enumerate(HOURS)]
    assert rows == [5, 6, 2]

    bronze = lake.read(jobs.BRONZE_EVENTS)
    assert bronze.count() == 13
    payload = bronze.where("id = '3'").first().payload_raw
    assert json.loads(payload) == {"forkee": {"id": 5}}

    silver = {r.event_id: r for r in lake.read(jobs.SILVER_EVENTS).collect()}
    assert set(silver) == {"1", "2", "3", "6", "7", "8", "9", "10", "11", "12", "13"}
    assert silver["1"].action == "started" and silver["9"].action is None
    assert silver["8"].created_at == datetime(2025, 9, 17, 10, 59)
    assert jobs.events_of_type(lake, "PushEvent").count() == 1

    jobs.register_event_views(lake)
    assert spark.sql("SELECT count(*) AS n FROM unified_events").first().n == 11
    assert spark.sql("SELECT count(*) AS n FROM fork_events").first().n == 2

    masters = {r.repo_id: r.repo_name for r in jobs.read_master(lake, jobs.REPO_MASTER).collect()}
    assert masters == {100: "o/r100@13", 200: "o/r200@7", 300: "o/r300@5", 400: "o/r400@12"}
    assert jobs.read_master(lake, jobs.ACTOR_MASTER).count() == 4
    jobs.compact_masters(lake)
    assert {r.repo_id: r.repo_name for r in jobs.read_master(lake, jobs.REPO_MASTER).collect()} == masters

    hourly = gold(lake)
    assert {key: value[1:] for key, value in hourly.items()} == {
        (10, 100): (2, 0, 1, 2, True, 0, 0),
        (10, 200): (0, 1, 2, 1, True, 0, 0),
        (11, 200): (2, 0, 1, 2, False, 1, -1),
        (11, 100): (1, 0, 2, 1, False, -1, 1),
        (12, 100): (1, 0, 1, 2, False, 1, -1),
        (12, 400): (0, 1, 2, 1, True, 0, 0),
    }
    # Recomputed with hour 12, and so under the name of that time.
    assert hourly[(10, 100)][0] == "o/r100@13"

    places, codes = reference_lists(spark)
    for hour, expected in ((H10, 2), (H11, 3)):
        summary = jobs.run_actor_hour(lake, hour, lookup, places, codes)
        assert summary == {"found": expected}
    current = {r.user_id: (r.company, r.country_code) for r in jobs.register_actor_view(lake).collect()}
    assert current == {1: ("Acme1", "KOR"), 2: ("Acme2", "USA"), 3: ("Acme3", "UNKNOWN")}

    shown = spark.table(jobs.CURRENT_ACTORS)
    assert {r.user_id: (r.company, r.country_code) for r in shown.collect()} == current

    versions = read_dimension(lake, jobs.ACTOR_DETAIL)
    assert versions.count() == 3 and versions.where("is_current").count() == 3

    jobs.run_day(lake, "2025-09-17")
    daily = {r.repo_id: r for r in lake.read(jobs.REPO_DAILY).collect()}
    top = daily[100]
    assert (top.star_count, top.fork_count, top.pr_count, top.issues_count, top.push_count) == (4, 0, 1, 1, 1)
    assert top.created_date == date(2025, 9, 17) and set(daily) == {100, 200, 400}

    contributions = {
        (r.repo_id, r.country_code): (r.star_event_count, r.fork_event_count, r.push_event_count)
        for r in lake.read(jobs.CONTRIBUTION_DAILY).collect()
    }
    assert contributions == {
        (100, "KOR"): (2, 0, 0), (200, "KOR"): (1, 1, 0), (100, "USA"): (1, 0, 1),
    }

    for _ in range(2):
        for hour in HOURS:
            jobs.serve_hourly(lake, Interval.hour(hour))
        jobs.serve_daily(lake, "2025-09-17")
    assert lake.read("serving/repo_metrics_hourly").count() == len(hourly)
    assert lake.read("serving/repo_metrics_daily").count() == 3
    assert lake.read("serving/repo_contribution_metrics_daily").count() == 3


def test_replaying_an_hour_changes_nothing(spark, lake, files):
    for i, hour in enumerate(HOURS):
        jobs.run_hour(lake, files[hour], hour, f"run-{i}")
    tables = [jobs.BRONZE_EVENTS, jobs.ACTOR_META, jobs.SILVER_EVENTS, jobs.ACTOR_MASTER, jobs.REPO_MASTER]
    before = {table: snapshot(lake.read(table)) for table in tables}
    metrics_before = gold(lake)
    jobs.run_hour(lake, files[H11], H11, "run-1")
    assert {table: snapshot(lake.read(table)) for table in tables} == before
    # Counts, ranks and movement stay; names are looked up in the newer master.
    assert {k: v[1:] for k, v in gold(lake).items()} == {k: v[1:] for k, v in metrics_before.items()}


def test_backfill_equals_hour_by_hour(spark, lake, files):
    for i, hour in enumerate(HOURS):
        jobs.run_hour(lake, files[hour], hour, f"run-{i}")
    by_hour = {k: v[1:] for k, v in gold(lake).items()}
    lake.drop(jobs.REPO_HOURLY)
    seen = jobs.update_repo_metrics_hourly(lake, Interval.of(H10, "2025-09-17T13:00:00"))
    assert seen == {"stars": 6, "forks": 2}
    assert {k: v[1:] for k, v in gold(lake).items()} == by_hour


def test_late_rows_are_picked_up_by_the_next_run(spark, lake, files):
    jobs.ingest_hour(lake, files[H10], H10)
    jobs.transform_silver_events(lake, Interval.hour(H10))
    before = lake.read(jobs.SILVER_EVENTS).count()
    jobs.ingest_hour(lake, [files[H10], files[H11]], H10)
    jobs.transform_silver_events(lake, Interval.hour(H12))
    assert lake.read(jobs.SILVER_EVENTS).count() == before + 6


def test_gold_follows_late_rows(spark, lake, files, tmp_path):
    """A file that comes late: hourly gold equals a recount, the next hour's movement too."""
    jobs.run_hour(lake, files[H10], H10, "r10")
    jobs.run_hour(lake, files[H11], H11, "r11")
    late = tmp_path / "late.json"
    late.write_text(
        "".join(json.dumps(raw(50 + n, "WatchEvent", 5, 200, "10:30:00")) + "\n" for n in range(3))
    )
    jobs.ingest_hour(lake, [files[H10], str(late)], H10)
    jobs.run_hour(lake, files[H12], H12, "r12")
    after = gold(lake)
    assert after[(10, 200)][1:6] == (3, 1, 1, 1, True)
    assert after[(11, 200)][6:] == (0, -1)
    lake.drop(jobs.REPO_HOURLY)
    jobs.update_repo_metrics_hourly(lake, Interval.of(H10, "2025-09-17T13:00:00"))
    assert gold(lake) == after
    assert lake.read("serving/repo_metrics_hourly").where("repo_id = 200 AND star_count = 3").count() == 1


def test_an_hour_recomputed_to_nothing_is_emptied(spark, lake, files):
    jobs.run_hour(lake, files[H10], H10, "r10")
    jobs.run_hour(lake, files[H11], H11, "r11")
    lake.replace_hours(lake.read_window(jobs.BRONZE_EVENTS, Interval.hour(H10)).limit(0), jobs.BRONZE_EVENTS, Interval.hour(H10))
    jobs.run_hour(lake, files[H12], H12, "r12")
    assert {hour for hour, _ in gold(lake)} == {11, 12}
    assert lake.read_window(jobs.SILVER_EVENTS, Interval.hour(H10)).count() == 0


def test_a_star_of_the_last_minute_counts_for_its_day(spark, lake, tmp_path):
    def load(name, hour, *rows):
        path = tmp_path / name
        path.write_text("".join(json.dumps(row) + "\n" for row in rows))
        jobs.ingest_hour(lake, str(path), hour)
        jobs.transform_silver_events(lake, Interval.hour(hour))

    load("a.json", "2025-09-17T22:00:00", raw(1, "WatchEvent", 1, 100, "22:10:00"))
    jobs.update_repo_metrics_daily(lake, Interval.day("2025-09-17"))
    next_day = raw(3, "ForkEvent", 1, 100, "00:01:00") | {"created_at": "2025-09-18T00:01:00Z"}
    load("b.json", "2025-09-18T00:00:00", raw(2, "WatchEvent", 2, 100, "23:59:00"), next_day)
    dates = jobs.update_repo_metrics_daily(lake, Interval.day("2025-09-18"))
    assert dates == [date(2025, 9, 17), date(2025, 9, 18)]
    rows = {r.created_date.day: (r.star_count, r.fork_count) for r in lake.read(jobs.REPO_DAILY).collect()}
    assert rows == {17: (2, 0), 18: (0, 1)}


def late_stars(tmp_path, name, at, n):
    path = tmp_path / name
    rows = [raw(70 + k, "WatchEvent", 5, 200, at) for k in range(n)]
    path.write_text("".join(json.dumps(row) + "\n" for row in rows))
    return str(path)


def test_an_hour_that_comes_five_hours_late(spark, lake, files, tmp_path):
    """It reaches silver, its hour's gold and the next hour's movement with the run that follows."""
    for n, (hour, source) in enumerate(files.items()):
        jobs.run_hour(lake, source, hour, f"r{n}")
    assert jobs.arrivals(lake) == {}
    more = late_stars(tmp_path, "late.json", "10:30:00", 3)
    jobs.ingest_hour(lake, [files[H10], more], H10)
    assert list(jobs.arrivals(lake).values()) == [[datetime(2025, 9, 17, 10)]]
    far = "2025-09-17T17:00:00"
    nothing = tmp_path / "17.json"
    nothing.write_text(json.dumps(raw(99, "PushEvent", 1, 100, "17:00:00")) + "\n")
    jobs.run_hour(lake, str(nothing), far, "r17")
    assert jobs.arrivals(lake) == {}
    assert lake.read_window(jobs.SILVER_EVENTS, Interval.hour(H10)).count() == 6
    after = gold(lake)
    assert after[(10, 200)][1:6] == (3, 1, 1, 1, True)
    assert after[(11, 200)][6:] == (0, -1)
    assert lake.read("serving/repo_metrics_hourly").where("repo_id = 200 AND star_count = 3").count() == 1
    whole = Interval.of(H10, "2025-09-17T18:00:00")
    lake.drop(jobs.REPO_HOURLY)
    jobs.update_repo_metrics_hourly(lake, whole)
    # Names are looked up in the newer master.
    assert {k: v[1:] for k, v in gold(lake).items()} == {k: v[1:] for k, v in after.items()}


def test_a_run_that_broke_off_is_made_up_for(spark, lake, files, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "serve_hourly", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            jobs.run_hour(lake, files[H10], H10, "r10")
    assert len(jobs.arrivals(lake)) == 1
    far = "2025-09-17T20:00:00"
    assert [s.start.hour for s in jobs.take_up(lake, Interval.hour(far))] == [10, 18]
    assert lake.read("serving/repo_metrics_hourly").count() == 2 and jobs.arrivals(lake) == {}


def test_an_event_of_long_ago_costs_its_folders_only(spark, lake, tmp_path):
    """Its date is counted again in full, from the folders that hold events of that date."""
    def load(hour, *rows):
        path = tmp_path / f"{hour[:13]}.json"
        path.write_text("".join(json.dumps(row) + "\n" for row in rows))
        jobs.ingest_hour(lake, str(path), hour)
        jobs.transform_silver_events(lake, Interval.hour(hour), late_hours=0)

    old = {"created_at": "1970-01-01T00:00:00Z"}
    load("2025-09-01T00:00:00", raw(1, "WatchEvent", 1, 100, "00:00:00") | old)
    for day in range(2, 12):
        load(f"2025-09-{day:02}T00:00:00", raw(day, "WatchEvent", 1, 100, "00:00:00"))
    load("2025-09-20T00:00:00", raw(50, "WatchEvent", 2, 100, "00:00:00") | old)
    opened = []
    read = lake.read_folders
    spy = type(lake)(lake.spark, lake.root)
    object.__setattr__(spy, "read_folders", lambda table, folders: (opened.extend(f := list(folders)), read(table, f))[1])
    assert jobs.update_repo_metrics_daily(spy, Interval.day("2025-09-20")) == [date(1970, 1, 1)]
    assert sorted(f.split("=")[1] for f in opened) == ["2025090100", "2025092000"]
    rows = {r.created_date: r.star_count for r in lake.read(jobs.REPO_DAILY).collect()}
    assert rows == {date(1970, 1, 1): 2}


def landed(tmp_path, files, *hours):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    for hour in hours:
        (folder / files[hour].split("/")[-1]).write_bytes(open(files[hour], "rb").read())
    return str(folder)


def test_landed_files_are_ingested_once(spark, lake, files, tmp_path):
    progress = str(tmp_path / "progress")
    folder = landed(tmp_path, files, H10, H11)
    assert jobs.ingest_landed(lake, folder, progress, "a") == 11
    before = sorted(lake.read(jobs.BRONZE_EVENTS).inputFiles())
    assert jobs.ingest_landed(lake, folder, progress, "b") == 0
    assert sorted(lake.read(jobs.BRONZE_EVENTS).inputFiles()) == before
    landed(tmp_path, files, H12)
    assert jobs.ingest_landed(lake, folder, progress, "c", files_at_once=1) == 2
    assert lake.read(jobs.BRONZE_EVENTS).count() == 13
    stamps = {r.ingested_at.hour for r in lake.read(jobs.BRONZE_EVENTS).collect()}
    noted = [at.hour for arrived in jobs.arrivals(lake).values() for at in arrived]
    assert stamps == {10, 11, 12} and sorted(noted) == [10, 11, 12]


def test_a_landing_that_broke_off_repeats_without_doubles(spark, lake, files, tmp_path, monkeypatch):
    progress, folder = str(tmp_path / "progress"), landed(tmp_path, files, H10, H11)

    def published_then_lost(*args, **kwargs):
        whole(*args, **kwargs)
        raise OSError("gone")

    whole = jobs._gated
    with monkeypatch.context() as broken:
        broken.setattr(jobs, "_gated", published_then_lost)
        with pytest.raises(Exception, match="gone"):
            jobs.ingest_landed(lake, folder, progress, "a")
    assert lake.read(jobs.BRONZE_EVENTS).count() == 11
    assert jobs.ingest_landed(lake, folder, progress, "a") == 11
    assert lake.read(jobs.BRONZE_EVENTS).count() == 11


def test_a_landed_file_without_an_hour_is_refused(spark, lake, tmp_path):
    (tmp_path / "odd.json").write_text("{}\n")
    with pytest.raises(Exception, match="no hour"):
        jobs.ingest_landed(lake, str(tmp_path), str(tmp_path / "progress"), "a")


def test_a_rerun_asks_only_for_actors_without_an_answer(spark, lake, files):
    jobs.run_hour(lake, files[H11], H11, "r11")

    def shaky(node_ids):
        raise TimeoutError("no answer")

    assert jobs.fetch_actor_details(lake, H11, shaky) == {"failed": 3}
    assert jobs.fetch_actor_details(lake, H11, lookup, partitions=2, request_size=1) == {"found": 3}
    # Nobody is left to ask.
    assert jobs.fetch_actor_details(lake, H11, shaky) == {"found": 3}
    assert lake.read(jobs.ACTOR_DETAIL_RAW).count() == 3


def test_missing_hours_are_loaded(spark, lake, files, tmp_path):
    jobs.ingest_hour(lake, files[H11], H11)
    morning = Interval.of(H10, "2025-09-17T13:00:00")
    assert jobs.hours_to_load(lake, morning) == [H10, H12]
    assert jobs.load_missing_hours(lake, str(tmp_path), morning, "fill") == 7
    assert jobs.hours_to_load(lake, morning) == []


def test_lines_that_are_no_object_go_to_a_side_table(spark, lake, tmp_path):
    path = tmp_path / "cut.json"
    path.write_text(json.dumps(raw(1, "WatchEvent", 1, 100, "10:00:00")) + '\n{"id": "2", "type": "Wat\n')
    assert jobs.ingest_hour_gated(lake, str(path), H10, "cut") == 1
    assert [r.id for r in lake.read(jobs.BRONZE_EVENTS).collect()] == ["1"]
    assert [r.line for r in lake.read(jobs.MALFORMED).collect()] == ['{"id": "2", "type": "Wat']


def test_a_bad_hour_is_not_published(spark, lake, files):
    with pytest.raises(QualityError, match="unique"):
        jobs.ingest_hour_gated(lake, [files[H10], files[H10]], H10, "bad")
    assert not lake.exists(jobs.BRONZE_EVENTS)
    jobs.ingest_hour_gated(lake, files[H10], H10, "good")
    assert lake.read(jobs.BRONZE_EVENTS).count() == 5
    assert {r.run_id: r.passed for r in lake.read(jobs.QUALITY_RESULTS).collect()} == {"good": True}


def test_warn_mode_reports_and_goes_on(spark, lake, files):
    jobs.ingest_hour(lake, [files[H10], files[H10]], H10)
    assert jobs.check_events(lake, Interval.hour(H10), "run", mode="warn") == ["unique(id): 10 bad rows"]
    with pytest.raises(ValueError):
        jobs.check_events(lake, Interval.hour(H10), "run", mode="loud")
