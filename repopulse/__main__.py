"""Run one job: ``spark-submit ... -m repopulse <job> --lake <folder> [options]``."""

from __future__ import annotations

import argparse
import importlib

from repopulse.functions.timeframes import Interval
from repopulse.plans import jobs
from repopulse.session import create_session
from repopulse.sinks.lake import Lake
from repopulse.sinks.serving import JdbcTarget
from repopulse.sources.reference_lists import places_and_codes


def _interval(args: argparse.Namespace) -> Interval:
    return Interval.of(args.data_interval_start, args.data_interval_end)


def _lookup(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _merge_actors(lake: Lake, args: argparse.Namespace) -> None:
    places, codes = places_and_codes(lake.spark, args.subdivisions, args.countries)
    jobs.merge_actor_dimension(lake, args.target_datetime, places, codes)


WINDOW = ("data_interval_start", "data_interval_end")

# Job name -> required arguments, what to run.
JOBS = {
    "ingest-hour": (
        ("source_path", "data_interval_start"),
        lambda lake, a: jobs.ingest_hour(lake, a.source_path, a.data_interval_start),
    ),
    "ingest-hour-gated": (
        ("source_path", "data_interval_start", "run_id"),
        lambda lake, a: jobs.ingest_hour_gated(lake, a.source_path, a.data_interval_start, a.run_id),
    ),
    "load-missing-hours": (
        ("archive_folder", *WINDOW, "run_id"),
        lambda lake, a: jobs.load_missing_hours(lake, a.archive_folder, _interval(a), a.run_id),
    ),
    "ingest-landed": (
        ("archive_folder", "progress", "run_id"),
        lambda lake, a: jobs.ingest_landed(lake, a.archive_folder, a.progress, a.run_id),
    ),
    "take-up": (WINDOW, lambda lake, a: len(jobs.take_up(lake, _interval(a)))),
    "check-events": (
        (*WINDOW, "run_id", "mode"),
        lambda lake, a: jobs.check_events(lake, _interval(a), a.run_id, mode=a.mode),
    ),
    "extract-actor-meta": (WINDOW, lambda lake, a: jobs.extract_actor_meta(lake, _interval(a))),
    "extract-repo-meta": (WINDOW, lambda lake, a: jobs.extract_repo_meta(lake, _interval(a))),
    "load-actor-master": (WINDOW, lambda lake, a: jobs.load_actor_master(lake, _interval(a))),
    "load-repo-master": (WINDOW, lambda lake, a: jobs.load_repo_master(lake, _interval(a))),
    "compact-masters": ((), lambda lake, a: jobs.compact_masters(lake)),
    "compact-actor-dimension": (
        ("before",),
        lambda lake, a: jobs.compact_actor_dimension(lake, a.before),
    ),
    "transform-silver": (WINDOW, lambda lake, a: jobs.transform_silver_events(lake, _interval(a))),
    "repo-metrics-hourly": (WINDOW, lambda lake, a: jobs.update_repo_metrics_hourly(lake, _interval(a))),
    "repo-metrics-daily": (
        ("target_date",),
        lambda lake, a: jobs.update_repo_metrics_daily(lake, Interval.day(a.target_date)),
    ),
    "contribution-daily": (WINDOW, lambda lake, a: jobs.update_contribution_daily(lake, _interval(a))),
    "fetch-actor-details": (
        ("target_datetime", "lookup"),
        lambda lake, a: jobs.fetch_actor_details(lake, a.target_datetime, _lookup(a.lookup)),
    ),
    "merge-actor-dimension": (("target_datetime", "subdivisions", "countries"), _merge_actors),
    "serve-hourly": (WINDOW, lambda lake, a: jobs.serve_hourly(lake, _interval(a))),
    "serve-daily": (("target_date",), lambda lake, a: jobs.serve_daily(lake, a.target_date)),
    "stage-hourly": (
        WINDOW,
        lambda lake, a: jobs.stage_hourly(lake, _interval(a), JdbcTarget.from_conf(lake.spark)),
    ),
    "stage-daily": (
        ("source_table_name", "target_table_name", "target_date", "date_condition_col_name"),
        lambda lake, a: jobs.stage_daily(
            lake,
            a.source_table_name,
            a.target_date,
            JdbcTarget.from_conf(lake.spark),
            a.target_table_name,
            a.date_condition_col_name,
        ),
    ),
    "merge-staged": (
        ("target_table_name",),
        lambda lake, a: jobs.merge_staged(lake, a.target_table_name, JdbcTarget.from_conf(lake.spark)),
    ),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="repopulse", description=__doc__)
    commands = top.add_subparsers(dest="job", required=True)
    for name, (arguments, _) in JOBS.items():
        command = commands.add_parser(name)
        for argument in ("lake", *arguments):
            command.add_argument(f"--{argument}", required=True)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = create_session(f"repopulse-{args.job}")
    result = JOBS[args.job][1](Lake(spark, args.lake), args)
    if result is not None:
        print(f"{args.job}: {result}")


if __name__ == "__main__":
    main()
