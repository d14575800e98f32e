"""Command line: `python -m feedwright build|validate ...`, or this file with spark-submit."""

from __future__ import annotations

import argparse
import sys
import traceback
from datetime import date

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from feedwright.operators import daily
from feedwright.plans import job
from feedwright.plans.session import get_session, input_bytes, size_shuffles
from feedwright.schemas import TABLES
from feedwright.sources import csv, publish, tables
from feedwright.spec import WINDOW_DAYS, FeedSpec


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="feedwright")
    commands = parser.add_subparsers(dest="command", required=True)

    build = commands.add_parser("build", help="load the tables, build the feed, write the audit reports")
    for name in TABLES:
        build.add_argument(f"--{name}", required=True, help=f"CSV file or folder of {name}")
    build.add_argument("--out", required=True, help="output folder")
    build.add_argument("--as-of", type=date.fromisoformat, default=None, help="last day of the window (today)")
    build.add_argument("--window-days", type=int, default=WINDOW_DAYS)
    build.add_argument("--category", required=True, help="target category")
    build.add_argument("--by-date", action="store_true", help="partition events and orders by day")
    build.add_argument("--quarantine", action="store_true", help="set rows with null mandatory columns aside")
    build.add_argument("--daily-store", help="folder of sums by day: only days it lacks are read from events and orders")
    build.add_argument("--changed-days", type=date.fromisoformat, nargs="*", default=[], help="days of the store to compute again")
    build.add_argument("--provision-hash", action="store_true", help="fill in missing hashes of valid emails")

    validate = commands.add_parser("validate", help="validate a CSV feed; exit 0 passed, 2 failed, 1 no feed, 3 error")
    which = validate.add_mutually_exclusive_group(required=True)
    which.add_argument("--feed", help="CSV file or folder")
    which.add_argument("--built", help="output folder of a build, whose current feed is validated")
    validate.add_argument("--out", required=True)

    for command in (build, validate):
        command.add_argument("--multiline", action="store_true", help="accept line breaks inside CSV quotes")
    return parser.parse_args(argv)


def _size_shuffles(spark: SparkSession, paths: Iterable[str]) -> None:
    """By the bytes of the input. What is not there is told by who reads it."""
    try:
        size_shuffles(spark, input_bytes(spark, paths))
    except AnalysisException as error:
        if not csv.is_missing_path(error):
            raise


def _validate(spark: SparkSession, args: argparse.Namespace, run: str) -> int:
    feed = args.feed or f"{publish.current(spark, args.built, 'build') or args.built}/audience_feed"
    _size_shuffles(spark, [feed])
    return job.validate_feed(spark, feed, FeedSpec.today(), run, args.multiline)


def _build(spark: SparkSession, args: argparse.Namespace, run: str) -> int:
    spec = FeedSpec(args.as_of or date.today(), args.category, args.window_days)
    paths = {name: getattr(args, name) for name in TABLES}
    _size_shuffles(spark, paths.values())
    sources = job.land(spark, paths, run, args.by_date, args.quarantine, args.multiline)
    if args.daily_store:
        days = daily.refresh_days(sources, spec, args.daily_store, args.changed_days)
        print(f"Computed {len(days)} day(s) of {args.daily_store}")
    built = job.build_feed(sources, spec, run, args.provision_hash, args.daily_store)
    job.audit_feed(sources, built, spec, run)
    return 0


def main(argv: list[str] | None = None) -> int:
    """Run a job in a folder of its own and publish that when all of it is there."""
    args = _arguments(argv)
    spark = get_session()
    run = publish.new_run(args.out)
    try:
        status = (_validate if args.command == "validate" else _build)(spark, args, run)
    finally:
        tables.forget_stored(spark)
    if status != 1:
        publish.publish(spark, args.out, args.command, run)
        print(f"Published {run}")
    return status


if __name__ == "__main__":
    try:
        status = main()
    except Exception:
        # 1 means that there is no feed, so nothing else may end with it.
        traceback.print_exc()
        status = 3
    sys.exit(status)
