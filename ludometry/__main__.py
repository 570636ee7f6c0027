"""Jobs for spark-submit: ``spark-submit run.py ROOT bronze silver enrich gold checks``."""

from __future__ import annotations

import argparse
import datetime
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ludometry.operators.checks import MART_CHECKS, MATCH_CHECKS, violations
from ludometry.operators.enrich import unknown_maps
from ludometry.plans import bronze, gold, ledger, silver
from ludometry.plans.carried import run_gold_of_new_files
from ludometry.plans.lake import Lake
from ludometry.schemas import MATCH, SILVER_EVENT, SILVER_MAP
from ludometry.session import build_session
from ludometry.sinks.versions import read_current
from ludometry.sources.tables import read_or_empty, stored_path
from ludometry.streaming.ingest import ingest_new_files
from ludometry.streaming.refine import run_silver_of_new_files

JOBS = ["bronze", "silver", "enrich", "gold", "checks"]


def _day(text: str) -> datetime.date | None:
    return None if text == "undated" else datetime.date.fromisoformat(text)


def parse(arguments: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ludometry")
    parser.add_argument("root", help="folder of the lake, on any Hadoop file system")
    parser.add_argument("jobs", nargs="*", help=f"some of {' '.join(JOBS)}; all by default")
    parser.add_argument("--events", help="raw event files, if not ROOT/raw/events.jsonl")
    parser.add_argument("--inbox", help="folder of raw event files, of which only new ones are read")
    parser.add_argument("--maps", help="raw map file, if not ROOT/raw/maps.jsonl")
    parser.add_argument(
        "--date",
        dest="dates",
        action="append",
        type=_day,
        help="limit Bronze, Silver and enrichment to this day, or to rows without "
        "one ('undated'); may be repeated",
    )
    parser.add_argument(
        "--matches",
        choices=["full", "watermark", "new-files"],
        default="full",
        help="rebuild the matches, update them from all events, or from new files of Silver",
    )
    parsed = parser.parse_args(arguments)
    parsed.jobs = parsed.jobs or JOBS
    if parsed.inbox and (parsed.events or parsed.dates):
        parser.error("--inbox takes all days of its new files and no --events")
    unknown = set(parsed.jobs) - set(JOBS)
    if unknown:
        parser.error(f"unknown jobs {sorted(unknown)}")
    return parsed


def run(spark: SparkSession, options: argparse.Namespace) -> bool:
    """Run the chosen jobs in layer order; False if a check of the mart or the matches failed."""
    lake = Lake(options.root)
    passed = True
    if "bronze" in options.jobs:
        if options.inbox:
            counts = {
                "new_events": ingest_new_files(spark, options.inbox, lake, lake.bronze_progress),
                "maps": bronze.refresh_maps(spark, options.maps or lake.raw_maps, lake),
            }
        else:
            counts = bronze.run_bronze(spark, lake, options.events, options.maps, options.dates)
        print("bronze", counts)
        ledger.record(spark, lake, "bronze", counts)
    if "silver" in options.jobs:
        if options.dates is None:
            counts = run_silver_of_new_files(spark, lake)
        else:
            counts = silver.run_silver(spark, lake, options.dates)
        print("silver", counts)
        ledger.record(spark, lake, "silver", counts)
        events = read_or_empty(spark, lake.silver_events, SILVER_EVENT)
        unknown_maps(events, read_or_empty(spark, lake.silver_maps, SILVER_MAP)).show(truncate=False)
    if "enrich" in options.jobs:
        silver.write_enriched(spark, lake, options.dates)
    if "gold" in options.jobs:
        if options.matches == "new-files":
            run_gold_of_new_files(spark, lake).show(truncate=False)
        else:
            gold.run_gold(spark, lake, options.matches).show(truncate=False)
    if "checks" in options.jobs:
        tables = [
            (spark.read.parquet(stored_path(spark, lake.player_stats)), MART_CHECKS),
            (read_current(spark, lake.matches, MATCH), MATCH_CHECKS),
        ]
        for rows, checks in tables:
            for check in violations(rows, checks).collect():
                print(check.check_name, "passed" if check.passed else f"FAILED: {check.violations} rows")
                passed = passed and check.passed
    return passed


def main() -> None:
    options = parse(sys.argv[1:])
    spark = build_session()
    try:
        passed = run(spark, options)
    finally:
        spark.stop()
    sys.exit(0 if passed else 1)


if __name__ == "__main__":
    main()
