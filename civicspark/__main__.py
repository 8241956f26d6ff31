"""Run one step, or the whole day: ``spark-submit … -m civicspark`` or ``python -m civicspark``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from civicspark import schemas
from civicspark.plans import jobs
from civicspark.session import build_session, prepare
from civicspark.streaming.loads import stream_silver

TASKS = (
    "extract",
    "extract_income",
    "complaints",
    "median_income",
    "staging",
    "test",
    "snapshot",
    "mart",
    "daily",
)


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="civicspark", description=__doc__)
    parser.add_argument("--task", choices=TASKS, required=True)
    parser.add_argument("--root", required=True, help="folder that holds all layers")
    parser.add_argument("--source", help="JSON-lines or header-row documents to extract from")
    parser.add_argument("--first-cursor", default=schemas.FIRST_CURSOR)
    parser.add_argument("--full-refresh", action="store_true")
    parser.add_argument("--strict", action="store_true", help="also run the optional checks")
    parser.add_argument("--granularity", choices=("day", "month", "year"), default="day")
    chosen = parser.parse_args(given)
    if chosen.task.startswith("extract") and not chosen.source:
        parser.error(f"--task {chosen.task} needs --source")
    return chosen


def main(given: list[str] | None = None) -> None:
    args = arguments(given)
    spark = prepare(build_session(f"civicspark-{args.task}"))
    lake = jobs.Lake(args.root.rstrip("/"))
    now = datetime.now(timezone.utc)
    # Runs started in the same second must not share a name.
    run = now.strftime("%Y%m%dT%H%M%S%fZ")
    match args.task:
        case "extract":
            counts = jobs.extract_lines(spark, lake, args.source, run, args.first_cursor)
            print(f"extracted {counts['fetched']} rows, rejected {counts['rejected']} lines")
        case "extract_income":
            jobs.extract_income(spark, lake, args.source)
        case "complaints":
            stream_silver(
                spark, lake.bronze_complaints, lake.silver_complaints, lake.silver_checkpoint
            ).awaitTermination()
        case "median_income":
            jobs.load_income(spark, lake)
        case "staging":
            left_out = jobs.build_staging(
                spark, lake, args.full_refresh, args.granularity, run
            )
            print(f"rows left out for want of a key: {left_out.count()}")
        case "test":
            print(jobs.check_staging(spark, lake, args.strict))
        case "snapshot":
            jobs.take_history(spark, lake, run, args.full_refresh, args.granularity)
        case "mart":
            show(jobs.publish_marts(spark, lake))
        case "daily":
            show(
                jobs.run_daily(
                    spark, lake, run, now, args.full_refresh, args.granularity, args.strict
                )
            )


def show(tables: dict) -> None:
    for name, table in tables.items():
        if name.startswith(("fct_", "chart_")):
            print(name)
            table.show()


if __name__ == "__main__":
    main()
