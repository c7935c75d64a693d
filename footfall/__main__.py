"""Command line, for ``spark-submit`` and schedulers.

    python -m footfall load events IN.csv RAW/events --load-ts 2024-01-02T00:00:00
    python -m footfall run RAW TARGETS --day 2024-01-01 [--steps ...] [--full-refresh]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import SparkSession

from footfall.params import RunParams
from footfall.plans.daily import STEPS, Targets, run_daily
from footfall.plans.late import run_with_late
from footfall.sources.csv import ingest
from footfall.sources.registry import Sources
from footfall.sources.schemas import TABLES
from footfall.storage import files


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="footfall")
    commands = parser.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="load a CSV into a raw table")
    load.add_argument("table", choices=TABLES)
    load.add_argument("csv")
    load.add_argument("target")
    load.add_argument("--load-ts", type=datetime.fromisoformat, required=True)
    load.add_argument("--mode", choices=("append", "replace", "overwrite", "ignore"), default="append")
    load.add_argument("--rejects", help="folder for rows that cannot be read")
    load.add_argument("--multiline", action="store_true")

    run = commands.add_parser("run", help="run the daily steps")
    run.add_argument("raw", help="folder of the raw tables")
    run.add_argument("targets")
    run.add_argument("--day", type=date.fromisoformat, help="midnight to midnight")
    run.add_argument("--start", type=datetime.fromisoformat)
    run.add_argument("--end", type=datetime.fromisoformat)
    run.add_argument("--job-date", type=date.fromisoformat)
    run.add_argument("--as-of", type=datetime.fromisoformat)
    run.add_argument("--steps", nargs="+", choices=STEPS, default=STEPS)
    run.add_argument("--full-refresh", action="store_true")
    run.add_argument("--late", action="store_true", help="run days again that gained rows since")
    run.add_argument("--drop-anonymous", action="store_true", help="leave user 0's events out")
    return parser


def _params(options: argparse.Namespace, parser: argparse.ArgumentParser) -> RunParams:
    interval = (options.start, options.end, options.job_date)
    if options.day is not None:
        if any(part is not None for part in interval):
            parser.error("give --day, or --start, --end and --job-date")
        day = RunParams.for_day(options.day)
        return RunParams(day.start, day.end, day.job_date, options.as_of)
    if any(part is None for part in interval):
        parser.error("give --day, or --start, --end and --job-date")
    return RunParams(*interval, options.as_of)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = _parser()
    options = parser.parse_args(arguments)
    params = _params(options, parser) if options.command == "run" else None
    spark = SparkSession.builder.appName(f"footfall {options.command}").getOrCreate()
    if options.command == "load":
        rejected = ingest(
            spark,
            options.table,
            options.csv,
            options.target,
            options.load_ts,
            options.mode,
            options.rejects,
            options.multiline,
        )
        print(f"{options.table}: {rejected} rows rejected")
        return
    raw = options.raw.rstrip("/")
    present = {name: f"{raw}/{name}" for name in TABLES if files.exists(spark, f"{raw}/{name}")}
    (run_with_late if options.late else run_daily)(
        spark,
        Sources(spark, present, options.drop_anonymous),
        Targets(options.targets),
        params,
        options.steps,
        options.full_refresh,
    )


if __name__ == "__main__":
    main()
