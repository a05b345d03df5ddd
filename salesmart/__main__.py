"""Command line: ``init`` creates the empty mart, ``load`` loads days of a raw sales file.

    python -m salesmart init <warehouse> [--by day|month|year]
    python -m salesmart load <warehouse> <csv path> <yyyymmdd> [<yyyymmdd> ...] [--multiline]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from salesmart.functions.dates import resolve_run_dates
from salesmart.plans.daily_load import load_file
from salesmart.plans.warehouse import Warehouse


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="salesmart")
    steps = parser.add_subparsers(dest="step", required=True)
    init = steps.add_parser("init")
    init.add_argument("warehouse")
    init.add_argument("--by", default="day", choices=["day", "month", "year"])
    load = steps.add_parser("load")
    load.add_argument("warehouse")
    load.add_argument("path")
    load.add_argument("days", nargs="+")
    load.add_argument("--multiline", action="store_true", help="quoted values may hold line breaks")
    args = parser.parse_args(argv)

    if args.step == "load":
        try:
            resolve_run_dates(args.days)
        except ValueError as error:
            print(error, file=sys.stderr)
            return 1
    spark = SparkSession.builder.appName("salesmart").getOrCreate()
    if args.step == "init":
        Warehouse(spark, args.warehouse).bootstrap(args.by)
        return 0
    try:
        result = load_file(spark, args.warehouse, args.path, args.days, multiline=args.multiline)
    except Exception as error:  # the job's exit code tells the scheduler
        print(f"load failed: {error}", file=sys.stderr)
        return 1
    print(result.status, result.metrics)
    return 0


if __name__ == "__main__":
    sys.exit(main())
