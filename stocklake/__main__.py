"""Run the jobs: ``python -m stocklake run /lake --date 2025-09-16``."""

from __future__ import annotations

import argparse
import datetime

from stocklake.plans import checks, daily, serving
from stocklake.session import build_session


def parse(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stocklake", description=__doc__)
    parser.add_argument(
        "job", choices=["init", "run", "source", "warehouse", "profile", "check", "export"]
    )
    parser.add_argument("root", help="folder of the lake on the shared file system")
    parser.add_argument(
        "--date",
        type=datetime.date.fromisoformat,
        default=datetime.date.today(),
        help="run date; news and candles are those of the day before",
    )
    parser.add_argument(
        "--load-ts",
        type=datetime.datetime.fromisoformat,
        help="stamp of the loaded rows; the start of the run date unless given",
    )
    parser.add_argument("--missing-ok", action="store_true", help="accept a day without data")
    parser.add_argument("--out", help="folder to export to")
    parser.add_argument("--candle-time-key", type=int, default=1, help="day of candles to export")
    args = parser.parse_args(argv)
    if args.job == "export" and not args.out:
        parser.error("export needs --out")
    return args


def main(argv=None) -> None:
    args = parse(argv)
    spark = build_session()
    paths = daily.Paths(args.root.rstrip("/"))
    load_ts = args.load_ts or datetime.datetime.combine(args.date, datetime.time())
    if args.job == "init":
        daily.init_warehouse(spark, paths)
    if args.job in ("run", "source"):
        daily.run_source_db(spark, args.date, paths, load_ts, args.missing_ok)
    if args.job in ("run", "warehouse"):
        daily.run_warehouse(spark, args.date, paths, load_ts, args.missing_ok)
    if args.job not in ("profile", "check", "export"):
        return
    tables = daily.warehouse_tables(spark, paths)
    if args.job == "profile":
        serving.profile(tables).show(truncate=False)
    if args.job == "check":
        report = checks.constraint_report(daily.source_tables(spark, paths) | tables)
        for row in report.toLocalIterator():
            print(*row, sep=" | ")
    if args.job == "export":
        serving.export_warehouse(tables, args.out, args.candle_time_key)


if __name__ == "__main__":
    main()
