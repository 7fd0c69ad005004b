"""Command-line job: refresh prediction tables (``spark-submit`` or ``python -m tallycast``).

    spark-submit --py-files tallycast.zip tallycast/__main__.py \\
        --source security.attack_type_stat --grain hour=prediction_hourly_stat \\
        --grain day=prediction_daily_stat --format jdbc --jdbc-url jdbc:mysql://host/db \\
        --jdbc-user-env DB_USER --jdbc-password-env DB_PASSWORD

Every grain named is computed from one scan of the source and written with a
full refresh.  Credentials are read from the named environment variables and
never printed.  Master, executors and other settings come from spark-submit.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from tallycast.plans.jobs import GRAINS, predict_all, refresh_all
from tallycast.sources.tables import read_stat_parquet, read_stat_table, restrict_days


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tallycast", description=__doc__.split("\n\n")[0])
    p.add_argument("--source", required=True, help="catalog table name, or a Parquet path with --source-format parquet")
    p.add_argument("--source-format", choices=("table", "parquet"), default="table")
    p.add_argument("--grain", action="append", required=True, metavar="GRAIN=TARGET",
                   help=f"grain ({', '.join(GRAINS)}) and its target table or path; repeatable")
    p.add_argument("--format", choices=("parquet", "jdbc", "table"), default="parquet")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-user-env", help="environment variable holding the database user")
    p.add_argument("--jdbc-password-env", help="environment variable holding the database password")
    p.add_argument("--first-day", help="yyyy-MM-dd, inclusive")
    p.add_argument("--last-day", help="yyyy-MM-dd, inclusive")
    p.add_argument("--ratio", choices=("inverse", "forward"), help="hourly growth ratio (default inverse)")
    p.add_argument("--dedupe-seeds", action="store_true", help="monthly seeds once, with the fourth seed")
    p.add_argument("--iso-year", action="store_true", help="weeks keyed by ISO week-year")
    p.add_argument("--parallel", type=int, default=1, help="table writes submitted concurrently")
    p.add_argument("--hive", action="store_true", help="bind the session to the Hive metastore")
    p.add_argument("--explain", action="store_true",
                   help="print each grain's physical plan and exit without running a job")
    p.add_argument("--keys-trimmed", action="store_true",
                   help="stored attack types carry no blanks: skip trim() so key filters reach the scan")
    return p.parse_args(argv)


def targets_of(specs: list[str]) -> dict[str, str]:
    out = {}
    for spec in specs:
        grain, sep, target = spec.partition("=")
        if not sep or grain not in GRAINS or not target:
            raise SystemExit(f"--grain expects GRAIN=TARGET with GRAIN in {GRAINS}, got {spec!r}")
        out[grain] = target
    return out


def main(argv: list[str] | None = None) -> dict:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    targets = targets_of(args.grain)
    builder = SparkSession.builder.appName("tallycast-refresh")
    if args.hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    trim_keys = not args.keys_trimmed
    stat = (read_stat_parquet(spark, args.source, trim_keys=trim_keys) if args.source_format == "parquet"
            else read_stat_table(spark, args.source, trim_keys=trim_keys))
    stat = restrict_days(stat, args.first_day, args.last_day)
    options = {}
    if args.ratio:
        options["ratio"] = args.ratio
    if args.dedupe_seeds:
        options["dedupe_seeds"] = True
    if args.iso_year:
        options["iso_year"] = True
    if args.explain:
        tables = predict_all(stat, tuple(targets), materialize=False, **options)
        for g, table in tables.items():
            print(f"== {g} -> {targets[g]}")
            table.explain("formatted")
        return tables
    sink_options = {}
    if args.format == "jdbc":
        if not args.jdbc_url:
            raise SystemExit("--format jdbc needs --jdbc-url")
        props = {}
        if args.jdbc_user_env:
            props["user"] = os.environ[args.jdbc_user_env]
        if args.jdbc_password_env:
            props["password"] = os.environ[args.jdbc_password_env]
        sink_options = {"url": args.jdbc_url, "properties": props}
    return refresh_all(stat, targets, fmt=args.format, sink_options=sink_options,
                       parallel=args.parallel, **options)


if __name__ == "__main__":
    main()
