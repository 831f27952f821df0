"""Submit one stage of the refresh, all of them, or the load of one execution date.

    spark-submit --properties-file conf/cluster.conf run_job.py all \\
        --raw s3a://lake/raw --lake s3a://lake --database analytics --date 20250901

The master, credentials and sizes come from spark-submit. Stages are separate so
that a scheduler can retry the one that failed; each replaces all it writes. `all` with
`--run NAME` goes on after the stages that the run of that name has finished. `verify` fails
where tables do not agree. `day` replaces what is published of one date.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from starflow.plans import run_day, run_once, verify
from starflow.plans.bronze import READINGS
from starflow.plans.refresh import EXTRA_STAGES, STAGES, RefreshConfig, load_counts


def parse(arguments: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Refresh the clickstream star schema.")
    parser.add_argument("stage", choices=["all", *STAGES, *EXTRA_STAGES, "verify", "day"])
    parser.add_argument("--raw", required=True, help="raw CSV file, folder or glob")
    parser.add_argument("--lake", required=True, help="root of bronze, silver and gold")
    parser.add_argument("--database", required=True, help="catalog database of the warehouse")
    parser.add_argument("--database-location", help="folder of the database, if it is new")
    parser.add_argument("--date", default="", help="execution date; decides what `day` replaces, otherwise shown")
    parser.add_argument("--run", help="name of a run, to go on where it stopped; with `all` only")
    parser.add_argument(
        "--reading",
        choices=READINGS,
        default="check",
        help="split files at line ends or where records end, read each whole, or look first how they can be split",
    )
    parser.add_argument(
        "--any-headers", action="store_true", help="read columns by place, whatever headers say"
    )
    parser.add_argument("--spread", action="store_true", help="deal raw rows out by a shuffle")
    parser.add_argument(
        "--max-records-per-file", type=int, default=0, help="limit of bronze files; 0 is none"
    )
    parser.add_argument("--time-zone", default="UTC", help="zone of times without an offset")
    args = parser.parse_args(arguments)
    if args.run and args.stage != "all":
        parser.error("--run goes with all")
    if args.stage == "day" and not args.date:
        parser.error("day needs --date")
    return args


def main(arguments: list[str]) -> None:
    args = parse(arguments)
    config = RefreshConfig(
        raw_path=args.raw,
        lake_root=args.lake,
        database=args.database,
        database_location=args.database_location,
        reading=args.reading,
        check_headers=not args.any_headers,
        spread=args.spread,
        max_records_per_file=args.max_records_per_file,
        time_zone=args.time_zone,
    )
    spark = (
        SparkSession.builder.appName(f"starflow {args.stage} {args.date}".strip())
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if args.stage == "day":
        counts = run_day(spark, config, args.date, args.raw)
    elif args.run:
        counts = run_once(spark, config, args.run)
    else:
        for name, stage in {**STAGES, **EXTRA_STAGES, "verify": verify}.items():
            if args.stage == name or args.stage == "all" and name in STAGES:
                stage(spark, config)
                print(f"{name} done {args.date}".strip())
        counts = load_counts(spark, config) if args.stage in ("all", "warehouse") else None
    for row in counts.collect() if counts is not None else ():
        print(f"{row.table_name}: {row.n:,} rows")


if __name__ == "__main__":
    main(sys.argv[1:])
