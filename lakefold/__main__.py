"""Job entry point: one scheduled run of one dataset.

    python -m lakefold run {news_collection,air_quality,census_data_collection}
        --bronze PATH --silver PATH [--format parquet] [--time-zone UTC]
        [--on-conflict latest|error] [--no-roll-day] [--ref DAY --days N]
    spark-submit --py-files lakefold.zip lakefold/__main__.py run ...

Reads the Bronze files, folds them into the Silver table (creating it on
the first run).  ``--ref`` and ``--days`` restrict the run to Bronze rows
that landed on the N days before DAY.  Corrupt JSON lines are left out and
counted.  Cluster settings (master,
memory, executors, shared ``spark.checkpoint.dir``) come from
``spark-submit``.
"""

from __future__ import annotations

import argparse
import sys

from lakefold.plans import datasets
from lakefold.schemas import CONTRACTS
from lakefold.session import build_session
from lakefold.sources.files import read_source, split_corrupt


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="lakefold")
    sub = ap.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="transform Bronze and merge it into Silver")
    run.add_argument("dataset", choices=sorted(datasets.SPECS))
    run.add_argument("--bronze", required=True)
    run.add_argument("--silver", required=True)
    run.add_argument("--format", default="parquet")
    run.add_argument("--time-zone", default="UTC")
    run.add_argument("--on-conflict", choices=("latest", "error"), default="latest")
    run.add_argument("--no-roll-day", action="store_true", help="hour 24 stays on the same day")
    run.add_argument("--ref", help="read only what landed before this day (yyyy-mm-dd)")
    run.add_argument("--days", type=int, default=3, help="with --ref: number of landing days")
    args = ap.parse_args(argv)

    spark = build_session(f"lakefold-{args.dataset}", time_zone=args.time_zone)
    spec = datasets.SPECS[args.dataset]
    contract = CONTRACTS.get(args.dataset)
    schema = contract.schema if contract and args.format in ("csv", "json") else None
    bronze, corrupt = split_corrupt(read_source(spark, args.bronze, args.format, schema=schema))
    if args.ref:
        bronze = datasets.landed_between(bronze, args.ref, args.days)
    table = datasets.silver_table(spark, spec, args.silver)
    datasets.run(spec, bronze, table, datasets.RunOptions(args.on_conflict, not args.no_roll_day))
    print(f"{args.dataset}: merged into {args.silver}; corrupt lines left out: {corrupt.count()}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
