"""Command line: ``python -m quarry run ...`` / ``python -m quarry checks ...``.

``run`` loads the given extracts and rebuilds every model (the daily
job); ``checks`` prints the declared data-quality results. The master
comes from ``spark-submit`` (or ``--master`` for a local run).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from quarry.config import Namespaces, RunContext
from quarry.plans import checks, pipeline
from quarry.plans.materialize import Warehouse
from quarry.session import build_session


def _namespaces(args) -> Namespaces:
    return Namespaces.routed(default=args.schema, raw=args.raw_schema, bronze=args.bronze_schema,
                             silver=args.silver_schema, gold=args.gold_schema)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quarry")
    p.add_argument("--master")
    p.add_argument("--schema", help="database for layers without their own name")
    for layer in ("raw", "bronze", "silver", "gold"):
        p.add_argument(f"--{layer}-schema")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="load extracts, then rebuild views and tables")
    r.add_argument("--rig-sheet", action="append", default=[])
    r.add_argument("--quake-features", action="append", default=[])
    r.add_argument("--quake-lines", action="store_true", help="event files hold one feature a line")
    r.add_argument("--quake-period", nargs=2, metavar=("START", "END"), help="ISO dates; default: the 90 days up to --as-of")
    r.add_argument("--as-of", help="ISO date of the event extract; default: today (UTC)")
    r.add_argument("--quake-box", nargs=4, type=float, metavar=("MIN_LAT", "MAX_LAT", "MIN_LON", "MAX_LON"), help="default: the contiguous states")
    r.add_argument("--county-csv")
    r.add_argument("--seed-csv")
    r.add_argument("--quarantine", required=True)
    r.add_argument("--run-id")
    r.add_argument("--partition-silver", action="store_true")
    r.add_argument("--checks-as-of", help="also print the data-quality checks, freshness against this ISO time")
    c = sub.add_parser("checks", help="not-null / unique checks and source freshness")
    c.add_argument("--as-of", help="ISO timestamp; default: now (UTC)")
    args = p.parse_args(argv)

    spark = build_session(args.master)
    wh = Warehouse(spark, _namespaces(args))
    if args.cmd == "run":
        ctx = RunContext(run_id=args.run_id) if args.run_id else RunContext()
        inputs = pipeline.Inputs(rig_sheets=args.rig_sheet, quake_features=args.quake_features,
                                 county_csv=args.county_csv, seed_csv=args.seed_csv,
                                 quarantine_dir=args.quarantine, quake_lines=args.quake_lines,
                                 as_of=dt.date.fromisoformat(args.as_of) if args.as_of else None,
                                 quake_period=tuple(map(dt.date.fromisoformat, args.quake_period)) if args.quake_period else None)
        if args.quake_box:
            inputs.quake_bbox = dict(zip(("min_lat", "max_lat", "min_lon", "max_lon"), args.quake_box, strict=True))
        results = pipeline.run(wh, inputs, ctx, partition_silver=args.partition_silver)
        print(json.dumps({k: vars(v) for k, v in results.items()}))
        if args.checks_as_of:
            _print_checks(wh, dt.datetime.fromisoformat(args.checks_as_of))
    else:
        # Needs the tables in a persistent catalog (a cluster metastore).
        as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        _print_checks(wh, as_of)
    spark.stop()
    return 0


def _print_checks(wh: Warehouse, as_of: dt.datetime) -> None:
    for row in checks.column_checks(wh).collect():
        print(json.dumps(row.asDict()))
    for row in checks.source_freshness(wh, as_of).collect():
        print(json.dumps({k: str(v) for k, v in row.asDict().items()}))


if __name__ == "__main__":
    sys.exit(main())
