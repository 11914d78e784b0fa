"""Command line for scheduled jobs (``spark-submit jobs.py ...`` or
``python -m liqspark.plans.cli ...``).

  ingest    load one day's raw feed into its raw table
  run       build and store every model for one date, run the checks, write
            the check results, summary and assertion events as JSON
  optimize  compact one date's partition of the named tables

The session comes from the submitter (cluster configuration wins); the
shared checkpoint folder is read from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from ..schemas import MARKET_KEYS, PARTITION_DATE, POSITION_KEYS, RAW_MARKET_SCHEMA, RAW_POSITIONS_SCHEMA
from ..session import ensure_checkpoint_dir
from ..sources import sinks

FEEDS = {"market_data": RAW_MARKET_SCHEMA, "positions_loans": RAW_POSITIONS_SCHEMA,
         "positions_deposits": RAW_POSITIONS_SCHEMA}

KEYS = {"market_data": MARKET_KEYS, "positions_loans": POSITION_KEYS, "positions_deposits": POSITION_KEYS}


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="liqspark")
    sub = p.add_subparsers(dest="cmd", required=True)

    ing = sub.add_parser("ingest", help="load one day's raw feed")
    ing.add_argument("--partition-date", type=_date, required=True)
    ing.add_argument("--source-path", required=True)
    ing.add_argument("--target-table", required=True, help="path of the raw table")
    ing.add_argument("--feed", choices=sorted(FEEDS), required=True)
    ing.add_argument("--source-system", default=None, help="tag, e.g. LMS or CBS")
    ing.add_argument("--format", default="parquet")
    ing.add_argument("--quarantine", action="store_true", help="set rows with malformed values or null keys apart")

    run = sub.add_parser("run", help="build all models for one date and check them")
    run.add_argument("--partition-date", type=_date, required=True)
    run.add_argument("--raw-root", required=True, help="folder holding the three raw tables")
    run.add_argument("--warehouse", required=True)
    run.add_argument("--output", required=True, help="folder for results, summary and events (JSON)")
    run.add_argument("--scope", choices=["partition", "table"], default="table")
    run.add_argument("--run-id", default=None)
    run.add_argument("--store-failures", action="store_true")
    run.add_argument("--input-bytes", type=int, default=None,
                     help="expected daily input volume; sizes scan splits and shuffle partitions")

    opt = sub.add_parser("optimize", help="compact one date of the named tables")
    opt.add_argument("--warehouse", required=True)
    opt.add_argument("--tables", required=True, help="comma-separated model names")
    opt.add_argument("--partition-date", type=_date, required=True)
    opt.add_argument("--target-files", type=int, default=None, help="files per partition; from its bytes if not given")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"liqspark-{args.cmd}").getOrCreate()
    ensure_checkpoint_dir(spark)

    if args.cmd == "ingest" and args.quarantine:
        from ..operators.quarantine import ingest_checked

        ingest_checked(spark, args.source_path, args.partition_date, FEEDS[args.feed], args.target_table, args.format,
                       [c for c in KEYS[args.feed] if c != PARTITION_DATE], args.source_system)
        return 0

    if args.cmd == "ingest":
        sinks.ingest_raw(spark, args.source_path, args.partition_date, FEEDS[args.feed], args.target_table,
                         fmt=args.format, source_system=args.source_system)
        return 0

    if args.cmd == "run":
        from ..operators import publish as pub
        from ..session import apply_conf, scale_conf

        if args.input_bytes:
            apply_conf(spark, scale_conf(args.input_bytes))
        from .pipeline import Warehouse, run_daily

        raw = {name: sinks.read_declared(spark, f"{args.raw_root.rstrip('/')}/{name}", schema)
               for name, schema in FEEDS.items()}
        failures = f"{args.output}/failures/{args.partition_date.isoformat()}" if args.store_failures else None
        results = run_daily(spark, raw, args.partition_date, args.warehouse, failures_path=failures,
                            scope=args.scope)
        out = args.output.rstrip("/")
        day = args.partition_date.isoformat()
        run_id = args.run_id or f"scheduled__{day}"
        # results are written once and read back, so the checks run one time
        results.write.mode("overwrite").json(f"{out}/check_results/{day}")
        stored = spark.read.schema(results.schema).json(f"{out}/check_results/{day}")
        pub.dq_summary(stored).write.mode("overwrite").json(f"{out}/summary/{day}")
        metrics = Warehouse(spark, args.warehouse).read("mart_positions_dq_metrics")
        pub.write_events(pub.assertion_events(metrics, stored, run_id, args.partition_date), f"{out}/events")
        return 0

    if args.cmd == "optimize":
        from .models import PARTITIONING

        for name in [t.strip() for t in args.tables.split(",") if t.strip()]:
            sinks.compact_partition(spark, f"{args.warehouse.rstrip('/')}/{name}", args.partition_date,
                                    args.target_files, PARTITIONING.get(name, ("partition_date",)))
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
