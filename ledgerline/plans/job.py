"""Command-line entry point: one run of the invoice load.

    spark-submit ledgerline/plans/job.py --report <pages> --target <table> \\
        --control <history> --lake <flat> [--seed] [--tz Europe/Berlin]

The session comes from ``getOrCreate()``, so all cluster settings (shuffle
partitions, AQE, checkpoint folder) come from the submit configuration.
Prints the run outcome as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import asdict

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from ledgerline.plans.control import ETL_NAME, RunHistory  # noqa: E402
from ledgerline.plans.runs import LoadSettings, run_load  # noqa: E402


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Load a landed invoice report (full or incremental).")
    p.add_argument("--report", required=True, help="folder of landed report pages (JSON)")
    p.add_argument("--target", required=True, help="Parquet target folder (ignored with --jdbc-url)")
    p.add_argument("--control", required=True, help="control-table folder")
    p.add_argument("--lake", required=True, help="folder of the flattened set, by run")
    p.add_argument("--etl-name", default=ETL_NAME)
    p.add_argument("--tz", default="UTC", help="zone of the date columns")
    p.add_argument("--null-safe", action="store_true", help="match NULL subscriptions")
    p.add_argument("--join-strategy", default="auto", choices=["auto", "nested", "shuffle"])
    p.add_argument("--multiline", action="store_true", help="one JSON document per file")
    p.add_argument("--by-fetch", action="store_const", const=True, default=None,
                   help="the report folder holds a folder per fetch (else as the folder looks)")
    p.add_argument("--whole-report", dest="by_fetch", action="store_const", const=False,
                   help="the report folder is one cumulative report, whatever folders it holds")
    p.add_argument("--up-to-fetch", default=None, help="name of the last fetch that this run may take")
    p.add_argument("--filter-field", default="id", help="invoice field that a delta compares with its mark")
    p.add_argument("--lease-seconds", type=float, default=3600.0, help="how long a run owns its control row after each step")
    p.add_argument("--on-duplicate-ids", default="fail", choices=["fail", "join"])
    p.add_argument("--seed", action="store_true", help="create the control table if absent")
    p.add_argument("--jdbc-url", default=None)
    p.add_argument("--jdbc-table", default="invoice_data")
    p.add_argument("--jdbc-driver", default=None)
    return p.parse_args(argv)


def main(argv=None) -> dict:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("ledgerline-invoice-load").getOrCreate()
    settings = LoadSettings(
        report_path=args.report, target_path=args.target, control_path=args.control,
        lake_path=args.lake, etl_name=args.etl_name, tz=args.tz, null_safe=args.null_safe,
        join_strategy=args.join_strategy, multiline=args.multiline,
        on_duplicate_ids=args.on_duplicate_ids, by_fetch=args.by_fetch,
        filter_field=args.filter_field, up_to_fetch=args.up_to_fetch, lease_seconds=args.lease_seconds,
        target_format="jdbc" if args.jdbc_url else "parquet", jdbc_url=args.jdbc_url,
        jdbc_table=args.jdbc_table, jdbc_driver=args.jdbc_driver,
    )
    if args.seed:
        RunHistory(spark, settings.control_path).seed(settings.etl_name)
    outcome = asdict(run_load(spark, settings))
    print(json.dumps(outcome))
    return outcome


if __name__ == "__main__":
    main()
