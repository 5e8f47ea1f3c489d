"""Run analyses over a folder of model tables.

    spark-submit -m tidemark --input /data/saas --format csv --output /out/kpi
    python -m tidemark --input /data/saas --analyses monthly_revenue,churn_rate --show

``--input`` holds ``customers``, ``subscriptions``, ``payments`` and ``costs``
as typed CSV (``<table>.csv``, loaded with the declared schemas) or as the
Parquet folders written by :func:`tidemark.sources.write_parquet`.  Each
analysis is written to ``--output/<name>`` (Parquet, or CSV with header);
``--dashboard`` writes the nine dashboard exports instead.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from tidemark.params import DEFAULT
from tidemark.plans import ANALYSES
from tidemark.plans.dashboard import export_dashboard
from tidemark.session import configure, ensure_checkpoint_dir
from tidemark.sources import export_csv, load_tables, read_parquet


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--input", help="folder with the four model tables")
    ap.add_argument("--format", choices=["csv", "parquet"], default="csv", help="format of --input")
    ap.add_argument("--output", help="folder for the results")
    ap.add_argument("--out-format", choices=["csv", "parquet"], default="parquet")
    ap.add_argument("--analyses", default="", help="comma-separated keys (default: all)")
    ap.add_argument("--dashboard", action="store_true", help="write the nine dashboard CSV exports")
    ap.add_argument("--show", action="store_true", help="print a preview of each result instead of writing it")
    ap.add_argument("--rows", type=int, default=50, help="rows of a --show preview")
    ap.add_argument("--list", action="store_true", help="list the analysis keys and exit")
    args = ap.parse_args(argv)

    if args.list:
        print("\n".join(ANALYSES))
        return 0
    if not args.input:
        ap.error("--input is required")
    if not args.output and not args.show:
        ap.error("--output is required (or --show for a preview)")

    spark = configure(SparkSession.builder.appName("tidemark").getOrCreate())
    tables = load_tables(spark, args.input) if args.format == "csv" else read_parquet(spark, args.input)

    if args.dashboard:
        if not args.output:
            ap.error("--dashboard needs --output")
        ensure_checkpoint_dir(spark)
        export_dashboard(tables, args.output, DEFAULT)
        return 0

    keys = [k for k in args.analyses.split(",") if k] or list(ANALYSES)
    unknown = [k for k in keys if k not in ANALYSES]
    if unknown:
        ap.error(f"unknown analyses: {', '.join(unknown)}")
    for key in keys:
        df = ANALYSES[key](tables, DEFAULT)
        if args.show:
            print(f"== {key} (preview: at most {args.rows} rows)")
            df.show(args.rows, truncate=False)
        elif args.out_format == "csv":
            export_csv(df, os.path.join(args.output, key))
        else:
            df.write.mode("overwrite").parquet(os.path.join(args.output, key))
    return 0


if __name__ == "__main__":
    sys.exit(main())
