"""Command line of the jobs, for ``spark-submit`` or ``python -m loomwright``."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from .config import load_config
from .operators.load import expire_snapshots
from .plans.ingest import ingest_all, results_frame
from .plans.models import MART_STATUSES, build_models, mart_checkpoint, read_models, read_seeds
from .plans.sweep import sweep_row_counts
from .plans.validate import validate_tables


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="loomwright", description="Load and check tables from a configuration.")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="load the tables of a configuration and check them")
    validate = jobs.add_parser("validate", help="check loaded tables and keep the findings")
    for job in (ingest, validate):
        job.add_argument("--config", help="YAML file; the CONFIG_YAML variable takes precedence")
        job.add_argument("--source-id", help="do nothing unless the configuration has this name")
        job.add_argument("--only", nargs="*", help="ids of the tables to process")
    ingest.add_argument("--base-path", help="folder that stands in for the bucket")
    ingest.add_argument("--run-id")
    validate.add_argument("--output", help="folder for the findings as JSON")
    validate.add_argument("--upload", help="folder for a copy; failing to write it is only a warning")

    build = jobs.add_parser("build", help="load seeds, create the views of a folder of models, and test them")
    build.add_argument("--models", required=True, help="folder of SQL models")
    build.add_argument("--seeds", help="folder of CSV files")
    build.add_argument("--schema", required=True)

    checkpoint = jobs.add_parser("checkpoint", help="check the finished mart of orders")
    checkpoint.add_argument("table")
    checkpoint.add_argument("--statuses", nargs="+", default=list(MART_STATUSES))

    expire = jobs.add_parser("expire", help="delete rows that loads have replaced and kept for readers")
    expire.add_argument("table")
    expire.add_argument("--hours", type=float, default=0.0, help="keep what was replaced since")

    sweep = jobs.add_parser("sweep", help="check that every table of a schema has rows")
    sweep.add_argument("schema")
    sweep.add_argument("--allow-no-tables", action="store_true")
    sweep.add_argument("--include-views", action="store_true")
    return parser


def _print(rows: DataFrame) -> None:
    for row in rows.toJSON().collect():
        print(row)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 if everything passed (or nothing was selected), 1 if not."""
    args = _parser().parse_args(argv)
    config = load_config(args.config, strict=False) if args.job in ("ingest", "validate") else None
    if config and not config.select(args.only, args.source_id):
        print("No tables selected.")
        return 0
    spark = spark or SparkSession.builder.appName(f"loomwright-{args.job}").enableHiveSupport().getOrCreate()
    if args.job == "ingest":
        results = ingest_all(spark, config, args.base_path, args.run_id, args.only)
        _print(results_frame(spark, results))
        return int(any(r.error for r in results))
    if args.job == "validate":
        summary = validate_tables(spark, config, args.only, args.source_id, args.output, args.upload)
        _print(summary)
        return int(not summary.where("NOT success").isEmpty())
    if args.job == "build":
        nodes = build_models(spark, read_models(args.models, spark), read_seeds(args.seeds, spark) if args.seeds else (), args.schema)
        _print(nodes)
        return int(not nodes.where("status <> 'success'").isEmpty())
    if args.job == "checkpoint":
        checks = mart_checkpoint(spark, args.table, args.statuses)
        _print(checks)
        return int(not checks.where("NOT passed").isEmpty())
    if args.job == "expire":
        print(f"{expire_snapshots(spark, args.table, timedelta(hours=args.hours))} snapshots deleted")
        return 0
    found = sweep_row_counts(spark, args.schema, not args.allow_no_tables, args.include_views, on_failure="warn")
    _print(found)
    return int(not found.where("NOT passed").isEmpty())


if __name__ == "__main__":
    sys.exit(main())
