"""Command line: ``python -m hydrix <step> ...`` (or ``spark-submit hydrix/__main__.py <step> ...``).

Steps, in the order a run uses them:

  ingest          landed page envelopes -> bronze Parquet (incremental, checkpointed)
  silver          bronze -> silver Parquet (prints the cleaning report)
  gold            silver -> the four gold tables
  silver-quality  checks on the silver table (``--on-missing skip`` exits 0 when it is absent)
  gold-quality    checks on the gold tables
  profile         raw-table profile written as Parquet
  run             every step above except ingest and profile, in one go

Every path is an argument; the session comes from ``SparkSession.builder.getOrCreate()`` so the
cluster's own configuration (master, ``spark.checkpoint.dir``...) applies.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from hydrix.operators.quality import CheckFailed, assert_checks, render_report
from hydrix.plans.explore import raw_profile
from hydrix.plans.gates import gold_gate, silver_gate
from hydrix.plans.gold import GOLD_TABLES, GoldSpec, category_is, status_is
from hydrix.plans.medallion import (
    SILVER_TABLE,
    read_bronze,
    run_medallion,
    silver_path_of,
    write_gold,
    write_silver,
)
from hydrix.plans.silver import DEFECTS, NOT_TAKEN, SilverSpec
from hydrix.sources.files import read_parquet, write_parquet


def _predicate(args):
    return status_is(args.status, args.status_column) if args.status else category_is()


def _report(rows, on_failure: str) -> int:
    print(render_report(rows))
    failed = any(r["success"] is False for r in rows)
    return 1 if failed and on_failure == "raise" else 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="hydrix", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="step", required=True)

    def common(sp, bronze=False):
        if bronze:
            sp.add_argument("--bronze", required=True)
            sp.add_argument("--format", default="jsonl", choices=["jsonl", "pages", "parquet"])
            sp.add_argument("--partitions", type=int, default=None)
            sp.add_argument("--schema", default=None, help="DDL of one raw row; without it JSON is inferred")
            sp.add_argument("--corrupt-column", default=None, help="malformed JSON lines become rejects, with their text in this column")
            sp.add_argument("--page-col", default=None, help="page number column of landed pages")
            sp.add_argument("--on-malformed", default="raise", choices=["raise", "skip"])
            sp.add_argument("--reject", default=",".join(NOT_TAKEN),
                            help=f"comma list of the defects whose rows become rejects: {', '.join(DEFECTS)}")
            sp.add_argument("--start", default=None, help="first day of the sample dates to keep")
            sp.add_argument("--end", default=None, help="last day of the sample dates to keep")
            sp.add_argument("--tie-break", default=None, help="comma list: which row of a duplicate key stays")
            sp.add_argument("--partition-by", default=None, help="comma list: partition columns of the silver table")
        sp.add_argument("--out", required=True, help="root folder of the silver/gold/quality outputs")
        sp.add_argument("--status", default=None, help="value of the status column that means conforming")
        sp.add_argument("--status-column", default="conclusion_conformite_prelevement")
        sp.add_argument("--on-failure", default="report", choices=["report", "raise"])
        sp.add_argument("--k", type=int, default=10)
        sp.add_argument("--silver-table", default=SILVER_TABLE, help="folder of the silver table under OUT/silver")
        sp.add_argument("--input-bytes", type=int, default=None,
                        help="size of the input; sets shuffle width, AQE and scan split size for it")

    ing = sub.add_parser("ingest")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--bronze", required=True)
    ing.add_argument("--schema", required=True, help="DDL of one raw row, e.g. 'code_prelevement string, ...'")
    ing.add_argument("--checkpoint", default=None, help="default: _checkpoint in the bronze folder")
    ing.add_argument("--on-malformed", default="raise", choices=["raise", "skip"])
    common(sub.add_parser("silver"), bronze=True)
    common(sub.add_parser("gold"))
    sq = sub.add_parser("silver-quality")
    common(sq)
    sq.add_argument("--on-missing", default="raise", choices=["raise", "skip"])
    common(sub.add_parser("gold-quality"))
    prof = sub.add_parser("profile")
    common(prof, bronze=True)
    common(sub.add_parser("run"), bronze=True)

    args = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"hydrix-{args.step}").getOrCreate()

    if args.step == "ingest":
        from hydrix.streaming import ingest_pages

        row_schema = spark.createDataFrame([], args.schema).schema  # DDL -> StructType
        q = ingest_pages(spark, args.landing, args.bronze, row_schema, checkpoint=args.checkpoint,
                         on_malformed=args.on_malformed)
        q.awaitTermination()
        return 0

    if getattr(args, "input_bytes", None):
        from hydrix.session import apply_conf, scale_conf

        apply_conf(spark, scale_conf(args.input_bytes))

    out = args.out.rstrip("/")
    silver_path = silver_path_of(out, args.silver_table)
    gold_paths = {t: f"{out}/gold/{t}" for t in GOLD_TABLES}
    spec = GoldSpec(k=args.k)

    if args.step in ("silver", "profile", "run"):
        if (args.start is None) != (args.end is None):
            p.error("--start and --end go together")
        bronze = read_bronze(
            spark, args.bronze, fmt=args.format, partitions=args.partitions, corrupt_column=args.corrupt_column,
            row_schema=spark.createDataFrame([], args.schema).schema if args.schema else None,
            page_col=args.page_col, on_malformed=args.on_malformed,
            window=(args.start, args.end) if args.start and args.step == "profile" else None,
        )
        landing = dict(
            corrupt_column=args.corrupt_column, reject=tuple(d for d in args.reject.split(",") if d),
            window=(args.start, args.end) if args.start else None,
        )
        silver_spec = SilverSpec(tie_break=tuple(args.tie_break.split(",")) if args.tie_break else None)
        partition_by = tuple(args.partition_by.split(",")) if args.partition_by else None
    if args.step == "silver":
        _, _, report = write_silver(
            spark, bronze, out, silver_spec, table=args.silver_table, partition_by=partition_by, **landing
        )
        print(json.dumps(report))
        return 0
    if args.step == "gold":
        write_gold(spark, read_parquet(spark, silver_path), _predicate(args), f"{out}/gold", spec)
        return 0
    if args.step == "silver-quality":
        silver = read_parquet(spark, silver_path, on_missing=args.on_missing)
        if silver is None:
            print(f"silver table not found at {silver_path}; checks skipped")
            return 0
        return _report(assert_checks(silver_gate(silver), "report"), args.on_failure)
    if args.step == "gold-quality":
        tables = {t: read_parquet(spark, path) for t, path in gold_paths.items()}
        return _report(assert_checks(gold_gate(tables, spec), "report"), args.on_failure)
    if args.step == "profile":
        write_parquet(raw_profile(bronze), f"{out}/profile")
        return 0
    if args.step == "run":
        try:
            res = run_medallion(
                spark, bronze, out, predicate=_predicate(args), gold_spec=spec, silver_spec=silver_spec,
                silver_partition_by=partition_by, silver_table=args.silver_table, on_failure=args.on_failure, **landing,
            )
        except CheckFailed as err:
            print(err)
            return 1
        print(json.dumps(res.report))
        return _report(res.checks, args.on_failure)
    return 2


if __name__ == "__main__":
    sys.exit(main())
