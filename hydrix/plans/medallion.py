"""End-to-end run: bronze files -> silver Parquet -> gold Parquet -> quality results.

Each layer is written once and read back, so later stages start from a short plan over Parquet (the
written table cuts lineage; a lost executor recomputes from the last written layer, not from the raw
JSON).  The three grouped gold tables come from ONE grouping-sets aggregate over the written silver
table (one scan, one shuffle); the worst-k table is taken from the written conformity table.

The cleaning report needs no pass of its own.  Bronze is split into kept rows and a rejects table with
reason codes (``operators.rejects``) by one job without a shuffle, whose observed metrics are the report;
silver's own row count is observed in the last stage of its write.  Both are result stages, in which Spark
takes a task's metrics once however often it is retried.  JSON is parsed in that one job only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hydrix.functions.dates import in_window, parse_date
from hydrix._util import as_list
from hydrix.operators.columns import not_null_all, parse_failure
from hydrix.operators.quality import assert_checks
from hydrix.operators.rejects import Split, observed, write_split
from hydrix.plans.gates import gold_gate, silver_gate
from hydrix.plans.gold import (
    CONFORMITY,
    GOLD_TABLES,
    NONCONFORMITY,
    TREND,
    WORST,
    GoldSpec,
    category_is,
    gold_aggregate,
    gold_worst,
    split_gold,
)
from hydrix.plans.silver import NOT_TAKEN, SilverSpec, bad_date, build_silver, clean, reject_rules
from hydrix.sources.files import CORRUPT_RECORD, read_json, read_parquet, reads_json, write_parquet
from hydrix.sources.paged import page_rows, read_pages
from hydrix.sources.publish import Publication


#: Folder of the silver table under the output root.
SILVER_TABLE = "measurements"


def silver_path_of(out_root: str, table: str = SILVER_TABLE) -> str:
    return f"{out_root.rstrip('/')}/silver/{table}"


@dataclass
class RunResult:
    silver_path: str
    gold_paths: dict[str, str]
    quality_path: str
    rejects_path: str
    report: dict = field(default_factory=dict)
    checks: list = field(default_factory=list)


def read_bronze(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "jsonl",
    row_schema: StructType | None = None,
    partitions: int | None = None,
    corrupt_column: str | None = None,
    page_col: str | None = None,
    on_malformed: str = "raise",
    window: tuple[str, str] | None = None,
    date_col: str = SilverSpec.date_col,
) -> DataFrame:
    """``jsonl`` (one row per line), ``pages`` (one envelope per line) or ``parquet``.

    ``on_malformed`` says whether a JSON line or page that does not parse stops the job or is skipped.
    ``corrupt_column`` (JSON Lines) keeps malformed lines as rows instead, with the raw text in that column:
    ``write_silver`` then writes them to the rejects table.  ``page_col`` (pages landed with their page
    number) applies the paging rules: one copy per page, nothing after the end page.

    ``window`` (first and last day, inclusive) keeps rows whose ``date_col`` parses to a day inside it,
    as a fetch for that period would; rows without a readable date are outside every window.  Give the
    window to ``write_silver`` or ``run_medallion`` instead to have those rows counted and kept as rejects
    (``silver.window_counts`` counts them alone).

    ``partitions`` spreads the rows over that many tasks with one round-robin shuffle.  Use it only
    for landing files that cannot be split (e.g. large gzip JSON, one task per file); splittable
    input is already read in parallel and needs no extra shuffle.
    """
    if fmt == "jsonl":
        df = read_json(spark, path, row_schema, corrupt_column=corrupt_column, on_malformed=on_malformed)
        if row_schema is None and corrupt_column is None and CORRUPT_RECORD in df.columns:
            row_schema = StructType([f for f in df.schema.fields if f.name != CORRUPT_RECORD])
            df = read_json(spark, path, row_schema, on_malformed=on_malformed)
    elif fmt == "pages":
        df = page_rows(read_pages(spark, path, row_schema, with_page=page_col is not None), page_col, on_malformed=on_malformed)
    elif fmt == "parquet":
        df = read_parquet(spark, path)
    else:
        raise ValueError(f"unknown bronze format {fmt!r}")
    if window is not None:
        df = df.filter(in_window(parse_date(date_col), *window))
    return df.repartition(int(partitions)) if partitions else df


def cleaning_report(
    raw: DataFrame, spec: SilverSpec = SilverSpec(), corrupt_column: str | None = None
) -> DataFrame:
    """One row: raw rows, parse failures, dates that do not parse, rows with all required fields (one
    aggregate pass), and malformed input lines when ``corrupt_column`` is given."""
    typed = clean(raw, spec)
    result_col = spec.renames.get(spec.result_col, spec.result_col)
    aggs = [
        F.count(F.lit(1)).alias("rows_raw"),
        F.count_if(parse_failure(result_col, spec.value_col)).alias("parse_failures"),
        F.count_if(bad_date(spec).isNotNull()).alias("bad_dates"),
        F.count_if(not_null_all(spec.required)).alias("rows_required"),
    ]
    if corrupt_column is not None and corrupt_column in raw.columns:
        aggs.append(F.count_if(F.col(corrupt_column).isNotNull()).alias("rows_malformed"))
    return typed.agg(*aggs)


def write_silver(
    spark: SparkSession,
    bronze: DataFrame,
    out_root: str,
    spec: SilverSpec = SilverSpec(),
    *,
    table: str = SILVER_TABLE,
    partition_by: tuple[str, ...] | None = None,
    corrupt_column: str | None = None,
    reject: tuple[str, ...] = NOT_TAKEN,
    window: tuple[str, str] | None = None,
    silver_path: str | None = None,
) -> tuple[str, str, dict]:
    """Writes silver and the rejects table under ``out_root``: (silver path, rejects path, report).

    ``reject`` names the defects (``silver.DEFECTS``) whose rows go to ``rejects`` instead of silver, each with
    the codes of all its defects.  With ``window`` rows outside it are left out and counted, and rows without
    a readable date are rejects.  JSON is landed as Parquet by the job that splits it; of other formats only
    the rejects are written.  ``silver_path`` names another folder for silver (a staged one).
    """
    out_root = out_root.rstrip("/")
    malformed = corrupt_column if corrupt_column in bronze.columns else None
    rules = reject_rules(spec, drop=reject, corrupt_column=malformed, windowed=window is not None)
    raw_name = {new: old for old, new in spec.renames.items()}
    required = not_null_all([raw_name.get(c, c) for c in spec.required])
    if malformed:
        required = required & F.col(malformed).isNull()
    split: Split = write_split(
        bronze, f"{out_root}/bronze_landed", rules, metrics={"rows_required": F.count_if(required)},
        within=in_window(parse_date(spec.date_col), *window) if window is not None else None, copy_kept=reads_json(bronze),
    )
    rejects_path = write_parquet(split.rejects, f"{out_root}/rejects")
    silver = build_silver(split.kept.drop(malformed) if malformed else split.kept, spec)
    if partition_by:  # before the metrics: no shuffle may follow them
        silver = silver.hint("rebalance", *as_list(partition_by))
    silver_path = silver_path or silver_path_of(out_root, table)
    written = observed(
        silver, {"rows_silver": F.count(F.lit(1))},
        lambda rows: write_parquet(rows, silver_path, partition_by=partition_by, rebalance=False),
    )
    n = split.counts
    report = {
        "rows_raw": n["rows_in"], "parse_failures": n["n_unparseable_result"], "bad_dates": n["n_bad_date"],
        "rows_required": n["rows_required"], "rows_rejected": n["rows_rejected"], "rows_silver": written["rows_silver"],
        "duplicates_removed": n["rows_in"] - n["rows_rejected"] - n["rows_outside"] - written["rows_silver"],
    }
    if malformed:
        report["rows_malformed"] = n["n_malformed"]
    if window is not None:
        report["rows_outside"] = n["rows_outside"]
    return silver_path, rejects_path, report


def stage_gold(publication: Publication, aggregate: DataFrame, spec: GoldSpec, folder: str = "") -> dict[str, DataFrame]:
    """Writes the aggregate and the four gold tables as staged tables; they become ``<root>/<folder><table>``.

    The aggregate is written once (``_aggregate``) and split into the grouped tables; the worst-k table is
    taken from the written conformity table.
    """
    spark = publication.spark
    path = lambda t: publication.path(f"{folder}{t}")
    tables = split_gold(read_parquet(spark, write_parquet(aggregate, path("_aggregate"))), spec)
    staged = {t: read_parquet(spark, write_parquet(tables[t], path(t))) for t in (CONFORMITY, TREND, NONCONFORMITY)}
    staged[WORST] = read_parquet(spark, write_parquet(gold_worst(staged[CONFORMITY], spec), path(WORST)))
    return {t: staged[t] for t in GOLD_TABLES}


def write_gold(
    spark: SparkSession, silver: DataFrame, predicate: Column, gold_root: str, spec: GoldSpec = GoldSpec()
) -> dict[str, str]:
    """Write the four gold tables under ``gold_root``, all or none; returns their paths."""
    gold_root = gold_root.rstrip("/")
    with Publication(spark, gold_root) as publication:
        stage_gold(publication, gold_aggregate(silver, predicate, spec), spec)
        publication.switch()
    return {t: f"{gold_root}/{t}" for t in GOLD_TABLES}


def run_medallion(
    spark: SparkSession,
    bronze: DataFrame,
    out_root: str,
    *,
    predicate: Column | None = None,
    silver_spec: SilverSpec = SilverSpec(),
    gold_spec: GoldSpec = GoldSpec(),
    on_failure: str = "report",
    silver_partition_by: tuple[str, ...] | None = None,
    silver_table: str = SILVER_TABLE,
    corrupt_column: str | None = None,
    reject: tuple[str, ...] = NOT_TAKEN,
    window: tuple[str, str] | None = None,
) -> RunResult:
    """Build, gate and write every layer under ``out_root``; return paths, report and checks.

    Order: silver and the rejects (``write_silver``), silver's checks, gold, its checks.  Silver and gold are
    staged, and published together after the last check: an error, or a failed check with
    ``on_failure="raise"``, leaves the tables of the former run.  Rejects and check results are written as
    they come, for they explain a run that stopped.
    """
    out_root = out_root.rstrip("/")
    predicate = category_is() if predicate is None else predicate
    quality_path = f"{out_root}/quality/checks"
    silver_path = silver_path_of(out_root, silver_table)
    with Publication(spark, out_root) as publication:
        staged, rejects_path, report = write_silver(
            spark, bronze, out_root, silver_spec, table=silver_table, partition_by=silver_partition_by,
            corrupt_column=corrupt_column, reject=reject, window=window,
            silver_path=publication.path(silver_path.removeprefix(f"{out_root}/")),
        )
        silver = read_parquet(spark, staged)
        checks = write_parquet(silver_gate(silver), f"{quality_path}/layer=silver")
        checks = assert_checks(read_parquet(spark, checks), on_failure)
        gold = stage_gold(publication, gold_aggregate(silver, predicate, gold_spec), gold_spec, "gold/")
        gold_checks = write_parquet(gold_gate(gold, gold_spec), f"{quality_path}/layer=gold")
        checks += assert_checks(read_parquet(spark, gold_checks), on_failure)
        publication.switch()
    gold_paths = {t: f"{out_root}/gold/{t}" for t in GOLD_TABLES}
    return RunResult(silver_path, gold_paths, quality_path, rejects_path, report, checks)
