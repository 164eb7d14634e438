"""Batches into an existing silver table and gold (A11 across batches, L1, L2, S3/S6 re-runs).

A batch of raw rows becomes silver rows (``build_silver``), and these meet the stored rows of the same keys:
the survivor rule of the dedup decides between the stored row and the new one.  What changes is a *delta*:
rows to add and rows that they replace.  Because the rule is a minimum, the order of the batches does not
matter.

* Only stored partitions that the batch touches are read, and the join carries their keys.  Without replaced
  rows the added ones are appended and no stored file is touched; otherwise the touched partitions are
  rewritten (dynamic partition overwrite) and all others keep their files.
* Gold is a sum of states (``gold.gold_states``): integer counts and exact sums.  A batch writes the state of
  its delta, replaced rows with sign -1, so gold costs one pass over the delta and one over the states.
* Every batch has a name.  Its delta is written first, then its state, then silver, then a commit mark.  A
  batch that died is started again under its name: it goes on from the written delta, and a committed batch
  is left alone.  Nothing is counted twice.

Partition columns must be functions of the dedup keys (the year of the sample date, by default), so that all
rows of a key lie in one partition.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydrix._util import as_list, require_columns
from hydrix.functions.dates import _as_date, in_window
from hydrix.operators.dedup import _sort_key, orderable_columns
from hydrix.operators.quality import assert_checks
from hydrix.plans.gates import gold_gate
from hydrix.plans.gold import GoldSpec, finish_states, gold_states, merge_states, value_kind
from hydrix.plans.medallion import SILVER_TABLE, silver_path_of, stage_gold
from hydrix.plans.silver import BAD_DATE, SilverSpec, bad_date, build_silver
from hydrix.session import Scratch, apply_conf, delete_path, path_exists, restore_conf
from hydrix.sources.files import read_parquet, write_parquet
from hydrix.sources.publish import Publication, read_small, write_small

SIGN = "_sign"
ADDED, REMOVED = 1, -1
#: Partition values that one batch or window may touch; they are listed in the plan.
MOST_PARTITIONS = 10_000


@dataclass
class BatchResult:
    """``added`` and ``removed`` rows of silver, and whether the batch had been committed before."""

    batch: str
    added: int
    removed: int
    repeated: bool


def survivor_order(silver: DataFrame, spec: SilverSpec) -> list[Column | str]:
    """The dedup's tie-break on silver rows: the same columns as in ``build_silver``."""
    if spec.tie_break is not None:
        return list(spec.tie_break)
    derived = [spec.clean_date_col, spec.year_col, spec.value_col, spec.category_col]
    return orderable_columns(silver.drop(*derived), exclude=spec.dedup_keys)


def _values(rows: DataFrame, cols: Sequence[str]) -> list[tuple]:
    """Distinct partition values: a list that is as long as the layout, not the data."""
    found = rows.select(*cols).distinct().limit(MOST_PARTITIONS + 1).collect()
    if len(found) > MOST_PARTITIONS:
        raise ValueError(f"more than {MOST_PARTITIONS} partitions of {list(cols)}: choose coarser partition columns")
    return [tuple(r) for r in found]


def in_partitions(cols: Sequence[str], values: Sequence[tuple]) -> Column:
    """Predicate on partition columns only, so that Spark prunes folders."""
    found = F.lit(False)
    if len(cols) == 1:
        plain = [v for (v,) in values if v is not None]
        found = F.col(cols[0]).isin(plain) if plain else found
        return found | F.col(cols[0]).isNull() if len(plain) < len(values) else found
    for value in values:
        same = F.lit(True)
        for c, v in zip(cols, value):
            same = same & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        found = found | same
    return found


def silver_delta(stored: DataFrame | None, new: DataFrame, spec: SilverSpec = SilverSpec()) -> DataFrame:
    """Rows that a batch adds to silver (``_sign`` 1) and rows that they replace (-1).

    ``stored`` and ``new`` each hold one row a key.  A stored row stays where it comes first in the survivor
    order or is equal in it.  Stored rows whose key the batch does not have are left out by a semi join.
    """
    origin, place = "_origin", "_place"
    fresh = new.withColumn(origin, F.lit(1)).withColumn(BAD_DATE, bad_date(spec))
    keys = [*spec.dedup_keys, BAD_DATE]
    if stored is None:
        return fresh.withColumn(SIGN, F.lit(ADDED)).drop(origin, BAD_DATE)
    old = stored.select(*new.columns).withColumn(origin, F.lit(0)).withColumn(BAD_DATE, bad_date(spec))
    wanted = fresh.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    both = old.join(wanted, same, "left_semi").unionByName(fresh)
    order = [_sort_key(c) for c in survivor_order(new, spec)]
    ranked = both.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.col(origin))))
    added, replaced = (F.col(place) == 1) & (F.col(origin) == 1), (F.col(place) > 1) & (F.col(origin) == 0)
    out = ranked.withColumn(SIGN, F.when(added, ADDED).when(replaced, REMOVED)).filter(F.col(SIGN).isNotNull())
    return out.drop(origin, place, BAD_DATE)


def _overwrite_partitions(rows: DataFrame, path: str, cols: Sequence[str]) -> None:
    """Replaces exactly the partitions that ``rows`` has values of."""
    previous = apply_conf(rows.sparkSession, {"spark.sql.sources.partitionOverwriteMode": "dynamic"})
    try:
        rows.hint("rebalance", *cols).write.mode("overwrite").partitionBy(*cols).parquet(path)
    finally:
        restore_conf(rows.sparkSession, previous)


def apply_delta(spark: SparkSession, path: str, delta: DataFrame, spec: SilverSpec, cols: Sequence[str], *, append: bool) -> None:
    """Brings the silver table up to the delta.

    ``append`` adds the new rows as files of their own: right where nothing is replaced and this delta was
    never applied before.  Otherwise the touched partitions are rewritten, which may be repeated.
    """
    added = delta.filter(F.col(SIGN) == ADDED).drop(SIGN)
    if append:
        added.hint("rebalance", *cols).write.mode("append").partitionBy(*cols).parquet(path)
        return
    stored = read_parquet(spark, path, on_missing="skip")
    if stored is None:
        _overwrite_partitions(added, path, cols)
        return
    touched = stored.filter(in_partitions(cols, _values(delta, cols)))
    keys = [*spec.dedup_keys, BAD_DATE]
    gone = delta.withColumn(BAD_DATE, bad_date(spec)).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).distinct()
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    kept = touched.withColumn(BAD_DATE, bad_date(spec)).join(gone, same, "left_anti").drop(BAD_DATE)
    with Scratch(spark, "silver-merge") as scratch:  # the table's own files are replaced: read them to the end first
        rows = scratch.stage(kept.select(*added.columns).unionByName(added), "rows")
        _overwrite_partitions(rows, path, cols)


def merge_batch(
    spark: SparkSession,
    raw: DataFrame,
    out_root: str,
    batch: str,
    predicate: Column,
    *,
    spec: SilverSpec = SilverSpec(),
    gold_spec: GoldSpec = GoldSpec(exact_means=True),
    partition_by: Sequence[str] = ("annee",),
    table: str = SILVER_TABLE,
) -> BatchResult:
    """Takes a batch of raw rows into silver and into the gold states under ``out_root``.

    One batch at a time.  Run it again under its name after a failure; the rows of a batch that died are
    those of its first delta.  ``publish_gold`` makes the gold tables from the states.
    """
    cols, root = as_list(partition_by), out_root.rstrip("/")
    mark, delta_path = f"{root}/_batches/{batch}.json", f"{root}/_deltas/{batch}"
    if path_exists(spark, mark):
        done = json.loads(read_small(spark, mark))
        return BatchResult(batch, done["added"], done["removed"], True)
    path = silver_path_of(root, table)
    resumed = path_exists(spark, f"{delta_path}/_SUCCESS")
    if not resumed:
        with Scratch(spark, "batch") as scratch:
            new = scratch.stage(build_silver(raw, spec), "new")
            require_columns(new, cols, "partition column")
            stored = read_parquet(spark, path, on_missing="skip")
            if stored is not None:
                stored = stored.filter(in_partitions(cols, _values(new, cols)))
            write_parquet(silver_delta(stored, new, spec), delta_path)
    delta = read_parquet(spark, delta_path)
    state_path = f"{root}/gold_states/batch={batch}"
    kind = value_kind(delta, gold_spec)
    signed = [gold_states(delta.filter(F.col(SIGN) == s), predicate, gold_spec).withColumn(SIGN, F.lit(s)) for s in (ADDED, REMOVED)]
    write_parquet(merge_states(signed[0].unionByName(signed[1]), kind, gold_spec, SIGN), state_path)
    n = delta.agg(F.count_if(F.col(SIGN) == ADDED).alias("a"), F.count_if(F.col(SIGN) == REMOVED).alias("r")).first()
    if n.a:
        apply_delta(spark, path, delta, spec, cols, append=not resumed and not n.r)
    write_small(spark, mark, json.dumps({"added": n.a, "removed": n.r}))
    return BatchResult(batch, n.a, n.r, False)


def read_states(spark: SparkSession, out_root: str) -> DataFrame:
    return spark.read.parquet(f"{out_root.rstrip('/')}/gold_states")


def publish_gold(
    spark: SparkSession, out_root: str, gold_spec: GoldSpec = GoldSpec(exact_means=True), *, kind: str = "float", on_failure: str = "report"
) -> list:
    """The gold tables from the states of all batches, gated and published all or none; the check rows."""
    states = read_states(spark, out_root).drop("batch")
    with Publication(spark, out_root) as publication:
        tables = stage_gold(publication, finish_states(merge_states(states, kind, gold_spec), kind), gold_spec, "gold/")
        checks = assert_checks(gold_gate(tables, gold_spec), on_failure)
        publication.switch()
    return checks


def compact_states(spark: SparkSession, out_root: str, gold_spec: GoldSpec = GoldSpec(exact_means=True), *, kind: str = "float") -> None:
    """Adds the states of all batches up into one, so that their number does not grow for ever."""
    root = out_root.rstrip("/")
    with Publication(spark, root) as publication:
        merged = merge_states(read_states(spark, root).drop("batch"), kind, gold_spec)
        # the whole states folder is replaced at once: a state is either in the sum or beside it, never both
        write_parquet(merged.withColumn("batch", F.lit("compacted")), publication.path("gold_states"), partition_by=("batch",))
        publication.switch()


def rerun_window(
    spark: SparkSession,
    raw: DataFrame,
    silver_path: str,
    window: tuple[str, str],
    *,
    spec: SilverSpec = SilverSpec(),
    year_col: str | None = None,
) -> int:
    """Builds silver anew for a window of sample days and replaces only that window's rows; their number.

    The table is partitioned by its year column.  Partitions outside the window's years keep their files; in
    the touched ones the rows of other days are carried over unchanged.  Rows without a readable date are
    in no window and stay.  The raw rows may be more than the window's.
    """
    year = year_col or spec.year_col
    lo, hi = (_as_date(d) for d in window)
    inside = in_window(F.col(spec.clean_date_col), lo, hi)
    fresh = build_silver(raw, spec).filter(inside)
    stored = read_parquet(spark, silver_path, on_missing="skip")
    with Scratch(spark, "window") as scratch:
        if stored is None:
            rows = fresh
        else:
            rest = stored.filter(F.col(year).between(lo.year, hi.year) & ~F.coalesce(inside, F.lit(False)))
            rows = rest.select(*fresh.columns).unionByName(fresh)
        rows = scratch.stage(rows, "rows")
        n = rows.filter(inside).count()
        emptied = [] if stored is None else _emptied(stored, rows, year, lo.year, hi.year)
        _overwrite_partitions(rows, silver_path, [year])
        for value in emptied:  # a year that lost its last row has no new partition to replace the old one
            delete_path(spark, f"{silver_path.rstrip('/')}/{year}={value}")
    return n


def _emptied(stored: DataFrame, rows: DataFrame, year: str, first: int, last: int) -> list[int]:
    had = {v for (v,) in _values(stored.filter(F.col(year).between(first, last)), [year])}
    return sorted(had - {v for (v,) in _values(rows, [year])})
