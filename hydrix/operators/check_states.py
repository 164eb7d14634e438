"""Mergeable states of data-quality checks (Q1-Q6): counts that can be stored per partition and added up.

The state of a check on some rows is its count of unexpected rows and the rows' number.  Both are sums, so
the states of parts of a table add up to the state of the whole table, and the check's result is a function
of that sum alone:

* ``partition_states`` -- the states of every partition, one scan and one partial aggregate;
* ``merge_states``     -- adds states up per check;
* ``state_results``    -- result rows as ``run_checks`` gives them.

A column that is absent from the table has no count (NULL), and its check is ``skipped``.  A check is known by
its position in the list, so stored states hold for that list only (``checks_key``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix._util import as_list, require_columns
from hydrix.operators.quality import RULE, Check, result_row

CHECK, UNEXPECTED, ROWS = "_check", "_unexpected", "_rows"


def checks_key(checks: Sequence[Check], columns: Sequence[str]) -> str:
    """Names a list of checks on a table's columns: stored states under another name do not add up with
    these, because a check was changed or its column came or went."""
    text = "\n".join(f"{c.kind}|{c.column}|{c.rule()}|{c.violation_expr}|{c.column in columns}" for c in checks)
    return hashlib.sha256(text.encode()).hexdigest()


def _state_columns(columns: Sequence[str], checks: Sequence[Check]) -> tuple[list[Column], Column]:
    aggs, entries = [F.count(F.lit(1)).alias(ROWS)], []
    for i, check in enumerate(checks):
        unexpected = F.lit(None).cast("long")
        if check.kind == RULE or check.column in columns:
            aggs.append(F.count_if(check.violation()).alias(f"_u{i}"))
            unexpected = F.col(f"_u{i}")
        entries.append(F.struct(F.lit(i).alias(CHECK), unexpected.alias(UNEXPECTED), F.col(ROWS).alias(ROWS)))
    return aggs, F.inline(F.array(*entries))


def partition_states(df: DataFrame, checks: Sequence[Check], by: str | Sequence[str]) -> DataFrame:
    """One row per value of ``by`` and check: ``by``, ``_check``, ``_unexpected``, ``_rows``.

    The counts are made per task before the shuffle, which carries one row per task and partition value.
    """
    if not checks:
        raise ValueError("no check to run")
    cols = as_list(by)
    require_columns(df, cols, "partition column")
    aggs, entries = _state_columns(df.columns, checks)
    return df.groupBy(*cols).agg(*aggs).select(*cols, entries)


def merge_states(states: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Adds the states of each check up, per value of ``by`` or over all."""
    return states.groupBy(*as_list(by), CHECK).agg(F.sum(UNEXPECTED).alias(UNEXPECTED), F.sum(ROWS).alias(ROWS))


def state_results(states: DataFrame, checks: Sequence[Check], table_name: str, columns: Sequence[str]) -> DataFrame:
    """Result rows of the whole table (as ``run_checks``); without any state, those of an empty table.

    ``columns`` are the table's own: they decide which checks are skipped.
    """
    if not checks:
        raise ValueError("no check to run")
    total = F.coalesce(F.max("_n"), F.lit(0))
    aggs = [total.alias("_total")]
    rows = []
    for i, check in enumerate(checks):
        u = F.lit(None).cast("long")
        success = F.lit(None).cast("boolean")
        if check.kind == RULE or check.column in columns:
            aggs.append(F.coalesce(F.sum(F.when(F.col(CHECK) == i, F.col(UNEXPECTED))), F.lit(0)).alias(f"_u{i}"))
            u = F.col(f"_u{i}")
            success = check.success(u, F.col("_total"))
        rows.append(result_row(table_name, check, u, F.col("_total"), success))
    merged = merge_states(states).withColumn("_n", F.col(ROWS))
    return merged.agg(*aggs).select(F.inline(F.array(*rows)))
