"""Full-table data-quality checks returned as DataFrames.

A check is a rule on one column.  ``run_checks`` evaluates any number of checks on one table in a
single aggregate pass (one ``count_if`` per check, partial per task), then unpivots the single result
row into one row per check:

    table_name, check_name, column_name, rule, unexpected_count, total, success, status

``status`` is ``passed``, ``failed`` or ``skipped`` (column absent: the check is reported, not
silently dropped).  Checks never raise by themselves; ``assert_checks`` turns failures into an
exception when a gate must block.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix._util import as_list

# Check kinds and statuses as they appear in result rows.
NOT_NULL = "not_null"
BETWEEN = "between"
MIN = "min"
MIN_TOLERANCE = "min_tolerance"
RULE = "rule"
SUBSET = "subset_of"
PASSED, FAILED, SKIPPED = "passed", "failed", "skipped"

RESULT_COLUMNS = (
    "table_name", "check_name", "column_name", "rule", "unexpected_count", "total", "success", "status",
)


def _fmt(v: float) -> str:
    return str(int(v)) if float(v).is_integer() else repr(float(v))


@dataclass(frozen=True, eq=False)
class Check:
    """One rule on one column; build with the factory functions below."""

    kind: str
    column: str
    lo: float | None = None
    hi: float | None = None
    strict: bool = False
    max_pct: float | None = None
    violation_expr: Column | None = None
    rule_text: str | None = None

    def violation(self) -> Column:
        """Row predicate: TRUE marks an unexpected row.  NULL values are never unexpected except for not_null."""
        c = F.col(self.column)
        if self.kind == NOT_NULL:
            return c.isNull()
        if self.kind == BETWEEN:
            below = c < F.lit(self.lo) if self.lo is not None else None
            above = c > F.lit(self.hi) if self.hi is not None else None
            if below is None:
                return above
            return below if above is None else (below | above)
        if self.kind in (MIN, MIN_TOLERANCE):
            return c <= F.lit(self.lo) if self.strict else c < F.lit(self.lo)
        if self.kind == RULE:
            return self.violation_expr
        raise ValueError(f"unknown check kind {self.kind!r}")

    def rule(self) -> str:
        if self.rule_text is not None:
            return self.rule_text
        if self.kind == NOT_NULL:
            return "is not null"
        if self.kind == BETWEEN:
            lo = "-inf" if self.lo is None else _fmt(self.lo)
            hi = "+inf" if self.hi is None else _fmt(self.hi)
            return f"between {lo} and {hi}"
        op = ">" if self.strict else ">="
        if self.kind == MIN:
            return f"{op} {_fmt(self.lo)}"
        return f"{op} {_fmt(self.lo)} for all but < {_fmt(self.max_pct)}%"

    def success(self, unexpected: Column, total: Column) -> Column:
        if self.kind == MIN_TOLERANCE:
            # share in percent, computed as (unexpected / total) * 100; an empty table counts as 0 %
            pct = F.coalesce(F.try_divide(unexpected.cast("double"), total.cast("double")) * F.lit(100.0), F.lit(0.0))
            return pct < F.lit(float(self.max_pct))
        return unexpected == F.lit(0)


def not_null(column: str) -> Check:
    return Check(NOT_NULL, column)


def between(column: str, lo: float | None, hi: float | None) -> Check:
    """Values outside [lo, hi] are unexpected; NULL passes."""
    if lo is None and hi is None:
        raise ValueError("between needs lo or hi")
    if lo is not None and hi is not None and lo > hi:
        raise ValueError(f"empty range [{lo}, {hi}]")
    return Check(BETWEEN, column, lo=lo, hi=hi)


def at_least(column: str, bound: float) -> Check:
    """``column >= bound``; values below are unexpected, NULL passes."""
    return Check(MIN, column, lo=bound)


def greater_than(column: str, bound: float) -> Check:
    """``column > bound``; values at or below are unexpected, NULL passes."""
    return Check(MIN, column, lo=bound, strict=True)


def at_least_mostly(column: str, bound: float, max_pct: float = 5.0) -> Check:
    """``column >= bound`` for all but fewer than ``max_pct`` percent of the rows (strict)."""
    if not 0 <= max_pct <= 100:
        raise ValueError(f"max_pct must be within [0, 100], got {max_pct}")
    return Check(MIN_TOLERANCE, column, lo=bound, max_pct=max_pct)


def expect(name_column: str, violation: Column, rule: str) -> Check:
    """Free-form rule: ``violation`` marks unexpected rows; reported under ``name_column``."""
    return Check(RULE, name_column, violation_expr=violation, rule_text=rule)


def result_row(table: str, check: Check, unexpected: Column, total: Column, success: Column) -> Column:
    status = F.when(success.isNull(), F.lit(SKIPPED)).when(success, F.lit(PASSED)).otherwise(F.lit(FAILED))
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.rule()).alias("rule"),
        unexpected.cast("long").alias("unexpected_count"),
        total.cast("long").alias("total"),
        success.cast("boolean").alias("success"),
        status.alias("status"),
    )


def run_checks(df: DataFrame, checks: Sequence[Check], table_name: str) -> DataFrame:
    """Evaluate ``checks`` on ``df`` in one aggregate pass; one result row per check."""
    if not checks:
        raise ValueError("no check to run")
    present = set(df.columns)
    aggs = [F.count(F.lit(1)).alias("_total")]
    rows = []
    total = F.col("_total")
    for i, check in enumerate(checks):
        if check.kind == RULE or check.column in present:
            aggs.append(F.count_if(check.violation()).alias(f"_u{i}"))
            u = F.col(f"_u{i}")
            rows.append(result_row(table_name, check, u, total, check.success(u, total)))
        else:
            rows.append(result_row(table_name, check, F.lit(None).cast("long"), total, F.lit(None).cast("boolean")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    """The rows a check counts as unexpected (out of range, below the bound, NULL...), for inspection.

    A filter on the check's row predicate: pushed to the Parquet scan where the predicate allows.
    """
    if check.kind != RULE and check.column not in df.columns:
        raise ValueError(f"column {check.column!r} not in {df.columns}")
    return df.filter(check.violation())


def check_not_null(df: DataFrame, cols: Sequence[str], table_name: str) -> DataFrame:
    return run_checks(df, [not_null(c) for c in as_list(cols)], table_name)


def check_between(df: DataFrame, col: str, lo: float | None, hi: float | None, table_name: str) -> DataFrame:
    return run_checks(df, [between(col, lo, hi)], table_name)


def check_min(df: DataFrame, col: str, bound: float, table_name: str, *, strict: bool = False) -> DataFrame:
    return run_checks(df, [greater_than(col, bound) if strict else at_least(col, bound)], table_name)


def check_min_tolerance(df: DataFrame, col: str, bound: float, table_name: str, max_pct: float = 5.0) -> DataFrame:
    return run_checks(df, [at_least_mostly(col, bound, max_pct)], table_name)


def check_subset(sub: DataFrame, sup: DataFrame, keys: Sequence[str], table_name: str) -> DataFrame:
    """Distinct ``keys`` combinations of ``sub`` that are absent from ``sup`` (NULL matches NULL).

    ``sup`` LEFT SEMI JOIN ``sub``; the join strategy is left to Spark's and AQE's statistics, which
    broadcast ``sub`` where it is small.  The matched keys are made distinct
    (they are bounded by ``sub``), so repeated keys in ``sup`` are not counted twice.
    """
    keys = as_list(keys)
    sub_keys = sub.select(*keys).distinct()
    cond = [sup[k].eqNullSafe(sub_keys[k]) for k in keys]
    found = sup.join(sub_keys, on=cond, how="left_semi").select(*keys).distinct()
    marked = sub_keys.select(F.lit(1).alias("_in_sub"), F.lit(0).alias("_found")).unionByName(
        found.select(F.lit(0).alias("_in_sub"), F.lit(1).alias("_found"))
    )
    total = F.coalesce(F.sum("_in_sub"), F.lit(0))
    unexpected = total - F.coalesce(F.sum("_found"), F.lit(0))
    check = Check(SUBSET, ",".join(keys), rule_text="keys present in parent table")
    return marked.agg(F.inline(F.array(result_row(table_name, check, unexpected, total, unexpected == 0))))


def counts_within_total(total: str = "total_tests", ok: str = "nb_conformes", ko: str = "nb_non_conformes") -> Check:
    """Rule: the conforming and non-conforming counts never exceed the group's row count."""
    return expect(f"{ok}+{ko}", (F.col(ok) + F.col(ko)) > F.col(total), f"{ok} + {ko} <= {total}")


def aggregate_consistency(
    conformity: DataFrame,
    worst: DataFrame | None,
    keys: Sequence[str],
    table_name: str,
    *,
    total: str = "total_tests",
    ok: str = "nb_conformes",
    ko: str = "nb_non_conformes",
) -> DataFrame:
    """Q10: ``ok + ko <= total`` on every group, and every worst-k row is a group of the table."""
    out = run_checks(conformity, [counts_within_total(total, ok, ko)], table_name)
    if worst is not None:
        out = out.unionByName(check_subset(worst, conformity, keys, table_name))
    return out


def suite_summary(results: DataFrame) -> DataFrame:
    """One row over check results: counts per status, ``all_passed`` and the failed checks, sorted.

    Skipped checks count in ``n_skipped`` only; ``all_passed`` is TRUE when no evaluated check failed.
    """
    s = F.col("success")
    label = F.concat_ws(":", "table_name", "check_name", "column_name")
    return results.agg(
        F.count(F.lit(1)).alias("n_rules"),
        F.count_if(s.isNotNull()).alias("n_checks"),
        F.count_if(s).alias("n_passed"),
        F.count_if(~s).alias("n_failed"),
        F.count_if(s.isNull()).alias("n_skipped"),
        (F.count_if(~s) == 0).alias("all_passed"),
        F.array_join(F.array_sort(F.collect_list(F.when(~s, label))), ",").alias("failed"),
    )


MARKS = {PASSED: "PASS", FAILED: "FAIL", SKIPPED: "SKIP"}


def render_report(rows: Sequence) -> str:
    """Text report of collected check rows: a mark and a title per check, a detail line when it
    did not pass (the console output of a gate)."""
    lines = []
    for r in rows:
        title = r["rule"] if r["check_name"] == RULE else f"{r['column_name']} {r['rule']}"
        lines.append(f"{MARKS.get(r['status'], '?')} {r['table_name']}.{title}")
        if r["status"] == FAILED:
            lines.append(f"    {r['unexpected_count']} of {r['total']} rows unexpected")
        elif r["status"] == SKIPPED:
            lines.append("    column absent")
    return "\n".join(lines)


class CheckFailed(AssertionError):
    """Raised by ``assert_checks`` when at least one evaluated check failed."""


def assert_checks(results: DataFrame, on_failure: str = "raise") -> list:
    """Collect the (small, one row per check) results; raise on failure when ``on_failure='raise'``."""
    if on_failure not in ("raise", "report"):
        raise ValueError(f"on_failure must be 'raise' or 'report', got {on_failure!r}")
    rows = results.collect()
    failed = [r for r in rows if r["success"] is False]
    if failed and on_failure == "raise":
        detail = "; ".join(
            f"{r['table_name']}.{r['column_name']} {r['rule']}: {r['unexpected_count']} of {r['total']}" for r in failed
        )
        raise CheckFailed(f"{len(failed)} check(s) failed: {detail}")
    return rows
