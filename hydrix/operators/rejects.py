"""Rows that a job does not take, with the reasons: a rejects table beside the kept rows.

A ``RejectRule`` names a defect and says whether a row with it is rejected or only marked.  One pass gives
every row its reason codes; ``write_split`` writes kept and rejected rows in the same job, and counts every
rule with metrics observed in that job.  The job has no shuffle: its tasks write what they read, so a
retried task or a lost executor changes neither the tables nor the counts (Spark takes the metrics of a
result task once).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from hydrix.sources.files import guard_not_input

REASONS = "reject_reasons"
SPLIT = "_split"
KEPT, REJECTED = "kept", "rejected"


@dataclass(frozen=True)
class RejectRule:
    """``code`` marks rows where ``violation`` is TRUE; with ``drops`` such rows are rejected."""

    code: str
    violation: Column
    drops: bool = True

    def hit(self) -> Column:
        return F.coalesce(self.violation, F.lit(False))


def reject_reasons(rules: Sequence[RejectRule]) -> Column:
    """Codes of all rules that a row breaks, in the order of the rules."""
    if not rules:
        return F.array().cast("array<string>")
    return F.filter(F.array(*(F.when(r.hit(), F.lit(r.code)) for r in rules)), lambda c: c.isNotNull())


def is_rejected(rules: Sequence[RejectRule]) -> Column:
    found = F.lit(False)
    for r in rules:
        if r.drops:
            found = found | r.hit()
    return found


def split_rejects(df: DataFrame, rules: Sequence[RejectRule]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejected rows with their ``reject_reasons``); together they are all rows of ``df``."""
    if REASONS in df.columns:
        raise ValueError(f"the table already has a column {REASONS!r}")
    kept = df.filter(~is_rejected(rules))
    return kept, df.filter(is_rejected(rules)).withColumn(REASONS, reject_reasons(rules))


def observed(df: DataFrame, metrics: Mapping[str, Column], action) -> dict:
    """Runs ``action`` on ``df`` and returns the metrics of exactly the rows that it handled.

    Use it where no shuffle lies between ``df`` and the action's output.
    """
    watch = Observation()
    action(df.observe(watch, *(c.alias(n) for n, c in metrics.items())))
    found = watch.get
    # an input that Spark knows to be empty is planned away, the metrics with it
    return dict(found) if found else df.agg(*(c.alias(n) for n, c in metrics.items())).first().asDict()


def rule_counts(rules: Sequence[RejectRule]) -> dict[str, Column]:
    counts = {"rows_in": F.count(F.lit(1)), "rows_rejected": F.count_if(is_rejected(rules))}
    return counts | {f"n_{r.code}": F.count_if(r.hit()) for r in rules}


@dataclass
class Split:
    """Kept and rejected rows as written, and the counts of the job that wrote them."""

    kept: DataFrame
    rejects: DataFrame
    counts: dict


def write_split(
    df: DataFrame,
    path: str,
    rules: Sequence[RejectRule],
    *,
    metrics: Mapping[str, Column] | None = None,
    within: Column | None = None,
    copy_kept: bool = True,
) -> Split:
    """Writes ``df`` in one job under ``path``, kept and rejected rows in folders of their own.

    ``counts``: rows_in, rows_rejected, n_<code> of every rule, and the caller's ``metrics``, over all rows.
    ``within`` leaves out the rows where it is FALSE (a period that is not asked for); they are in rows_in
    and counted as rows_outside: kept + rejected + outside = in.  With ``copy_kept=False``, for input that
    is cheap to read again, only the rejects are written and ``kept`` is a filter over ``df``.
    """
    if {REASONS, SPLIT} & set(df.columns):
        raise ValueError(f"the table already has a column {REASONS!r} or {SPLIT!r}")
    guard_not_input(df, path)
    bad = is_rejected(rules)
    inside = F.lit(True) if within is None else F.coalesce(within, F.lit(True)) | bad
    counts = rule_counts(rules) | {"rows_outside": F.count_if(~inside)} | dict(metrics or {})

    def write(watched: DataFrame) -> None:
        rows = watched.filter(inside if copy_kept else bad)
        part = F.when(bad, REJECTED).otherwise(KEPT)
        rows = rows.withColumns({REASONS: reject_reasons(rules), SPLIT: part})
        rows.write.mode("overwrite").partitionBy(SPLIT).parquet(path)

    found = observed(df, counts, write)
    schema = df.withColumn(REASONS, F.lit(None).cast("array<string>")).withColumn(SPLIT, F.lit("")).schema
    written = df.sparkSession.read.schema(schema).parquet(path)  # a folder without rows is not there
    rejects = written.filter(F.col(SPLIT) == REJECTED).drop(SPLIT)
    kept = written.filter(F.col(SPLIT) == KEPT).drop(SPLIT, REASONS) if copy_kept else df.filter(~bad & inside)
    return Split(kept, rejects, found)
