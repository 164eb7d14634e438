"""One-pass table profiling: row count, null profile, numeric description, extremes.

Each function is a single global aggregate (partial per task, one small final merge) followed by an
``inline`` that turns the one wide result row into one row per column.  Profiling N columns costs
one scan, not the 2N jobs of a per-column loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix._util import as_list, require_columns
from hydrix.functions.arith import percentage
from hydrix.functions.exact import kind_of, mean_of, state_columns
from hydrix.operators.columns import numeric_columns


def _r(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def _require_numeric(df: DataFrame, cols: Sequence[str]) -> None:
    numeric = set(numeric_columns(df))
    bad = [c for c in cols if c not in numeric]
    if bad:
        raise ValueError(f"not numeric: {bad}")


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def numeric_extremes(df: DataFrame, col: str, *, digits: int | None = None, exact: bool = False) -> DataFrame:
    """One row: ``min``, ``max``, ``avg`` of ``col`` (NULLs skipped).

    ``exact`` gives a mean whose bits do not depend on the partitioning (``functions.exact``)."""
    require_columns(df, [col])
    _require_numeric(df, [col])
    c = F.col(col)
    if exact:
        kind = kind_of(df.schema[col].dataType)
        sums = df.agg(F.min(c).cast("double").alias("_lo"), F.max(c).cast("double").alias("_hi"), *state_columns(c, "_x", kind))
        return sums.select(_r(F.col("_lo"), digits).alias("min"), _r(F.col("_hi"), digits).alias("max"), _r(mean_of("_x", kind), digits).alias("avg"))
    return df.agg(
        _r(F.min(c).cast("double"), digits).alias("min"),
        _r(F.max(c).cast("double"), digits).alias("max"),
        _r(F.avg(c), digits).alias("avg"),
    )


def describe_numeric(
    df: DataFrame, cols: Sequence[str] | None = None, *, digits: int | None = None, exact: bool = False
) -> DataFrame:
    """Long form ``(column_name, n, mean, stddev, min, max)``, one row per numeric column.

    ``cols`` defaults to every numeric column.  ``n`` counts non-NULL values; ``stddev`` is the
    sample standard deviation (NULL for fewer than two values).  ``exact`` gives means whose bits do not
    depend on the partitioning (``functions.exact``); the deviation stays a floating sum.
    """
    cols = numeric_columns(df) if cols is None else as_list(cols)
    require_columns(df, cols)
    if not cols:
        raise ValueError("no numeric column to describe")
    _require_numeric(df, cols)
    aggs, rows = [], []
    for i, name in enumerate(cols):
        c = F.col(name).cast("double")
        kind = kind_of(df.schema[name].dataType) if exact else None
        aggs += state_columns(F.col(name), f"m{i}", kind) if exact else [_r(F.avg(c), digits).alias(f"m{i}")]
        aggs += [
            F.count(c).alias(f"n{i}"),
            _r(F.stddev_samp(c), digits).alias(f"s{i}"),
            F.min(c).alias(f"lo{i}"),
            F.max(c).alias(f"hi{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"n{i}").alias("n"),
                (_r(mean_of(f"m{i}", kind), digits) if exact else F.col(f"m{i}")).alias("mean"),
                F.col(f"s{i}").alias("stddev"),
                F.col(f"lo{i}").alias("min"),
                F.col(f"hi{i}").alias("max"),
            )
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, *, digits: int = 2) -> DataFrame:
    """Long form ``(column_name, null_count, null_pct)``; pct is NULL for an empty table."""
    cols = list(df.columns) if cols is None else as_list(cols)
    require_columns(df, cols)
    if not cols:
        raise ValueError("no column to profile")
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"z{i}") for i, c in enumerate(cols)]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"z{i}").alias("null_count"),
            percentage(F.col(f"z{i}"), F.col("_total"), digits).alias("null_pct"),
        )
        for i, c in enumerate(cols)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
