"""Raw-table profile (L5) in two passes over the input.

Output, long form: ``section, column_name, item, value`` (value as DOUBLE)

==============  ==========  =========================  ====================================
section         column      item                       value
==============  ==========  =========================  ====================================
rows            ``*``       count                      row count
describe        numeric     n, mean, stddev, min, max  statistics of each numeric column
nulls           every       null_count, null_pct       NULLs and their share in percent
extremes        result      min, max, avg              extremes of the numeric result column
distribution    selected    the value (text)           rows per value (NULL is a value)
==============  ==========  =========================  ====================================

Pass 1 is one global aggregate (every row/describe/null/extreme figure at once).  Pass 2 emits one
``(column, value)`` pair per profiled column per row and counts them with a partial+final
aggregate, so the shuffle carries distinct values only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix._util import require_columns
from hydrix.functions.arith import percentage
from hydrix.operators.columns import numeric_columns

# The columns the source exploration profiles.
DISTRIBUTION_COLS = ("nom_departement", "code_type_parametre", "conclusion_conformite_prelevement")
EXTREMES_COL = "resultat_numerique"


def _entry(section: str, column: str, item: str, value: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"),
        F.lit(column).alias("column_name"),
        F.lit(item).alias("item"),
        value.cast("double").alias("value"),
    )


def _r(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def profile_summary(
    df: DataFrame, extremes_col: str | None = EXTREMES_COL, digits: int | None = 6
) -> DataFrame:
    """Pass 1: rows, describe, nulls and extremes from a single aggregate."""
    cols = list(df.columns)
    numeric = numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("_n")]
    entries = [_entry("rows", "*", "count", F.col("_n"))]
    for i, c in enumerate(numeric):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"_dn{i}"),
            _r(F.avg(x), digits).alias(f"_dm{i}"),
            _r(F.stddev_samp(x), digits).alias(f"_ds{i}"),
            F.min(x).alias(f"_dl{i}"),
            F.max(x).alias(f"_dh{i}"),
        ]
        for item, name in (("n", "_dn"), ("mean", "_dm"), ("stddev", "_ds"), ("min", "_dl"), ("max", "_dh")):
            entries.append(_entry("describe", c, item, F.col(f"{name}{i}")))
    for i, c in enumerate(cols):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_z{i}"))
        entries.append(_entry("nulls", c, "null_count", F.col(f"_z{i}")))
        entries.append(_entry("nulls", c, "null_pct", percentage(F.col(f"_z{i}"), F.col("_n"), 2)))
    if extremes_col is not None:
        require_columns(df, [extremes_col])
        x = F.col(extremes_col)
        aggs += [
            F.min(x).cast("double").alias("_xmin"),
            F.max(x).cast("double").alias("_xmax"),
            _r(F.avg(x), digits).alias("_xavg"),
        ]
        entries += [
            _entry("extremes", extremes_col, "min", F.col("_xmin")),
            _entry("extremes", extremes_col, "max", F.col("_xmax")),
            _entry("extremes", extremes_col, "avg", F.col("_xavg")),
        ]
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def distributions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pass 2: rows per value for each column of ``cols`` (values compared as text)."""
    cols = list(cols)
    require_columns(df, cols)
    if not cols:
        raise ValueError("no column to count")
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("item")) for c in cols]
    )
    return (
        df.select(F.inline(pairs))
        .groupBy("column_name", "item")
        .agg(F.count(F.lit(1)).cast("double").alias("value"))
        .select(F.lit("distribution").alias("section"), "column_name", "item", "value")
    )


def raw_profile(
    df: DataFrame,
    distribution_cols: Sequence[str] = DISTRIBUTION_COLS,
    extremes_col: str | None = EXTREMES_COL,
    digits: int | None = 6,
) -> DataFrame:
    out = profile_summary(df, extremes_col, digits)
    if distribution_cols:
        out = out.unionByName(distributions(df, distribution_cols))
    return out
