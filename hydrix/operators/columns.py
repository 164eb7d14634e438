"""Column-level transforms: renames, required fields, parse failures, type selection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from hydrix._util import as_col, as_list, require_columns, require_nonempty
from hydrix.functions import dates as _dates


def standardize_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename columns in place (order kept).  Every source column must exist; targets must not clash."""
    require_columns(df, list(renames), "column to rename")
    kept = [c for c in df.columns if c not in renames]
    clash = sorted(set(kept) & set(renames.values()))
    if clash:
        raise ValueError(f"rename targets already exist: {clash}")
    return df.withColumnsRenamed(dict(renames))


def not_null_all(cols: Iterable[str]) -> Column:
    """AND of ``IS NOT NULL`` over ``cols``."""
    cols = as_list(cols)
    require_nonempty(cols, "required fields")
    cond = None
    for c in cols:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return cond


def require_fields(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep rows where every column of ``cols`` is non-NULL.

    Unlike ``dropna`` this does not drop NaN in float columns.  The predicate is pushed to the
    Parquet scan as ``IsNotNull`` filters.
    """
    cols = as_list(cols)
    require_columns(df, cols)
    return df.filter(not_null_all(cols))


def parse_failure(raw: Column | str, parsed: Column | str) -> Column:
    """Raw value present but parsed value NULL."""
    return as_col(raw).isNotNull() & as_col(parsed).isNull()


def parse_failures(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    """Rows whose raw text is present but did not parse."""
    require_columns(df, [raw, parsed])
    return df.filter(parse_failure(raw, parsed))


def count_parse_failures(df: DataFrame, raw: str, parsed: str, name: str = "parse_failures") -> DataFrame:
    """One row, one column: number of parse failures (a single aggregate pass)."""
    require_columns(df, [raw, parsed])
    return df.agg(F.count_if(parse_failure(raw, parsed)).alias(name))


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of every top-level column whose type is numeric (int, long, float, double, decimal...)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def date_window(
    df: DataFrame, date_col: str, start, end, *, year_col: str | None = None
) -> DataFrame:
    """Rows whose ``date_col`` lies in [start, end] (inclusive; NULL dates excluded).

    When the table also carries a year column (``year_col``, e.g. a ``partitionBy`` column), the
    redundant year predicate is added so Parquet partition pruning / row-group skipping applies.
    """
    require_columns(df, [date_col] + ([year_col] if year_col else []))
    lo, hi = _dates._as_date(start), _dates._as_date(end)
    cond = _dates.in_window(date_col, lo, hi)
    if year_col:
        cond = F.col(year_col).between(lo.year, hi.year) & cond
    return df.filter(cond)
