"""Ratios, percentages and flags used by the aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydrix._util import as_col


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as DOUBLE; a zero or NULL denominator gives NULL instead of an ANSI error."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def percentage(part: Column | str, total: Column | str, digits: int = 2) -> Column:
    """``round(part * 100 / total, digits)``; NULL for an empty total."""
    return F.round(F.try_divide(as_col(part).cast("double") * F.lit(100.0), as_col(total).cast("double")), digits)


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN TRUE END: TRUE or NULL, so ``count`` sees only the matching rows."""
    return F.when(cond, F.lit(True))


def count_true(cond: Column) -> Column:
    """Number of rows where ``cond`` is TRUE; FALSE and NULL count in neither branch."""
    return F.count(flag(cond))
