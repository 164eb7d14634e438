"""Small shared helpers (argument checks, column coercion)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_list(cols: str | Iterable[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def require_columns(df: DataFrame, cols: Sequence[str], what: str = "column") -> None:
    """Raise ValueError naming every column of ``cols`` that ``df`` lacks."""
    present = set(df.columns)
    missing = [c for c in cols if c not in present]
    if missing:
        raise ValueError(f"missing {what}(s) {missing}; available: {df.columns}")


def require_nonempty(cols: Sequence[str], what: str) -> None:
    if not cols:
        raise ValueError(f"{what} must name at least one column")
