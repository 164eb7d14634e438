"""Bounded previews (S10, S11): first rows and schema text, returned rather than printed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix._util import require_columns


def preview_rows(
    df: DataFrame,
    n: int = 10,
    cols: Sequence[str] | None = None,
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """First ``n`` rows of ``cols``.  With ``order_by`` the rows are reproducible (top-n per task,
    then one merge of ``n x tasks`` rows); without it any ``n`` rows are returned."""
    if n <= 0:
        raise ValueError(f"n must be positive, got {n}")
    if cols is not None:
        require_columns(df, list(cols))
        df = df.select(*cols)
    if order_by:
        df = df.orderBy(*[F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by])
    return df.limit(n)


def schema_text(df: DataFrame) -> str:
    """The ``printSchema`` tree as a string."""
    return df.schema.treeString()
