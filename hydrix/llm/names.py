"""Helper column names that the caller's table does not use."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free(name: str, *tables: DataFrame) -> str:
    """``name``, with underscores added until no table has a column of that name (Spark ignores case)."""
    used = {c.lower() for t in tables for c in t.columns}
    while name.lower() in used:
        name += "_"
    return name
