"""Key deduplication with a deterministic survivor, and its report.

``dedup_keys`` keeps, per key, the first row in ``order_by`` order.  NULL keys compare equal (one
survivor for all rows whose keys are NULL in the same positions), as with ``dropDuplicates``.

Plan: ``row_number() = 1`` over the key window is planned as a *partial* ``WindowGroupLimit`` before
the hash exchange and a final one after it, so every map task ships at most one row per key.  A key
that holds a third of the data therefore costs one row per map task in the shuffle, not a third of
the table in one reducer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from hydrix._util import as_col, as_list, require_columns, require_nonempty

_RN = "__hydrix_rn"


def _sort_key(c: Column | str) -> Column:
    col = as_col(c)
    # plain names sort ascending with NULLs first; explicit Column orderings are kept as given
    return col.asc_nulls_first() if isinstance(c, str) else col


def orderable_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns whose type has a total order usable as a tie-break (maps and variants excluded)."""
    skip = set(exclude)

    def ok(t) -> bool:
        if isinstance(t, MapType) or type(t).__name__ == "VariantType":
            return False
        if isinstance(t, ArrayType):
            return ok(t.elementType)
        if isinstance(t, StructType):
            return all(ok(f.dataType) for f in t.fields)
        return True

    return [f.name for f in df.schema.fields if f.name not in skip and ok(f.dataType)]


def dedup_keys(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """One row per ``keys``: the first in ``order_by`` order (give a unique tie-break for determinism)."""
    keys = as_list(keys)
    require_nonempty(keys, "dedup keys")
    require_columns(df, keys)
    order = list(order_by) if not isinstance(order_by, (str, Column)) else [order_by]
    if not order:
        raise ValueError("order_by is required: the survivor must not be arbitrary")
    require_columns(df, [c for c in order if isinstance(c, str)], "order_by column")
    w = Window.partitionBy(*keys).orderBy(*[_sort_key(c) for c in order])
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key when any survivor will do (``dropDuplicates``; survivor not reproducible)."""
    keys = as_list(keys)
    require_nonempty(keys, "dedup keys")
    require_columns(df, keys)
    return df.dropDuplicates(keys)


def dedup_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``rows_before``, ``rows_after`` (distinct keys, NULL-equal), ``rows_removed``.

    One pass: partial+final count per key, then a global sum/count over the per-key counts.
    """
    keys = as_list(keys)
    require_nonempty(keys, "dedup keys")
    require_columns(df, keys)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n"), F.lit(0)).cast("long")
    after = F.count(F.lit(1)).cast("long")
    return per_key.agg(before.alias("rows_before"), after.alias("rows_after")).withColumn(
        "rows_removed", F.col("rows_before") - F.col("rows_after")
    )
