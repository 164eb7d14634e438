"""Join of rows to a table with one row per key, where a few keys may hold most of the rows.

A key that holds more than 1 / ``MOST`` of all rows is heavy; there are fewer than ``MOST`` of them whatever
the data, so their table is broadcast.  All other keys are joined by a shuffle in which no key is more
than 1 / ``MOST`` of the rows; the rows of heavy keys are spread over it evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.llm.names import free

MOST = 4096


def join_by_key(rows: DataFrame, table: DataFrame, keys: list[str], count: Column, total: int, spread: Column) -> DataFrame:
    """``rows`` left-joined (nulls equal) to ``table``; the result's new columns are the others of ``table``.

    ``count`` is a column of ``table``: the rows of ``rows`` that hold its key.  ``total`` is the number of
    rows, ``spread`` any column of ``rows`` with many values.  Rows without a partner get nulls.
    """
    values = [c for c in table.columns if c not in keys]
    salt, found = free("salt", rows, table), free("found", rows, table)
    value = F.struct(*(F.col(f"`{c}`") for c in values))
    is_heavy = count * F.lit(MOST) > F.lit(total)

    def side(part: DataFrame, name: str) -> DataFrame:
        return part.select(*(F.col(f"`{k}`").alias(f"{name}_{i}") for i, k in enumerate(keys)), value.alias(name))

    heavy, light = free("heavy", rows, table), free("light", rows, table)
    marked = rows.join(
        F.broadcast(side(table.where(is_heavy), heavy)), _same(rows, keys, heavy), "left"
    ).withColumn(salt, F.when(F.col(heavy).isNull(), 0).otherwise(F.pmod(F.xxhash64(spread), F.lit(MOST)) + 1).cast("int"))
    rest = side(table.where(~is_heavy), light).withColumn(f"{light}_salt", F.lit(0))
    joined = marked.join(rest, _same(rows, keys, light) & (F.col(salt) == F.col(f"{light}_salt")), "left")
    both = joined.withColumn(found, F.coalesce(heavy, light))
    return both.select(*(F.col(f"`{c}`") for c in rows.columns), *(F.col(f"{found}.`{c}`").alias(c) for c in values))


def _same(rows: DataFrame, keys: list[str], name: str) -> Column:
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"{name}_{i}"))
    return same
