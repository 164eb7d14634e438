"""A fixed-size key filter: drop rows that surely have no partner before a join shuffles them.

The filter is 2^``BITS`` bits, kept as rows (word number, 64 bits) and therefore at most 2^(BITS-6)
rows to broadcast, whatever the number of keys; more keys only let more rows through.  An exact join
always follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.llm.names import free

BITS = 25


def _place(key: Column) -> tuple[Column, Column]:
    """(word number, bit in the word) of a key."""
    h = F.xxhash64(key, F.lit(41))
    return F.shiftrightunsigned(h, 64 - BITS + 6).cast("int"), F.pmod(h, F.lit(64)).cast("int")


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def key_filter(keys: DataFrame, column: str) -> DataFrame:
    """The filter's words over a column of keys."""
    word, at = _place(F.col(column))
    return keys.select(word.alias("__word"), _bit(at).alias("__bits")).groupBy("__word").agg(
        F.bit_or("__bits").alias("__bits")
    )


def may_match(rows: DataFrame, key: Column, words: DataFrame, out: str = "__may") -> DataFrame:
    """``rows`` with a boolean column: false only where the key is surely not in the filter."""
    word, at = _place(key)
    place, bit, bits = free("place", rows), free("bit", rows), free("bits", rows)
    # flat columns: as structs the broadcast rows were nearly twice as large
    listed = words.select(F.col("__word").alias(place), F.col("__bits").alias(bits))
    marked = rows.withColumn(place, word).withColumn(bit, _bit(at)).join(F.broadcast(listed), place, "left")
    hit = F.coalesce(F.col(bits).bitwiseAND(F.col(bit)) != 0, F.lit(False))
    return marked.withColumn(out, hit).drop(place, bit, bits)
