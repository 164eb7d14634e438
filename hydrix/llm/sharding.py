"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized table (an offset and a step
from its name's digest; a step modulo a prime visits every slot).  Shards take turns claiming their
most preferred free slot until the table is full, so each owns floor or ceil of slots/shards, and a
change of the shard list moves few slots.  Placement is one table lookup: digest of the row's key
modulo the table size, then a broadcast join with the slot table, which has ``slots`` rows whatever
the data.  Only DataFrame functions touch the data; the table itself is configuration, computed from
the shard names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrix.llm.names import free

SHARDS = 32
#: Prime; over 100 slots a shard keeps shares within a percent of each other.
SLOTS = 4099
#: The slot table is broadcast; a larger one is refused rather than sent out.
MAX_SLOTS = 1 << 20

# Fixed value: hexadecimal digits of an MD5 that make a non-negative 60-bit number.
DIGITS = 15


def _digest(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Owner (index into ``shards``) of each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct, at least one")
    if not _is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime between the number of shards and {MAX_SLOTS}")
    place = [_digest(f"offset:{s}") % slots for s in shards]
    step = [_digest(f"step:{s}") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            while owner[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % slots
            owner[place[i]] = i
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first digits of its MD5 as a number, modulo the table size."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, DIGITS), 16, 10).cast("long") % F.lit(slots)


def slot_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """The table as rows of one column ``place`` (slot, shard), built from one packed literal."""
    packed = b"".join(i.to_bytes(4, "big") for i in fill_table(shards, slots))
    names = F.array(*(F.lit(s) for s in shards))
    index = F.conv(F.hex(F.substring(F.lit(bytearray(packed)), F.col("id").cast("int") * 4 + 1, F.lit(4))), 16, 10)
    return spark.range(slots).select(
        F.struct(F.col("id").alias("slot"), F.element_at(names, (index.cast("int") + 1)).alias("shard")).alias("place")
    )


def place(
    docs: DataFrame,
    key: str = "doc_id",
    shards: list[str] | int = SHARDS,
    slots: int = SLOTS,
    text: str = "text",
    slot_col: str = "slot",
    shard_col: str = "shard",
) -> DataFrame:
    """``docs`` with each row's table slot and shard name.

    A row with a null key is placed by its text (null text: the empty key), so such rows spread over
    the shards too.  Repeated keys share a shard.  Every row and column stays; input columns named
    ``slot_col`` or ``shard_col`` are replaced.  An empty table gives an empty result.
    """
    names = [f"shard-{i:05d}" for i in range(shards)] if isinstance(shards, int) else list(shards)
    fallback = F.col(f"`{text}`") if text in docs.columns else F.lit(None).cast("string")
    where = slot_of(F.coalesce(F.col(f"`{key}`").cast("string"), fallback, F.lit("")), slots)
    found, owner = free("found", docs), free("owner", docs)
    table = F.broadcast(slot_table(docs.sparkSession, names, slots).withColumnRenamed("place", owner))
    rest = [c for c in docs.columns if c not in (slot_col, shard_col)]
    rows = docs.withColumn(found, where).join(table, F.col(found) == F.col(f"{owner}.slot"), "left")
    return rows.select(
        *(F.col(f"`{c}`") for c in rest), F.col(found).alias(slot_col), F.col(f"{owner}.shard").alias(shard_col)
    )
