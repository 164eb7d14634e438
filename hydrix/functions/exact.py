"""Sums and means of floating numbers that do not depend on the order of the rows.

A floating sum depends on how rows meet in partial sums.  Here every number is cut into whole parts of
``LIMB`` bits at fixed places, the parts of each place are summed as integers, and the integers are put
together once per group.  Integer sums are exact, so any partitioning, retry or merge order gives the same
bits, and the sums of two batches add up to the sums of both: the parts are a mergeable state.

A FLOAT spans 12 places, a DOUBLE 88; an integer column is one plain sum.  A place holds
2^(63 - LIMB) rows before the long sum overflows, which ANSI mode reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType

#: Bits of a part: 2^39 rows of one group fit a long sum.
LIMB = 24

# The exponent of the lowest bit and the one past the highest, of FLOAT and DOUBLE.
_RANGE = {"float": (-149, 128), "double": (-1074, 1024)}


def kind_of(dtype: DataType) -> str:
    """``long``, ``float`` or ``double``."""
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return "long"
    if isinstance(dtype, FloatType):
        return "float"
    if isinstance(dtype, DoubleType):
        return "double"
    raise ValueError(f"no exact sum for {dtype.simpleString()}")


def places(kind: str) -> int:
    """Number of parts of a state."""
    if kind == "long":
        return 1
    low, high = _RANGE[kind]
    return -(-(high - low) // LIMB)


def state_sums(c: Column, kind: str) -> list[Column]:
    """Aggregates of a state: one integer sum a place, the counts of NaN, +inf and -inf, and of all numbers.

    NULLs are skipped.  Every part is an integer, so states can be added and subtracted.
    """
    if kind == "long":
        return [F.sum(c.cast("decimal(38,0)")), F.count(c)]
    low, high = _RANGE[kind]
    x = c.cast("double")
    finite = F.abs(x) < F.lit(float("inf"))  # NaN is greater than all numbers in Spark
    x0 = F.when(finite, x)
    sums = []
    for i in range(places(kind)):
        top = low + LIMB * (i + 1)
        # both steps are exact: a remainder keeps the lower bits, a division by a power of two shifts
        rest = x0 % F.lit(2.0**top) if top < high else x0
        part = rest / F.lit(2.0 ** (low + LIMB * i))
        sums.append(F.coalesce(F.sum(part.cast("long")), F.lit(0).cast("long")))
    return [*sums, F.count_if(F.isnan(x)), F.count_if(x == float("inf")), F.count_if(x == float("-inf")), F.count(c)]


def state_names(prefix: str, kind: str) -> list[str]:
    """Column names of a state, in the order of ``state_sums``."""
    if kind == "long":
        return [f"{prefix}_sum", f"{prefix}_n"]
    return [*(f"{prefix}_p{i}" for i in range(places(kind))), *(f"{prefix}_{s}" for s in ("nan", "inf", "minus_inf", "n"))]


def state_columns(c: Column, prefix: str, kind: str) -> list[Column]:
    return [s.alias(n) for s, n in zip(state_sums(c, kind), state_names(prefix, kind))]


def merged_columns(prefix: str, kind: str, sign: Column | None = None) -> list[Column]:
    """Aggregates that add stored states up, under the same names; ``sign`` (1 or -1) takes states away."""
    weight = F.lit(1) if sign is None else sign

    def total(name: str) -> Column:
        c = F.coalesce(F.col(name), F.lit(0).cast("long")) * weight
        return F.sum(c).cast("decimal(38,0)" if name.endswith("_sum") else "long")

    return [total(n).alias(n) for n in state_names(prefix, kind)]


def _magnitude(parts: Sequence[Column], low: int) -> tuple[Column, Column]:
    """(total of the parts, what the highest place carries out) after carrying upward; the total is right
    where the carry is not negative."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.lit(0.0).alias("total"), F.lit(0).alias("i"))

    def step(acc: Column, part: Column) -> Column:
        value = part + acc["carry"]
        digit = F.pmod(value, F.lit(1 << LIMB))
        weight = F.element_at(weights, acc["i"] + 1)
        return F.struct(
            F.shiftright(value, LIMB).alias("carry"), (acc["total"] + digit.cast("double") * weight).alias("total"),
            (acc["i"] + 1).alias("i"),
        )

    weights = F.array(*(F.lit(2.0 ** (low + LIMB * i)) for i in range(len(parts))))
    out = F.aggregate(F.array(*parts), start, step)
    return out["total"], out["carry"]


def total_of(prefix: str, kind: str) -> Column:
    """The sum as DOUBLE, from a state's columns; NULL without any value."""
    n = F.col(f"{prefix}_n")
    if kind == "long":
        return F.when(n > 0, F.col(f"{prefix}_sum").cast("double"))
    low, high_of_double = _RANGE[kind][0], _RANGE["double"][1]
    parts = [F.col(f"{prefix}_p{i}") for i in range(places(kind))]
    up, carry = _magnitude(parts, low)
    down, back = _magnitude([-p for p in parts], low)
    # the sign is the highest carry's; what the highest place carries out has the weight of one more place
    above = low + LIMB * len(parts)
    over = F.lit(2.0**above if above < high_of_double else float("inf"))
    beyond = lambda k: F.when(k > 0, k.cast("double") * over).otherwise(F.lit(0.0))
    finite = F.when(carry < 0, -(down + beyond(back))).otherwise(up + beyond(carry))
    up_to, down_to = F.col(f"{prefix}_inf") > 0, F.col(f"{prefix}_minus_inf") > 0
    special = F.when((F.col(f"{prefix}_nan") > 0) | (up_to & down_to), float("nan")).when(up_to, float("inf")).when(
        down_to, float("-inf")
    )
    return F.when(n > 0, F.coalesce(special, finite))


def mean_of(prefix: str, kind: str) -> Column:
    """The mean as DOUBLE, from a state's columns; NULL without any value."""
    return total_of(prefix, kind) / F.when(F.col(f"{prefix}_n") > 0, F.col(f"{prefix}_n").cast("double"))
