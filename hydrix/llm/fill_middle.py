"""Fill-in-the-middle transformation with an indexable skip list over a text's units.

A text is a list of units (lines, by default).  Two seeded ranks between units cut it into prefix, middle
and suffix, which are written in another order behind sentinels.  Where a rank lies in the text is read
from an indexable skip list: lane 0 links all units, each express lane links about one in ``FANOUT`` nodes
of the lane below, and every link carries its *unit width* (units it jumps) and its *code-point width*
(code points of those units).  A search starts at the head of the top lane, follows links while the
accumulated unit width stays within the rank, and goes down; at the foot the unit widths add up to exactly
the rank and the code-point widths to the cut.  Both cuts take a search of expected logarithmic length.

The list is built and searched for one text at a time inside Arrow batches and holds two numbers a unit, no
copy of the text; only (units, first cut, second cut) go back to Spark, which assembles the output.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.llm.names import free
from hydrix.llm.words import mix

# Fixed values of the contract: units, sentinels, seed, shares in percent, hexadecimal digits of a number.
LINE = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, MIDDLE_PERCENT, SUFFIX_FIRST_PERCENT = 7, 100, 50
DIGITS = 8

#: A node is in the next lane with a chance of 1 / FANOUT (a power of two).
FANOUT = 4


class SkipList:
    """Static indexable skip list over units of given code-point widths.

    ``lanes[0]`` is the base lane.  A lane is (units, points, below): the widths of the link that leaves
    each node, and the node's place in the lane below.  Node 0 is the head; one past the last node is the
    end.  A node's height comes from a hash of its rank, so equal texts have equal lists.
    """

    def __init__(self, points: list[int]):
        n = len(points)
        self.lanes = [([1] * n, points, None)]
        if n <= FANOUT:
            return
        chance = mix(np.arange(1, n + 1, dtype=np.uint64))
        step = np.uint64(FANOUT.bit_length() - 1)
        rank = np.arange(n)
        units, widths = np.ones(n, np.int64), np.asarray(points, np.int64)
        while len(rank) > FANOUT:
            promoted = chance[rank] % np.uint64(FANOUT) == 0
            promoted[0] = True
            if promoted.all():
                break
            chance >>= step
            at = np.flatnonzero(promoted)
            units, widths = np.add.reduceat(units, at), np.add.reduceat(widths, at)
            self.lanes.append((units.tolist(), widths.tolist(), [*at.tolist(), len(rank)]))
            rank = rank[at]

    def cut(self, rank: int) -> tuple[int, int]:
        """(code points before the unit of that rank, links followed); a rank from 0 to the number of units."""
        at = passed = points = steps = 0
        for units, widths, below in reversed(self.lanes):
            while at < len(units) and passed + units[at] <= rank:
                passed += units[at]
                points += widths[at]
                at += 1
                steps += 1
            if below is not None:
                at = below[at]
        if passed != rank:
            raise ValueError(f"rank {rank} is beyond the {passed} units")
        return points, steps


def unit_widths(text: str, unit: re.Pattern) -> list[int]:
    """Code-point widths of the units; what a pattern leaves between units belongs to the next one."""
    ends = [m.end() for m in unit.finditer(text)]
    return [b - a for a, b in zip([0, *ends], ends)]


def cuts(text: Column, first: Column, second: Column, unit: str = LINE) -> Column:
    """Struct (n: units, low, high: code points before the smaller and the larger cut).

    The ranks are ``first`` and ``second`` modulo n + 1.
    """

    @F.arrow_udf("struct<n:bigint,low:bigint,high:bigint>")
    def apply(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pattern = re.compile(unit)
        for texts, a, b in batches:
            found = np.zeros((3, len(texts)), np.int64)
            for i, (t, x, y) in enumerate(zip(texts, a.to_pylist(), b.to_pylist())):
                units = SkipList(unit_widths(t.as_py() or "", pattern))
                n = len(units.lanes[0][0])
                low, high = sorted((x % (n + 1), y % (n + 1)))
                found[:, i] = n, units.cut(low)[0], units.cut(high)[0]
            yield pa.StructArray.from_arrays([pa.array(f) for f in found], ["n", "low", "high"])

    return apply(text, first, second)


def seeded_number(key: Column, index: int, seed: int = SEED) -> Column:
    """The ``index``-th group of 8 hexadecimal digits of the SHA-256 of ``seed:key``, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, index * DIGITS + 1, DIGITS), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    out: str = "fim",
    unit: str = LINE,
    seed: int = SEED,
    middle_percent: int = MIDDLE_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
) -> DataFrame:
    """``docs`` with the struct column ``out``: n (units), form (plain, psm or spm), output, prefix_chars and
    middle_chars (code points; null if plain).

    A null text counts as empty: no units, plain, an empty output.  A text that holds a sentinel is plain, as
    it could not be told apart afterwards.  A null key takes the draws of an empty one; repeated rows come
    out alike; texts of any length are cut whole.  Every row and column stays, an input column named ``out``
    is replaced; an empty table gives an empty result.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    draw = [seeded_number(F.col(f"`{key}`"), i, seed) for i in range(4)]
    at = free("cuts", docs)
    rows = docs.withColumn(at, cuts(F.col(f"`{text}`"), draw[0], draw[1], unit))
    plain = (body == "") | (draw[2] % 100 >= middle_percent)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(body, F.lit(sentinel))
    form = F.when(plain, "plain").when(draw[3] % 100 < suffix_first_percent, "spm").otherwise("psm")
    low, high = F.col(f"{at}.low").cast("int"), F.col(f"{at}.high").cast("int")
    prefix, middle = F.substring(body, F.lit(1), low), F.substring(body, low + 1, high - low)
    suffix = F.substring(body, high + 1, F.length(body))
    output = F.when(form == "plain", body).when(
        form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)
    ).otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    cut_only = lambda c: F.when(form != "plain", c).cast("long")
    made = F.struct(
        F.col(f"{at}.n").alias("n"), form.alias("form"), output.alias("output"),
        cut_only(low).alias("prefix_chars"), cut_only(high - low).alias("middle_chars"),
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c != out]
    return rows.select(*kept, made.alias(out))


def restore_text(output: Column, form: Column) -> Column:
    """The text that an output was made from, from the output and its form alone."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)  # an empty piece, then the three parts as written
    return F.when(form == "plain", output).when(form == "psm", F.concat(part[1], part[3], part[2])).when(
        form == "spm", F.concat(part[2], part[3], part[1])
    )
