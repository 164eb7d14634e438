"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so a hub with most of the edges is pre-aggregated per
task and its join partition can be split by adaptive execution.  Each round's edges are written to
the shared scratch folder, which cuts the lineage; the number of rounds grows with the logarithm of
the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrix.session import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge: the smallest node it can reach.

    Loops, repeated edges and null ends are ignored; without edges the result is empty.
    """
    ends = edges.where(F.col(a) != F.col(b))
    current = scratch.stage(
        ends.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    mark = _fingerprint(current)
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.stage(both.groupBy("u").agg(F.min("v").alias("m")), "large-least")
        # only neighbours above u move, so u's own minimum is min(u, m)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = scratch.stage(large, "large")
        below = scratch.stage(large.groupBy("u").agg(F.min("v").alias("m")), "small-least")
        moved = large.join(below, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = scratch.stage(moved.unionByName(below.select("u", F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(current, least, large, below)
        current, before, mark = new, mark, _fingerprint(new)
        if mark == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
