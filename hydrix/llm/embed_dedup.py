"""Embedding near-dedup by collision counting over one-dimensional projections.

Unit vectors at cosine c differ on a Gaussian direction by a normal amount of deviation
sqrt(2 (1 - c)), so two vectors at the threshold fall into a window of half-width w around each other
with a known chance, and vectors of random directions much more rarely.

* Equal vectors of a label are one class; only classes are compared.
* Leading projections cut a large label into cells, one more per doubling beyond ``BLOCK`` vectors, in
  several independent *tables*: as many as a pair at the threshold needs to share a cell in one of them.
  A vector is in one cell of each table, so its entries grow with the logarithm of the label's size and a
  small power of it, and a pair counts in the first table in which it shares a cell.
* Most of a hot group shares its cell in every table.  In later tables the members of a cell that come
  from its largest cell of the first table have met already; only the others are queries there.
* Within a cell, blocks of ``BLOCK`` queries and ``BLOCK`` vectors: each of ``PROJECTIONS`` sorted
  projections adds one to the pairs inside its query-centred windows, and pairs that reach the
  calibrated count are verified by their cosine in double precision.

Tables, window and count are calibrated on the chance of a pair exactly at the threshold (``RECALL``; closer
pairs are safer).  A hot label or cell is many blocks, dealt as separate groups.
"""

from __future__ import annotations

from math import ceil, comb, log, pi, sqrt
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.llm.components import connected_components
from hydrix.llm.words import mix
from hydrix.session import Scratch

THRESHOLD = 0.98
PROJECTIONS, WINDOW_SIGMAS, RECALL, SEED = 24, 2.0, 0.999, 23
#: Vectors of a block; the most cell projections of a label (enough for 2^32 blocks of vectors).
BLOCK, MOST_CELL_PROJECTIONS = 512, 32
#: Width of a cell, in deviations of a pair at the threshold.
CELL_SIGMAS = 10.0

_U = np.uint64


def deviation(threshold: float) -> float:
    return float(np.sqrt(2 * (1 - threshold)))


def least_count(recall: float = RECALL, n: int = PROJECTIONS, sigmas: float = WINDOW_SIGMAS) -> int:
    """The largest count that a pair at the threshold reaches with at least the given chance."""
    p = 2 * NormalDist().cdf(sigmas) - 1
    tail = 0.0
    for count in range(n, -1, -1):
        tail += comb(n, count) * p**count * (1 - p) ** (n - count)
        if tail >= recall:
            return count
    return 0


def tables(n: int, recall: float = RECALL) -> int:
    """Tables of n cell projections in which a pair at the threshold shares a cell at least once, with
    the given chance."""
    same = (1 - sqrt(2 / pi) / CELL_SIGMAS) ** n
    return 1 if same >= recall else ceil(log(1 - recall) / log(1 - same))


def directions(dim: int, n: int, stream: int) -> np.ndarray:
    return np.random.default_rng([SEED, stream, dim]).normal(size=(dim, n))


def unit_rows(blobs) -> np.ndarray:
    """Unit vectors in double precision from packed doubles."""
    v = np.stack([np.frombuffer(b, "<f8") for b in blobs])
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _cell_numbers(unit: np.ndarray, n: int, threshold: float) -> np.ndarray:
    """(vectors, tables) cell numbers of unit vectors for n cell projections a table."""
    out = np.zeros((len(unit), tables(n)), _U)
    width = CELL_SIGMAS * deviation(threshold)
    for t in range(out.shape[1] if n else 0):
        g = directions(unit.shape[1], n, 3 + t)
        offset = np.random.default_rng([SEED, 1, t]).uniform(0, width, n)
        for column in np.floor((unit @ g + offset) / width).T:
            out[:, t] = mix(out[:, t] * _U(31) + column.astype(np.int64).view(_U) + _U(1))
    return out.view(np.int64)


def cells(vector: Column, n_cell: Column, threshold: float) -> Column:
    """Struct (packed: the vector in double precision, cells: its cell in each table) for the label's
    number of cell projections."""

    @F.arrow_udf("struct<packed:binary,cells:array<bigint>>")
    def apply(vectors: pa.Array, numbers: pa.Array) -> pa.Array:
        packed = [np.asarray(v, "<f8").tobytes() for v in vectors.to_pylist()]
        own: list = [None] * len(packed)
        alike: dict[tuple[int, int], list[int]] = {}
        for i, n in enumerate(numbers.to_pylist()):
            alike.setdefault((n, len(packed[i])), []).append(i)
        for (n, _), at in alike.items():
            for i, c in zip(at, _cell_numbers(unit_rows([packed[i] for i in at]), n, threshold).tolist()):
                own[i] = c
        return pa.StructArray.from_arrays([pa.array(packed, pa.binary()), pa.array(own, pa.list_(pa.int64()))], ["packed", "cells"])

    return apply(vector, n_cell)


def collisions(queries: np.ndarray, vectors: np.ndarray, window: float) -> np.ndarray:
    """Matrix of the number of projections in which a vector is inside a query's window."""
    counts = np.zeros((len(queries), len(vectors)), np.uint8)
    g = directions(queries.shape[1], PROJECTIONS, 2)
    for x, y in zip((queries @ g).T, (vectors @ g).T):
        order = np.argsort(y)
        lo, hi = np.searchsorted(y[order], x - window), np.searchsorted(y[order], x + window, "right")
        place = np.empty(len(y), np.int64)
        place[order] = np.arange(len(y))
        counts += (place[None] >= lo[:, None]) & (place[None] < hi[:, None])
    return counts


def block_links(threshold: float):
    """Per block: for each vector that links, how many rows it links with and its group's least class."""

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        is_query = block["query"].to_numpy()
        q, v = block[is_query], block[~is_query]
        if not len(q) or not len(v):
            return pd.DataFrame({"cls": [], "peer": [], "n": []}).astype("int64")
        a, b = unit_rows(q["packed"]), unit_rows(v["packed"])
        ca, cb = q["cls"].to_numpy(), v["cls"].to_numpy()
        before_a, before_b = (np.stack(x["cells"].to_list())[:, : block["t"].iloc[0]] for x in (q, v))
        counts = collisions(a, b, WINDOW_SIGMAS * deviation(threshold))
        # a pair of two queries comes twice: its lesser class asks
        asks = (ca[:, None] < cb[None, :]) | ~v["open"].to_numpy()[None, :]
        i, j = np.nonzero((counts >= least_count()) & asks)
        close = np.zeros(len(i), bool)
        for lo in range(0, len(i), 1 << 16):
            s = slice(lo, lo + (1 << 16))
            met = (before_a[i[s]] == before_b[j[s]]).any(axis=1)
            close[s] = ((a[i[s]] * b[j[s]]).sum(axis=1) >= threshold) & ~met
        link = np.zeros(counts.shape, bool)
        link[i[close], j[close]] = True
        n_a = link @ v["rows"].to_numpy()
        n_b = q["rows"].to_numpy() @ link
        top = np.iinfo(np.int64).max
        la = np.where(link.any(axis=1), ca, top)
        while True:  # least class of every connected part of the block
            lb = np.where(link, la[:, None], top).min(axis=0)
            new = np.minimum(la, np.where(link, lb[None, :], top).min(axis=1))
            if (new == la).all():
                break
            la = new
        out = pd.DataFrame({"cls": np.concatenate([ca, cb]), "peer": np.concatenate([la, lb]), "n": np.concatenate([n_a, n_b])})
        return out[out["n"] > 0].astype("int64")

    return compare


def linked_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per vector: vec_id, n_links (other rows linked directly), component_id, kept.

    Linked: equal labels (not null), equally many components, cosine of at least ``threshold``.  A
    vector that is null, empty, zero or holds a null or non-finite component links with nothing, and
    neither does one without a label; its component is its own id.  Equal vectors always link; rows
    that repeat an id count as other rows; an empty table gives an empty result; extra columns are
    ignored.
    """
    body = F.col(f"`{vector}`").cast("array<double>")
    fit = body.isNotNull() & (F.size(body) > 0) & F.exists(body, lambda x: x != 0) & ~F.exists(
        body, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    valid = F.coalesce(fit, F.lit(False)) & F.col(f"`{label}`").isNotNull()
    with Scratch(vectors.sparkSession, "vectors") as scratch:
        rows = vectors.select(
            F.col(f"`{key}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), body.alias("v"),
            F.when(valid, F.xxhash64(F.col(f"`{label}`"), body)).alias("cls"),
        )
        classes = rows.where("cls is not null").groupBy("cls").agg(
            F.min("vec_id").alias("min_id"), F.count(F.lit(1)).alias("rows"), F.first("label").alias("label"), F.first("v").alias("v")
        )
        classes = scratch.stage(classes.withColumn("dim", F.size("v")), "classes")
        sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
        doublings = F.ceil(F.log2(F.col("n") / BLOCK)).cast("int")
        sizes = scratch.stage(sizes.select("label", "dim", F.least(F.greatest(doublings, F.lit(0)), F.lit(MOST_CELL_PROJECTIONS)).alias("n_cell")), "labels")
        placed = classes.join(sizes, ["label", "dim"]).withColumn("c", cells(F.col("v"), F.col("n_cell"), threshold))
        placed = scratch.stage(placed.select("cls", "rows", "label", "dim", "c.packed", "c.cells"), "placed")
        at = ["label", "dim", "t", "cell"]
        home = F.when(F.col("t") > 0, F.col("cells")[0])
        members = placed.select("cls", "label", "dim", "cells", F.posexplode("cells").alias("t", "cell")).select("cls", *at, home.alias("home"))
        n_homes = members.groupBy(*at, "home").agg(F.count(F.lit(1)).alias("n"))
        plan = n_homes.groupBy(*at).agg(F.max(F.struct("n", "home")).alias("m"), F.sum("n").alias("n_all"))
        plan = plan.withColumn("n_open", F.when(F.col("t") == 0, F.col("n_all")).otherwise(F.col("n_all") - F.col("m.n")))
        plan = plan.where("n_open > 0 and n_all > 1").select(
            *at, F.col("m.home").alias("largest"), F.ceil(F.col("n_all") / BLOCK).cast("long").alias("nv"),
            F.ceil(F.col("n_open") / BLOCK).cast("long").alias("nq"),
        )
        plan = scratch.stage(plan, "plan")
        zero = F.lit(0).cast("long")
        is_open = (F.col("t") == 0) | (F.col("home") != F.col("largest"))
        met = scratch.stage(members.join(plan, at).select("cls", *at, "nv", "nq", is_open.alias("open")), "met")
        left = met.where("open").select(
            "cls", *at, F.pmod(F.xxhash64("cls"), "nq").alias("i"), F.explode(F.sequence(zero, F.col("nv") - 1)).alias("j"),
            F.lit(True).alias("query"), "open",
        )
        right = met.select(
            "cls", *at, F.explode(F.sequence(zero, F.col("nq") - 1)).alias("i"), F.pmod(F.xxhash64("cls", F.lit(1)), "nv").alias("j"),
            F.lit(False).alias("query"), "open",
        )
        blocks = left.unionByName(right).join(placed.select("cls", "rows", "packed", "cells"), "cls")
        found = blocks.groupBy(*at, "i", "j").applyInPandas(block_links(threshold), "cls bigint, peer bigint, n bigint")
        found = scratch.stage(found, "found")
        comps = scratch.stage(connected_components(found, scratch, "cls", "peer"), "components")
        counts = found.groupBy("cls").agg(F.sum("n").alias("n"))
        result = classes.select("cls", "min_id", "rows").join(counts, "cls", "left").join(comps, F.col("cls") == F.col("node"), "left")
        result = scratch.stage(result.select("cls", "min_id", (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.coalesce("component", "cls").alias("comp")), "counted")
        least = scratch.stage(result.groupBy("comp").agg(F.min("min_id").alias("component_id")), "least")
        result = scratch.stage(result.join(least, "comp").select("cls", "n_links", "component_id"), "result", keep=True)
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select("vec_id", "cls").join(result, "cls", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
