"""Vector compression into codebook indexes, with LAESA pivots in the nearest-entry search.

Vectors become integers and are cut into equal parts; every part position has a codebook of a few entries
that rounds of assignment and averaging improve.  The search for a part's nearest entry follows LAESA
(linear approximating and eliminating search):

* A few fixed *pivots* a position are chosen among the initial entries, far from each other.  The distance of
  every part to its pivots is computed once, and written beside the integers.
* Each round computes the distances between pivots and entries (a few numbers).  By the triangle inequality
  |d(part, pivot) - d(pivot, entry)| is a lower bound of d(part, entry).
* Entries are tried in the order of their greatest lower bound; a part stops at the first bound beyond its
  best distance.  What is tried is evaluated in exact integers, so results do not depend on the pivots.

A round sends one sum a component and entry from each task; the codebooks (positions x entries x part length
integers, a parameter) are the only thing that the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.session import Scratch

# Fixed values of the contract: factor of the integers, parts, entries a codebook, rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
PIVOTS = 4
#: Relative slack of a lower bound: pivot distances are kept in single precision.
SLACK = 1e-6
#: Vectors that the kernels handle at once.
BLOCK = 4096
#: Squared distances of whole vectors stay below 2^TOP_BITS, so that they and their sums fit 64 bits.
TOP_BITS = 62

_FAR = np.iinfo(np.int64).max


def usable(vector: Column) -> Column:
    """Not null, and neither null nor non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def integers(vectors: pa.Array, length: int) -> np.ndarray:
    """(vectors, length) floor(SCALE x); shorter vectors end in zeros.

    Components are held within the range in which squared distances fit 64 bits (far beyond the unit range).
    """
    counts = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    top = 2.0 ** ((TOP_BITS - int(max(length, 1)).bit_length()) // 2 - 1)
    flat = np.clip(np.floor(flat * SCALE), -top, top).astype(np.int64)
    if len(counts) and counts.min() == counts.max() == length:
        return flat.reshape(len(counts), length)
    out = np.zeros((len(counts), length), np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)] = flat
    return out


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def choose_pivots(entries: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Rows of ``entries`` far from each other: the first, then each time the farthest from those chosen."""
    chosen = [0] if len(entries) else []
    reach = squared(entries, entries[:1]) if len(entries) else np.zeros(0, np.int64)
    while len(chosen) < min(pivots, len(entries)):
        chosen.append(int(reach.argmax()))
        reach = np.minimum(reach, squared(entries, entries[chosen[-1]]))
    return entries[chosen]


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """(rows, pivots) distances."""
    return np.sqrt(np.stack([squared(rows, p) for p in pivots], axis=1).astype(np.float64))


def nearest(rows: np.ndarray, reach: np.ndarray, entries: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, squared distance, exact evaluations); ties go to the lower index.

    ``reach``: distances of the rows to the pivots; ``gaps``: (pivots, entries) distances between them.
    """
    bound = np.zeros((len(rows), len(entries)))
    for j in range(len(gaps)):
        near, far = reach[:, j, None], gaps[j][None, :]
        np.maximum(bound, np.abs(near - far) - SLACK * (near + far), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    best, which = np.full(len(rows), _FAR), np.zeros(len(rows), np.int64)
    live, tried = np.arange(len(rows)), 0
    for step in range(len(entries)):
        entry = order[live, step]
        # a later entry's bound is no smaller, so a row whose bound is beyond its best is settled
        open_ = bound[live, entry] ** 2 <= best[live].astype(np.float64)
        live, entry = live[open_], entry[open_]
        if not len(live):
            break
        tried += len(live)
        found = squared(rows[live], entries[entry])
        better = (found < best[live]) | ((found == best[live]) & (entry < which[live]))
        at = live[better]
        best[at], which[at] = found[better], entry[better]
    return which, best, tried


@dataclass
class Codebooks:
    """``entries``: (parts, entries, part length) integers; ``pivots``: (parts, pivots, part length)."""

    entries: np.ndarray
    pivots: np.ndarray

    def gaps(self) -> list[np.ndarray]:
        return [distances(e, p).T for e, p in zip(self.entries, self.pivots)]

    def sha256(self) -> str:
        """Of all components in decimal, comma-joined by part, entry and place."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _packed(rows: np.ndarray) -> pa.Array:
    """Binary values of equal length, one a row."""
    rows = np.ascontiguousarray(rows)
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _unpacked(blobs: pa.Array, kind: str, width: int) -> np.ndarray:
    if not len(blobs) or not width:
        return np.zeros((len(blobs), width), kind)
    _, offsets, data = blobs.buffers()
    first = np.frombuffer(offsets, np.int32)[blobs.offset]
    return np.frombuffer(data, np.uint8)[first : first + len(blobs) * width * np.dtype(kind).itemsize].view(kind).reshape(len(blobs), width)


def prepared(vector: Column, length: int, pivots: np.ndarray) -> Column:
    """Struct (whole: the integers, reach: distances of every part to its pivots), both packed."""
    parts, _, part = pivots.shape

    @F.arrow_udf("struct<whole:binary,reach:binary>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            wholes, reaches = [], []
            for lo in range(0, len(vectors), BLOCK):
                whole = integers(vectors.slice(lo, BLOCK), length)
                pieces = _parts(whole, parts, part)
                reaches.append(np.concatenate([distances(pieces[:, p], pivots[p]) for p in range(parts)], axis=1).astype(np.float32))
                wholes.append(whole)
            whole = np.concatenate(wholes) if wholes else np.zeros((0, length), np.int64)
            reach = np.concatenate(reaches) if reaches else np.zeros((0, 0), np.float32)
            yield pa.StructArray.from_arrays([_packed(whole.astype("<i8")), _packed(reach)], ["whole", "reach"])

    return apply(vector)


def _parts(whole: np.ndarray, parts: int, part: int) -> np.ndarray:
    """(vectors, parts, part length); a length that the parts do not divide ends in zeros."""
    out = np.zeros((len(whole), parts * part), np.int64)
    out[:, : whole.shape[1]] = whole
    return out.reshape(len(whole), parts, part)


def _assigned(whole: pa.Array, reach: pa.Array, length: int, books: Codebooks) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(parts, indexes, squared distances) of a batch, a block of vectors at a time."""
    parts, pivots, part = books.pivots.shape
    gaps = books.gaps()
    for lo in range(0, len(whole), BLOCK):
        pieces = _parts(_unpacked(whole.slice(lo, BLOCK), "<i8", length), parts, part)
        near = _unpacked(reach.slice(lo, BLOCK), "<f4", parts * pivots).astype(np.float64).reshape(len(pieces), parts, pivots)
        found = [nearest(pieces[:, p], near[:, p], books.entries[p], gaps[p])[:2] for p in range(parts)]
        yield pieces, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _round(table: DataFrame, length: int, books: Codebooks) -> np.ndarray:
    """The next entries: floored means of the parts assigned to each; an unused entry stays."""
    parts, entries, part = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, entries, part), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for pieces, index, _ in _assigned(batch.column("whole"), batch.column("reach"), length, books):
                for p in range(parts):
                    np.add.at(total[p], index[:, p], pieces[:, p])
                    count[p] += np.bincount(index[:, p], minlength=entries)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))],
            ["part", "entry", "n", "total"],
        )

    found = table.select("whole", "reach").mapInArrow(sums, "part int, entry int, n long, total array<long>")
    columns = [F.sum(F.col("total")[j]).alias(f"t{j}") for j in range(part)]
    out = books.entries.copy()
    for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *columns).collect():  # parts x entries rows
        out[row.part, row.entry] = [row[f"t{j}"] // row.n for j in range(part)]
    return out


def _coded(whole: Column, reach: Column, length: int, books: Codebooks) -> Column:
    @F.arrow_udf("struct<code:string,error:bigint>")
    def apply(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for w, r in batches:
            codes, errors = [], []
            for _, index, far in _assigned(w, r, length, books):
                codes += [bytes(row).hex() for row in index.astype(np.uint8)]
                errors.append(far.sum(axis=1))
            error = np.concatenate(errors) if errors else np.zeros(0, np.int64)
            yield pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(error)], ["code", "error"])

    return apply(whole, reach)


def compress_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) of every usable vector, and the codebooks.

    ``code`` holds a part's index in two hexadecimal digits each (256 entries at most), ``error`` the squared
    distances in integers.  Vectors that are null or hold null or non-finite components are dropped.  Vectors
    shorter than the longest end in zeros, as does a length that the parts do not divide.  Codebooks start
    from the rows of the smallest keys (null keys last, ties by the vector); with fewer rows they have fewer
    entries.  Repeated rows count as often as they occur.  Extra columns are ignored.  An empty table gives
    an empty result.  Components beyond about 2^17 (for 64 of them) are held at that bound.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    rows = vectors.select(
        F.col(f"`{key}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector")
    ).where(usable(F.col("vector")))
    length = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    part = -(-length // parts)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).collect()
    whole = integers(pa.array([r.vector for r in first], pa.list_(pa.float64())), length)
    start = _parts(whole, parts, part).transpose(1, 0, 2)
    books = Codebooks(start, np.stack([choose_pivots(e, pivots) for e in start]) if len(first) else start)
    with Scratch(vectors.sparkSession, "vectors") as scratch:
        made = prepared(F.col("vector"), length, books.pivots)
        table = scratch.stage(rows.select("vec_id", "label", made.alias("made")).select("vec_id", "label", "made.*"), "parts")
        for _ in range(rounds if len(first) else 0):
            books = Codebooks(_round(table, length, books), books.pivots)
        code = _coded(F.col("whole"), F.col("reach"), length, books)
        coded = table.select("vec_id", "label", code.alias("made")).select("vec_id", "label", "made.*")
        return scratch.stage(coded, "codes", keep=True), books
