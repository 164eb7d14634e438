"""Removal of repeated byte strings by bucket-pointer refinement.

A byte is removed if a ``LENGTH``-byte string over it starts anywhere else.  Buckets of equal q-grams
are refined, as in bucket-pointer suffix sorting, by the bucket identifiers of later offsets: the
identifier of a longer string is made from those of its halves -- 8 bytes, then 16, 32, 40, 80, 160
and 200 -- so each level reuses the ones before.  Positions alone in their bucket leave at once.

Only one position per stretch starts the refinement.  In each 200-byte string the least 40-gram
identifier marks an *anchor* (equal strings have it at the same place), so equal strings are found in
the bucket of their anchor.  Then, each level being a grouped minimum and maximum over locations:

1. q-gram buckets of anchors; single ones leave.
2. Within a bucket, the 360 bytes that hold every string around the anchor: if they occur twice, all
   strings of that anchor are repeated.  One of each such group goes on, as a partner for the rest.
3. The rest are cut into blocks of ``STEP`` successive strings, bucketed by the 185 bytes that all of
   them share; blocks with equal surroundings are settled whole.
4. Strings of the blocks that are left, bucketed one by one.

Texts go through as distinct classes (64-bit text fingerprints; texts that share one but differ in SHA-256
get classes of their own): a text with copies is repeated as a whole.  Only texts with a shared anchor are
shuffled, once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.llm.keyfilter import key_filter, may_match
from hydrix.llm.words import buffers, row_chunks
from hydrix.session import Scratch

#: Length of the strings, of the initial q-grams, and successive strings of a block.
LENGTH, GRAM, STEP = 200, 40, 16
#: Places of a q-gram in a string; bytes that the strings of a block share, and around them.
PLACES, CORE, RIM = LENGTH - GRAM + 1, LENGTH - STEP + 1, STEP - 1
#: Bits of a position beside the leading bits of an identifier: a text is below 2^31 bytes.  The number is fixed,
#: for equal strings must choose their anchors by the same bits wherever they lie.
PLACE_BITS = 32
#: Bytes of text whose identifiers fit a core's cache.
CHUNK = 1 << 17

_U = np.uint64


def fingerprint(body: Column) -> Column:
    return F.xxhash64(body)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifier of a bucket from the identifiers of two parts of its string."""
    x = a * _U(0x9E3779B97F4A7C15) + b * _U(0xC2B2AE3D27D4EB4F)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(29)
    return x


def gram_ids(data: np.ndarray) -> np.ndarray:
    """Bucket identifier of the 40 bytes from each position (zero-padded at the end)."""
    n = len(data)
    padded = np.zeros(n + 2 * GRAM + 8, np.uint8)
    padded[:n] = data
    m = n + GRAM
    id8 = np.ndarray((m + GRAM,), "<u8", padded, strides=(1,)).astype(_U)
    id16 = _pair(id8[: m + 24], id8[8 : m + 32])
    id32 = _pair(id16[: m + 8], id16[16 : m + 24])
    return _pair(id32[:n], id8[32 : n + 32])


def string_ids(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Identifiers of the 160 bytes from given positions, from later 40-byte buckets."""
    first = _pair(ids[at], ids[at + GRAM])
    return _pair(first, _pair(ids[at + 2 * GRAM], ids[at + 3 * GRAM]))


def anchors(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first string, last string, row): each anchor with the run of strings that it marks."""
    n = len(ids)
    last = np.repeat(offsets[1:], np.diff(offsets)) - LENGTH  # the last string start of each byte's row
    starts = np.flatnonzero(np.arange(n) <= last)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4
    bits = _U(PLACE_BITS)
    low = (_U(1) << bits) - _U(1)
    least = np.full(n + PLACES, ~_U(0))
    least[:n] = (ids & ~low) | np.arange(n, dtype=_U)  # ties go to the leftmost
    width = 1
    while 2 * width <= PLACES:
        least[: -width] = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[PLACES - width : n + PLACES - width])
    at = (least[starts] & low).astype(np.int64)
    new = np.concatenate([[True], at[1:] != at[:-1]])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    return at[begin], starts[begin], starts[end], np.searchsorted(offsets, starts[begin], "right") - 1


def _list_of(fields: dict[str, pa.Array], counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    values = pa.StructArray.from_arrays(list(fields.values()), list(fields))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def anchor_rows(text: Column) -> Column:
    """array<struct<place, gram, around>>: a text's anchors.  ``place`` packs the position and the
    offsets of its first and last string; ``around`` is null where the 360 bytes leave the text."""

    @F.arrow_udf("array<struct<place:bigint,gram:bigint,around:bigint>>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, offsets = buffers(texts)
            parts = []
            for lo, hi in row_chunks(offsets, CHUNK):
                own = offsets[lo : hi + 1] - offsets[lo]
                ids = gram_ids(data[offsets[lo] : offsets[hi]])
                at, first, last, row = anchors(ids, own)
                whole = (at - PLACES + 1 >= own[row]) & (at + LENGTH <= own[row + 1])
                around = np.zeros(len(at), _U)
                mid = at[whole]
                around[whole] = _pair(_pair(string_ids(ids, mid - PLACES + 1), string_ids(ids, mid)), ids[mid + LENGTH - GRAM])
                place = ((at - own[row]) << 16) | ((at - first) << 8) | (at - last)
                parts.append(_list_of(
                    {"place": pa.array(place, pa.int64()), "gram": pa.array(ids[at].view(np.int64), pa.int64()),
                     "around": pa.array(around.view(np.int64), pa.int64(), mask=~whole)},
                    np.bincount(row, minlength=hi - lo),
                ))
            yield pa.concat_arrays(parts) if parts else pa.array([], parts_type())

    return apply(text)


def parts_type() -> pa.DataType:
    return pa.list_(pa.struct([("place", pa.int64()), ("gram", pa.int64()), ("around", pa.int64())]))


def block_rows(text: Column, places: Column) -> Column:
    """array<struct<x, core, lhs, rhs>>: blocks of successive strings around the given anchors.

    Block strings start at x, x-1, .. x-RIM; ``core`` identifies the bytes that all share, ``lhs`` and
    ``rhs`` are the up to RIM bytes before and after them inside the text.
    """

    @F.arrow_udf("array<struct<x:bigint,core:bigint,lhs:binary,rhs:binary>>")
    def apply(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            parts = []
            for text_, marked in zip(texts, lists):
                raw = text_.as_py().encode()
                ids = gram_ids(np.frombuffer(raw, np.uint8))
                place = np.asarray(marked.values, np.int64)
                at, first, last = place >> 16, (place >> 8) & 255, place & 255  # offsets, first >= last
                n_blocks = first // STEP - last // STEP + 1
                which = np.repeat(np.arange(len(at)), n_blocks)
                nth = np.arange(n_blocks.sum()) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
                x = np.unique(at[which] - STEP * (last[which] // STEP + nth))
                core = _pair(string_ids(ids, x), ids[x + CORE - GRAM]).view(np.int64)
                parts.append(_list_of(
                    {"x": pa.array(x, pa.int64()), "core": pa.array(core, pa.int64()),
                     "lhs": pa.array([raw[max(0, i - RIM) : i] for i in x.tolist()], pa.binary()),
                     "rhs": pa.array([raw[i + CORE : i + LENGTH] for i in x.tolist()], pa.binary())},
                    np.array([len(x)]),
                ))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.struct(
                [("x", pa.int64()), ("core", pa.int64()), ("lhs", pa.binary()), ("rhs", pa.binary())])))

    return apply(text, places)


def removed_spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes under strings that start in the given ranges."""
    order = np.argsort(first, kind="stable")
    begin, end = first[order], np.maximum.accumulate(last[order] + LENGTH)
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    at = np.flatnonzero(new)
    return begin[at], end[np.append(at[1:], len(begin)) - 1]


def kept_bytes(raw: bytes, starts: list[int], ends: list[int]) -> bytes:
    parts, at = [], 0
    for s, e in zip(starts, ends):
        parts.append(raw[at:s])
        at = e
    return b"".join([*parts, raw[at:]])


def span_rows(text: Column, ranges: Column) -> Column:
    """Struct (n_removed, n_spans, starts, ends, kept_sha256) from a text and its repeated strings."""

    @F.arrow_udf("struct<n_removed:bigint,n_spans:bigint,starts:array<bigint>,ends:array<bigint>,kept_sha256:string>")
    def apply(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            rows = []
            for text_, found in zip(texts, lists):
                first = np.asarray(found.values.field("first"), np.int64)
                starts, ends = (v.tolist() for v in removed_spans(first, np.asarray(found.values.field("last"), np.int64)))
                kept = hashlib.sha256(kept_bytes(text_.as_py().encode(), starts, ends)).hexdigest()
                rows.append((sum(ends) - sum(starts), len(starts), starts, ends, kept))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string()]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["n_removed", "n_spans", "starts", "ends", "kept_sha256"]
            )

    return apply(text, ranges)


def _shared(rows: DataFrame, keys: list[str], loc: Column, scratch: Scratch, name: str) -> DataFrame:
    """Buckets with two locations or more, with the least location."""
    found = rows.groupBy(*keys).agg(F.min(loc).alias("rep"), F.max(loc).alias("top")).where("rep <> top")
    return scratch.stage(found.drop("top"), name)


def _copies(rows: DataFrame) -> DataFrame:
    """Classes of two rows or more: number, size, and whether their texts differ (``clash``)."""
    mark = F.xxhash64("own")
    found = rows.where(F.col("n_bytes") >= LENGTH).groupBy("cls").agg(
        F.count(F.lit(1)).alias("n"), F.first("n_bytes").alias("n_bytes"), (F.min(mark) != F.max(mark)).alias("clash")
    )
    return found.where("n > 1")


def _apart(rows: DataFrame, own: Column, clash: DataFrame | None) -> DataFrame:
    """``rows`` with classes made from the SHA-256 (``own``) of their texts where a fingerprint is shared."""
    if clash is None:
        return rows
    listed = clash.select(F.col("cls").alias("clashing"))
    marked = rows.join(listed, F.col("cls") == F.col("clashing"), "left")
    return marked.withColumn("cls", F.when(F.col("clashing").isNull(), F.col("cls")).otherwise(F.xxhash64(own))).drop("clashing")


def text_classes(docs: DataFrame, key: str, body: Column, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """``(rows, copied, clash)``: the documents with their class, size and SHA-256, kept; the classes of copies;
    and the fingerprints that different texts share (None where there is none)."""
    rows = scratch.stage(
        docs.select(F.col(f"`{key}`").alias("doc_id"), fingerprint(body).alias("cls"),
                    F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body.cast("binary"), 256).alias("own")),
        "rows", keep=True,
    )
    copied = scratch.stage(_copies(rows), "copied")
    clash = copied.where("clash").select("cls")
    if clash.isEmpty():
        return rows, copied, None
    clash = scratch.stage(clash, "clash", keep=True)
    again = _copies(_apart(rows.join(clash, "cls", "left_semi"), F.col("own"), clash))
    return _apart(rows, F.col("own"), clash), scratch.stage(copied.where("not clash").unionByName(again), "apart"), clash


def repeated_strings(docs: DataFrame, text: str, scratch: Scratch, clash: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(ranges, texts)``: for text classes ``cls`` the ranges (first, last) of starts of repeated
    strings, and the text of every class that has a shared anchor.  Copies of whole texts don't count."""
    body = F.col(f"`{text}`")
    plain = docs.where(F.octet_length(body) >= LENGTH).select(fingerprint(body).alias("cls"), body.alias("text"))
    plain = _apart(plain, F.sha2(F.col("text").cast("binary"), 256), clash)
    marks = scratch.stage(
        plain.select("cls", F.explode(anchor_rows(F.col("text"))).alias("m")).select("cls", "m.place", "m.gram", "m.around"), "marks"
    )
    loc = F.xxhash64("cls", "place")
    grams = _shared(marks, ["gram"], loc, scratch, "grams").drop("rep")
    near = may_match(marks, F.col("gram"), key_filter(grams, "gram")).where("__may").drop("__may")
    open_ = scratch.stage(near.join(grams, "gram"), "open")
    scratch.drop(marks)
    settled = _shared(open_.where("around is not null"), ["gram", "around"], loc, scratch, "settled")
    judged = open_.join(settled, ["gram", "around"], "left").select("cls", "place", F.col("rep").isNotNull().alias("done"), (F.col("rep") == loc).alias("first"))
    judged = scratch.stage(judged.distinct(), "judged")
    at = F.shiftright("place", 16)
    whole = judged.where("done").select(
        "cls", (at - F.pmod(F.shiftright("place", 8), F.lit(256))).alias("first"), (at - F.pmod("place", F.lit(256))).alias("last")
    )
    # texts of the classes that have a shared anchor, once each
    classes = scratch.stage(judged.groupBy("cls").agg(F.collect_list(F.when(~F.col("done") | F.col("first"), F.col("place"))).alias("places")), "classes")
    texts = may_match(plain, F.col("cls"), key_filter(classes, "cls")).where("__may").groupBy("cls").agg(F.first("text").alias("text"))
    texts = scratch.stage(texts.join(classes, "cls"), "texts")
    blocks = texts.where(F.size("places") > 0).select("cls", F.explode(block_rows(F.col("text"), F.col("places"))).alias("b"))
    blocks = scratch.stage(blocks.select("cls", "b.x", "b.core", "b.lhs", "b.rhs"), "blocks")
    bloc = F.xxhash64("cls", "x")
    cores = _shared(blocks, ["core"], bloc, scratch, "cores").drop("rep")
    near = may_match(blocks, F.col("core"), key_filter(cores, "core")).where("__may").drop("__may")
    open_ = scratch.stage(near.join(cores, "core"), "open-blocks")
    scratch.drop(blocks)
    full = (F.octet_length("lhs") == RIM) & (F.octet_length("rhs") == RIM)
    settled = _shared(open_.where(full), ["core", "lhs", "rhs"], bloc, scratch, "settled-blocks")
    judged = scratch.stage(
        open_.join(settled, ["core", "lhs", "rhs"], "left")
        .withColumn("done", F.col("rep").isNotNull()).withColumn("first", F.col("rep") == bloc).drop("rep"), "judged-blocks",
    )
    block = judged.where("done").select("cls", (F.col("x") - RIM).alias("first"), F.col("x").alias("last"))
    # the strings of the other blocks: i bytes before the shared ones, RIM - i after
    i = F.explode(F.sequence(F.greatest(F.lit(0), F.lit(RIM) - F.octet_length("rhs")), F.octet_length("lhs")))
    fits = F.octet_length("lhs") + F.octet_length("rhs") >= RIM
    single = judged.where((~F.col("done") | F.col("first")) & fits).withColumn("i", i)
    string = F.xxhash64(
        "core", "i", F.expr(f"substring(lhs, octet_length(lhs) - i + 1, i)"), F.expr(f"substring(rhs, 1, {RIM} - i)")
    )
    single = scratch.stage(single.select(string.alias("string"), "cls", (F.col("x") - F.col("i")).alias("at")), "strings")
    strings = _shared(single, ["string"], F.xxhash64("cls", "at"), scratch, "shared-strings").drop("rep")
    near = may_match(single, F.col("string"), key_filter(strings, "string")).where("__may")
    one = near.join(strings, "string").select("cls", F.col("at").alias("first"), F.col("at").alias("last"))
    ranges = whole.unionByName(block).unionByName(one)
    return scratch.stage(ranges.groupBy("cls").agg(F.collect_set(F.struct("first", "last")).alias("ranges")), "ranges"), texts


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed runs
    (starts, ends: byte offsets; ``kept_bytes`` gives the remaining text).

    A null text is empty; texts shorter than a string keep every byte; a text with an exact copy (a
    repeated row too, told by SHA-256) of at least one string's length loses every byte.  Strings are compared
    by identifiers of 64 bits, levels 3 and 4 within their bucket by bytes.  Null ids, ties and extra
    columns do not matter; an empty table gives an empty result.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    with Scratch(docs.sparkSession, "repeats") as scratch:
        rows, copied, clash = text_classes(docs, key, body, scratch)
        ranges, texts = repeated_strings(docs, text, scratch, clash)
        found = texts.select("cls", "text").join(ranges, "cls").join(copied.select("cls"), "cls", "left_anti")
        found = found.select("cls", span_rows(F.col("text"), F.col("ranges")).alias("r")).select("cls", "r.*")
        empty = hashlib.sha256(b"").hexdigest()
        gone = copied.select(
            "cls", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
            F.array(F.lit(0).cast("long")).alias("starts"), F.array("n_bytes").alias("ends"), F.lit(empty).alias("kept_sha256"),
        )
        result = scratch.stage(found.unionByName(gone), "result", keep=True)
    none = F.array().cast("array<bigint>")
    return rows.join(result, "cls", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "own").alias("kept_sha256"), F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends"),
    )
