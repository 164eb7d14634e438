"""Benchmark decontamination with one FM-index per training shard.

A shard is a run of documents of a Spark task (``SHARD_WORDS`` words, or one longer document).  Its
words are numbered by the benchmark's vocabulary; every run of other words, and every document end, is
a terminator of its own, smaller than all vocabulary and in text order.  No benchmark phrase can match
across one, and suffixes that reach one are told apart by it, so the suffix order settles in a few
rounds of prefix doubling even between copies.  Over the Burrows-Wheeler transform of that text lie

* a wavelet tree (bit levels with block counts) that answers rank(symbol, row) for backward search --
  all benchmark windows are searched at once, last word first;
* suffix positions sampled every ``SAMPLE`` words and at each row that follows a foreign word;
  other rows walk there by last-to-first steps.

Located windows are merged into removal spans per document.  The benchmark is the stated query set:
it is read in blocks of at most ``BLOCK_BYTES`` of text, each of which travels with the task code.  A larger
benchmark takes one pass over the shards per block; a pass writes its result before the next block is
read, so the driver holds one block at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrix.llm.names import free
from hydrix.llm.words import ALNUM, LOWER, buffers, row_chunks, word_hashes, word_spans
from hydrix.session import Scratch

WINDOW = 10
SHARD_WORDS = 1 << 19
SAMPLE = 16
#: Benchmark text that one pass carries to the executors.
BLOCK_BYTES = 8 << 20

RESULT = (
    "struct<n_words:bigint,n_hit:bigint,items:array<string>,word_starts:array<bigint>,word_ends:array<bigint>,"
    "starts:array<bigint>,ends:array<bigint>>"
)


@dataclass
class Phrases:
    """Distinct benchmark windows over the vocabulary numbers 1..V, and the items that hold each."""

    vocabulary: np.ndarray  # sorted word fingerprints
    windows: np.ndarray  # one per row, right-aligned, 0 before the first word
    lengths: np.ndarray
    owner_start: np.ndarray  # windows -> range of ``owners``
    owners: np.ndarray  # index into ``items``
    items: list[str | None]


def make_phrases(rows: list[tuple[str | None, str | None]], window: int = WINDOW) -> Phrases:
    """From ``(item_id as text, text)`` rows; equal ids are one item, a null id names no item (its
    windows still hit), a null or wordless text has no window."""
    data, offsets = buffers(pa.array([t for _, t in rows], pa.large_string()))
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, ALNUM)
    hashes = word_hashes(data, starts, ends)
    vocabulary = np.unique(hashes)
    symbols = np.searchsorted(vocabulary, hashes) + 1
    items = sorted({i for i, _ in rows if i is not None})
    number = {v: k for k, v in enumerate(items)}
    counts = np.diff(first)
    lengths = np.minimum(counts, window)
    per_row = np.where(counts > 0, np.maximum(counts - window + 1, 1), 0)
    row = np.repeat(np.arange(len(rows)), per_row)
    start = first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    table = np.zeros((len(row), window), np.int32)
    for back in range(window):  # the last word is on the right
        own = np.flatnonzero(lengths[row] > back)
        table[own, window - 1 - back] = symbols[start[own] + lengths[row[own]] - 1 - back]
    # equal windows as equal byte strings: one sort, no Python object a window
    _, kept, which = np.unique(table.view(f"V{4 * window}").ravel(), return_index=True, return_inverse=True)
    owner = np.array([-1 if i is None else number[i] for i, _ in rows], np.int64)[row]
    pairs = np.unique(which.ravel()[owner >= 0] * np.int64(max(len(items), 1)) + owner[owner >= 0])
    bounds = np.searchsorted(pairs // max(len(items), 1), np.arange(len(kept) + 1))
    return Phrases(vocabulary, table[kept], lengths[row[kept]], bounds, pairs % max(len(items), 1), items)


class Lookup:
    """Numbers of fingerprints in a sorted vocabulary: one probe of a table, a search on its clashes."""

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary = vocabulary
        self.mask = np.uint64((1 << max(8, (16 * len(vocabulary)).bit_length())) - 1)
        slot = (vocabulary & self.mask).astype(np.int64)
        self.table = np.zeros(int(self.mask) + 1, np.int32)
        self.table[slot] = np.arange(len(vocabulary))
        self.clash = np.bincount(slot, minlength=len(self.table)) > 1

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """1 + place in the vocabulary, 0 for others."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int32)
        slot = (hashes & self.mask).astype(np.int64)
        at = self.table[slot]
        clash = np.flatnonzero(self.clash[slot])
        at[clash] = np.minimum(np.searchsorted(self.vocabulary, hashes[clash]), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0).astype(np.int32)


class WaveletTree:
    """rank(symbol, i): occurrences of a symbol before position i, by one bit level per step.

    Every level keeps its bits in 64-bit words with running counts; a level's sequence is the one
    above it, stably split by that level's bit.
    """

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for level in range(max(1, int(symbols).bit_length()) - 1, -1, -1):
            bit = ((sequence >> level) & 1).astype(bool)
            packed = np.zeros((len(bit) // 64 + 2) * 8, np.uint8)
            packed[: -(-len(bit) // 8)] = np.packbits(bit, bitorder="little")
            words = packed.view(np.uint64)
            before = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            zeros = len(bit) - int(before[-1])
            self.levels.append((level, words, before, zeros))
            sequence = np.concatenate([sequence[~bit], sequence[bit]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[block] + np.bitwise_count(words[block] & mask)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros_like(at), at.copy()
        for level, words, before, zeros in self.levels:
            one = ((symbol >> level) & 1).astype(bool)
            ones_lo, ones_hi = self._ones(words, before, lo), self._ones(words, before, hi)
            lo = np.where(one, zeros + ones_lo, lo - ones_lo)
            hi = np.where(one, zeros + ones_hi, hi - ones_hi)
        return hi - lo

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out, at = np.zeros_like(at), at.copy()
        for level, words, before, zeros in self.levels:
            one = ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            out |= one.astype(np.int64) << level
            ones = self._ones(words, before, at)
            at = np.where(one, zeros + ones, at - ones)
        return out


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling.  Symbol 0 stands for distinct terminators in text order, below
    all others; the text must end with one."""
    n = len(symbols)
    foreign = np.flatnonzero(symbols == 0)
    rank = np.empty(n, np.int64)
    rank[foreign] = np.arange(len(foreign))
    active = np.flatnonzero(symbols)
    # all vocabulary suffixes are one bucket at first; each round splits the buckets that are left
    key = symbols[active]
    bits, depth = 0, 1
    while len(active):
        order = np.argsort(key, kind=None if bits else "stable")  # small numbers: a radix sort
        active, key = active[order], key[order]
        place = np.arange(len(active))
        new_key = np.empty(len(active), bool)
        new_key[0] = True
        np.not_equal(key[1:], key[:-1], out=new_key[1:])
        if bits:
            base = key >> bits
            new_base = np.empty(len(active), bool)
            new_base[0] = True
            np.not_equal(base[1:], base[:-1], out=new_base[1:])
            base = base - np.maximum.accumulate(np.where(new_base, place, 0))
        else:
            base = len(foreign)
        ranks = base + np.maximum.accumulate(np.where(new_key, place, 0))
        rank[active] = ranks
        shared = ~new_key
        shared[:-1] |= ~new_key[1:]
        active = active[shared]
        bits = max(1, int(n).bit_length())
        key = (ranks[shared] << bits) | rank[active + depth]
        depth *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


class FmIndex:
    """FM-index of one shard: row ranges of phrases and the text positions of rows."""

    def __init__(self, symbols: np.ndarray, alphabet: int, sample: int = SAMPLE):
        order = suffix_order(symbols)
        last = symbols[order - 1]  # the row of position 0 wraps round to the final terminator
        self.tree = WaveletTree(last, alphabet)
        self.first_row = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet + 1))])
        self.sampled = (order % sample == 0) | (last == 0)
        self.sampled_rows = np.flatnonzero(self.sampled)
        self.samples = order[self.sampled_rows]

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of right-aligned phrases; empty where one does not occur."""
        symbol = windows[:, -1].astype(np.int64)
        lo, hi = self.first_row[symbol].copy(), self.first_row[symbol + 1].copy()
        alive = np.flatnonzero(hi > lo)
        for column in range(windows.shape[1] - 2, -1, -1):
            symbol = windows[alive, column].astype(np.int64)
            step, more = alive[symbol > 0], symbol[symbol > 0]  # a shorter phrase is complete before
            lo[step] = self.first_row[more] + self.tree.rank(more, lo[step])
            hi[step] = self.first_row[more] + self.tree.rank(more, hi[step])
            alive = alive[hi[alive] > lo[alive]]
            if not len(alive):
                break
        return lo, np.maximum(hi, lo)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to the nearest sampled row."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.sampled[at[open_]]
            ready = open_[done]
            out[ready] = self.samples[np.searchsorted(self.sampled_rows, at[ready])] + steps[ready]
            open_ = open_[~done]
            symbol = self.tree.symbol(at[open_])
            at[open_] = self.first_row[symbol] + self.tree.rank(symbol, at[open_])
            steps[open_] += 1
        return out


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges, and the range of each."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum()), which


def _lists(values: list | np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def scan_shard(phrases: Phrases, lookup: Lookup, data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """RESULT of every document of one shard."""
    docs = len(offsets) - 1
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets, ALNUM)
    number = lookup.number(word_hashes(data, starts, ends))
    n = len(number)
    covered = np.zeros(n + 1, np.int32)
    pairs = np.zeros(0, np.int64)
    if len(phrases.windows) and number.any():
        # the shard's text: one terminator for each run of foreign words, and one after each document
        keep = number > 0
        keep[1:] |= number[:-1] > 0
        keep[first[:-1][first[:-1] < n]] = True
        words = np.flatnonzero(keep)
        doc_end = np.searchsorted(words, first[1:])
        at_word = np.insert(words, doc_end, n)  # word of each text position; n at a document's end
        symbols = np.append(number, 0)[at_word].astype(np.uint16 if len(phrases.vocabulary) < 65535 else np.int32)
        index = FmIndex(symbols, len(phrases.vocabulary))
        lo, hi = index.search(phrases.windows)
        rows, window = _ranges(lo, hi)
        at = at_word[index.locate(rows)]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + phrases.lengths[window], -1)
        hit = np.unique((np.searchsorted(first, at, "right") - 1) * np.int64(len(phrases.windows)) + window)
        doc, window = hit // len(phrases.windows), hit % len(phrases.windows)
        own, which = _ranges(phrases.owner_start[window], phrases.owner_start[window + 1])
        pairs = np.unique(doc[which] * np.int64(max(len(phrases.items), 1)) + phrases.owners[own])
    inside = np.cumsum(covered[:-1]) > 0
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    inner = first[1:-1][(first[1:-1] > 0) & (first[1:-1] < n)]  # spans end with their document
    begins[inner], stops[inner - 1] = inside[inner], inside[inner - 1]
    begin, stop = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    doc = np.searchsorted(first, begin, "right") - 1
    n_spans = np.bincount(doc, minlength=docs)
    n_hit = np.bincount(doc, stop - begin, minlength=docs).astype(np.int64)
    char_begin, char_stop = np.zeros_like(begin), np.zeros_like(stop)
    for d in np.unique(doc):  # code points of the few documents that are hit
        chars = np.concatenate([[0], np.cumsum((data[offsets[d] : offsets[d + 1]] & 0xC0) != 0x80)])
        own = doc == d
        char_begin[own] = chars[starts[begin[own]] - offsets[d]]
        char_stop[own] = chars[ends[stop[own] - 1] - offsets[d]]
    doc_items, item = pairs // max(len(phrases.items), 1), pairs % max(len(phrases.items), 1)
    return pa.StructArray.from_arrays(
        [
            pa.array(np.diff(first), pa.int64()), pa.array(n_hit, pa.int64()),
            _lists([phrases.items[i] for i in item], np.bincount(doc_items, minlength=docs), pa.string()),
            _lists(begin - first[doc], n_spans, pa.int64()), _lists(stop - first[doc], n_spans, pa.int64()),
            _lists(char_begin, n_spans, pa.int64()), _lists(char_stop, n_spans, pa.int64()),
        ],
        ["n_words", "n_hit", "items", "word_starts", "word_ends", "starts", "ends"],
    )


def _shards(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` words (six bytes of text each), or one longer document."""
    return row_chunks(offsets, 6 * limit)


def scan_column(text: Column, phrases: Phrases) -> Column:
    @F.arrow_udf(RESULT)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lookup = Lookup(phrases.vocabulary)
        for texts in batches:
            data, offsets = buffers(texts)
            parts = [
                scan_shard(phrases, lookup, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                for lo, hi in _shards(offsets, SHARD_WORDS)
            ]
            yield pa.concat_arrays(parts) if parts else scan_shard(phrases, lookup, data, offsets)

    return apply(text)


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, window: int, limit: int) -> Iterator[tuple[Phrases, int]]:
    """The query set in blocks of at most about ``limit`` bytes of text (or one longer item), each with the
    number of blocks."""
    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // limit))
    for b in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        yield make_phrases([(r["item"], r["text"]) for r in part.collect()], window), blocks


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    out: str = "contamination", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with the struct column ``out``: n_words, n_hit, items (ids sorted as strings), and the
    merged removal spans in words (word_starts, word_ends) and code points (starts, ends).

    A null text has no words; an empty benchmark hits nothing; repeated documents are each scanned;
    repeated items count once; every row and column stays, an input column named ``out`` is replaced.
    """
    body = F.col(f"`{text}`")
    rows, names = docs, []
    with Scratch(docs.sparkSession, "contamination") as scratch:
        for phrases, blocks in benchmark_blocks(benchmark, item, item_text, window, block_bytes):
            if blocks == 1:
                return docs.withColumn(out, scan_column(body, phrases))
            before = rows
            names.append(free(f"{out}_{len(names)}", rows))
            rows = scratch.stage(rows.withColumn(names[-1], scan_column(body, phrases)), "pass", keep=len(names) == blocks)
            if len(names) > 1:
                scratch.drop(before)
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*(F.col(f"{n}.items") for n in names)))))

    # spans of all passes in order of their first word; those that touch or overlap become one
    parts = ("word_starts", "word_ends", "starts", "ends")
    zipped = (F.arrays_zip(*(F.col(f"{n}.{p}").alias(p) for p in parts)) for n in names)
    spans = F.array_sort(F.flatten(F.array(*zipped)))
    empty = F.array().cast("array<struct<word_starts:bigint,word_ends:bigint,starts:bigint,ends:bigint>>")

    def extend(last: Column, x: Column) -> Column:
        return F.struct(
            last["word_starts"].alias("word_starts"), F.greatest(last["word_ends"], x["word_ends"]).alias("word_ends"),
            last["starts"].alias("starts"), F.greatest(last["ends"], x["ends"]).alias("ends"),
        )

    spans = F.aggregate(spans, empty, lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["word_ends"] >= x["word_starts"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(extend(F.element_at(acc, -1), x))),
    ).otherwise(F.concat(acc, F.array(x))))
    hit = F.aggregate(spans, F.lit(0).cast("long"), lambda acc, x: acc + x["word_ends"] - x["word_starts"])
    return rows.withColumn(out, F.struct(
        F.col(f"{names[0]}.n_words").alias("n_words"), hit.alias("n_hit"), items.alias("items"), *(spans[p].alias(p) for p in parts),
    )).drop(*names)
