"""Language-model scoring by deleted interpolation.

p(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1), where b buckets the context v by
its frequency (powers of two) and the weights l(b) come from expectation-maximisation on held-out
counts: every training token is predicted from the counts without itself.

The texts are tokenised once into *groups* (about ``GROUP_BYTES`` of text, or one longer text), each a
row of packed arrays in the shared scratch folder.  A group asks for the training counts of its distinct
words and word pairs, so a frequent word is one entry per group whatever its count.

Requests go as sorted blocks of fingerprints through levels of *nodes*.  A node owns one of ``fan`` times as
many fingerprint ranges as the level before had, and takes the blocks of about ``fan`` nodes (or groups) of the
range around it; it adds them up and asks on for the sums.  The nodes of the last level see all groups, so
their sums are the counts, and answers go back the same way, each in the order of its request.  A block is
one of at most ``FAN`` that a node sends, so blocks, entries and work grow with the number of groups, and
levels with its logarithm: one to some 3 GB of text, two to 0.8 TB, three to 200 TB.

EM sees a fixed grid of (bucket, p2/p0, p1/p0) cells, counted over all training tokens.  Nothing but that
grid, the totals N and V and the numbers of groups and tokens reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydrix.llm.words import LOWER, NOT_BLANK, buffers, mix, release_memory, row_chunks, seeds, word_hashes, word_spans
from hydrix.session import Scratch

#: Bytes of text of a group; tokens whose requests a node of the last level adds up; the most ranges into which a
#: group or node splits its requests.
GROUP_BYTES, PART_TOKENS, FAN = 6 << 20, 2 << 20, 256
#: Frequency buckets of contexts (one per power of two of a 64-bit count); EM grid cells per factor of two, and factors of two covered (half of
#: them above 1: a ratio is at most V + 1 and at least (V + 1) / N, both within 2^64).
BUCKETS, STEPS, OCTAVES = 64, 2, 128
EM_ROUNDS, FLOOR = 60, 1e-6
ADDED = 0.1  # fixed value: the base score's added count

_U = np.uint64
END = seeds(1, 21)
_LEFT, _RIGHT = seeds(2, 22) | _U(1)


def _pack(values: np.ndarray) -> bytes:
    """Bytes by significance, so that the mostly equal high bytes compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unpack(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _pack_counts(counts: np.ndarray) -> bytes:
    """A byte with the item size that all of the counts fit, then the counts packed."""
    kind = np.min_scalar_type(int(counts.max(initial=0)))
    return bytes([kind.itemsize]) + _pack(counts.astype(kind))


def _unpack_counts(blob: bytes) -> np.ndarray:
    return _unpack(memoryview(blob)[1:], f"u{blob[0]}").astype(np.int64)


def tokenised(id_type: pa.DataType):
    """Groups of whole texts: distinct word fingerprints, tokens as places in them, row bounds."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            held = np.array(batch.column("held_out"), bool)
            for lo, hi in row_chunks(offsets, GROUP_BYTES):
                parts, sizes = [], []
                for a, b in row_chunks(offsets[lo : hi + 1] - offsets[lo]):
                    own = offsets[lo + a : lo + b + 1] - offsets[lo + a]
                    text = LOWER[data[offsets[lo + a] : offsets[lo + b]]]
                    starts, ends, first = word_spans(text, own, NOT_BLANK)
                    parts.append(np.insert(word_hashes(text, starts, ends), first[1:], END[0]))
                    sizes.append(np.diff(first) + 1)
                words, tokens = np.unique(np.concatenate(parts), return_inverse=True)
                parts.clear()
                bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(task << 32) | count], pa.int64()), pa.array([len(tokens)], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column("doc_id").slice(lo, hi - lo).cast(id_type)),
                        pa.array([held[lo:hi].tobytes()], pa.binary()), pa.array([_pack(bounds)], pa.binary()),
                        pa.array([_pack(words)], pa.binary()), pa.array([_pack(tokens.astype(np.uint32))], pa.binary()),
                    ],
                    ["gid", "n_tokens", "doc_ids", "held", "bounds", "words", "tokens"],
                )
                count += 1
                del words, tokens, bounds
                release_memory()

    return apply


def _pairs(words: np.ndarray, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint of context and word, context token) at each token; a text begins after an end."""
    end = np.searchsorted(words, END[0])
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = end
    pair = words[before]
    pair *= _LEFT
    pair += words[tokens] * _RIGHT
    return mix(pair), before


def _train_mask(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """(whether each token is for training, row bounds)."""
    bounds = _unpack(row["bounds"], np.int64)
    return np.repeat(~np.frombuffer(row["held"], bool), np.diff(bounds)), bounds


def exchange_shape(parts: int) -> tuple[int, int]:
    """(levels, fan): the fewest levels with at most ``FAN`` ranges a node, and the least fan for ``parts`` ranges."""
    levels, fan = 1, 1
    while FAN**levels < parts:
        levels += 1
    while fan**levels < parts:
        fan += 1
    return levels, fan


def _split(keys: np.ndarray, ranges: range, total: int) -> np.ndarray:
    """Bounds of (sorted) fingerprints in successive ranges of the ``total`` equal ones."""
    edges = np.array([(r << 64) // total for r in ranges[1:]], dtype=_U)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


ASKED = "part bigint, gid bigint, w binary, nw binary, p binary, np binary"


def _blocks(gid: int, words, word_counts, pairs, pair_counts, ranges: range, total: int, bundles: int, bundle: int) -> dict[str, list]:
    """A request's rows (columns of ``ASKED``): its keys and counts by range, to the node of each range and the bundle."""
    w, p = _split(words, ranges, total), _split(pairs, ranges, total)
    out: dict[str, list] = {c: [] for c in ("part", "gid", "w", "nw", "p", "np")}
    for k, r in enumerate(ranges):
        if w[k + 1] > w[k] or p[k + 1] > p[k]:
            own, pair = slice(w[k], w[k + 1]), slice(p[k], p[k + 1])
            values = (r * bundles + bundle, gid, _pack(words[own]), _pack(word_counts[own]), _pack(pairs[pair]), _pack(pair_counts[pair]))
            for c, v in zip(out.values(), values):
                c.append(v)
    return out


def requests(fan: int, bundles: int = 1):
    """Each group's distinct words and pairs with its own training counts, a row per range of the first level."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a row is a whole group: one at a time
                row = {c: batch.column(c)[i].as_py() for c in ("gid", "held", "bounds", "words", "tokens")}
                words, tokens = _unpack(row["words"], _U), _unpack(row["tokens"], np.uint32)
                train, bounds = _train_mask(row)
                pair = _pairs(words, tokens, bounds)[0]
                order = np.argsort(pair)
                ordered = pair[order]
                del pair
                first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
                pair_counts = np.add.reduceat(train[order], first, dtype=np.uint32)  # the sum's own type is wider
                word_counts = np.bincount(tokens[train], minlength=len(words)).astype(np.uint32)
                pairs = ordered[first]
                del order, ordered, first
                bundle = int(mix(np.array([row["gid"]], np.int64).view(_U))[0] % _U(bundles))
                columns = _blocks(row["gid"], words, word_counts, pairs, pair_counts, range(fan), fan, bundles, bundle)
                kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
                asked = [pa.array(c, t) for c, t in zip(columns.values(), kinds)]
                del row, words, tokens, train, pairs, pair_counts, columns
                release_memory()
                yield pa.RecordBatch.from_arrays(asked, ["part", "gid", "w", "nw", "p", "np"])
                del asked

    return apply


def _counts_of(blob: bytes, keys: bytes) -> np.ndarray:
    """A block's counts; their width follows from the number of its keys."""
    return _unpack(blob, f"u{len(blob) * 8 // len(keys)}") if len(keys) else np.zeros(0, np.uint32)


def _added(keys: pd.Series, counts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of several blocks, sorted, and their summed counts in the least width that holds them."""
    flat = np.concatenate([_unpack(b, _U) for b in keys])
    n = np.concatenate([_counts_of(b, k) for b, k in zip(counts, keys)])
    order = np.argsort(flat)
    flat, n = flat[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])[: len(flat)])
    sums = np.add.reduceat(n, first, dtype=np.uint64) if len(first) else np.zeros(0, _U)
    return flat[first], sums.astype(np.min_scalar_type(int(sums.max(initial=0))))


def merged(level: int, fan: int, bundles: int, above: int):
    """A node of a level before the last (``bundles`` a range): what its blocks hold together, as requests to the
    nodes of its ``fan`` finer ranges (``above`` bundles a range)."""

    def apply(part: pd.DataFrame) -> pd.DataFrame:
        node = int(part["part"].iloc[0])
        own, bundle = divmod(node, bundles)
        words, pairs = _added(part["w"], part["nw"]), _added(part["p"], part["np"])
        release_memory()
        ranges = range(own * fan, (own + 1) * fan)
        return pd.DataFrame(_blocks(node, *words, *pairs, ranges, fan ** (level + 1), above, bundle * above // bundles))

    return apply


def handed_down(asked: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
    """A node's answers to each of its requests, from those to its own."""
    asked, replies = asked.sort_values("gid"), replies.sort_values("above")
    out = {"gid": asked["gid"].to_numpy(), "part": asked["part"].to_numpy()}
    for name, keys in (("cw", "w"), ("cp", "p")):
        blocks = [_unpack(b, _U) for b in asked[keys]]
        bounds = np.cumsum([len(b) for b in blocks])[:-1]
        _, place = np.unique(np.concatenate(blocks), return_inverse=True)
        blocks.clear()
        total = np.concatenate([_unpack_counts(b) for b in replies[name]])
        out[name] = [_pack_counts(x) for x in np.split(total[place], bounds)]
    release_memory()
    return pd.DataFrame(out)


def _totals(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], int, int]:
    """Each request's keys' summed counts; the sum and the number of keys that have any."""
    bounds = np.cumsum([len(k) for k in keys])[:-1]
    flat, n = np.concatenate(keys), np.concatenate(counts)
    keys.clear()
    counts.clear()
    order = np.argsort(flat)
    flat, n = flat[order], n[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])[: len(flat)]
    del flat
    first = np.flatnonzero(new)
    sums = np.add.reduceat(n, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    answer = np.empty(len(n), np.int64)
    del n
    answer[order] = np.repeat(sums, np.diff(np.append(first, len(new))))
    return np.split(answer, bounds), int(sums.sum()), int(np.count_nonzero(sums))


def answers(part: pd.DataFrame) -> pd.DataFrame:
    """A node of the last level: training counts for every request, and its range's totals on its first row."""
    part = part.sort_values("gid")
    words, n, v = _totals([_unpack(b, _U) for b in part["w"]], [_counts_of(b, k) for b, k in zip(part["nw"], part["w"])])
    pairs, _, _ = _totals([_unpack(b, _U) for b in part["p"]], [_counts_of(b, k) for b, k in zip(part["np"], part["p"])])
    release_memory()
    return pd.DataFrame({
        "gid": part["gid"].to_numpy(), "part": part["part"].to_numpy(), "cw": [_pack_counts(x) for x in words],
        "cp": [_pack_counts(x) for x in pairs],
        "n": [n] + [0] * (len(part) - 1), "v": [v] + [0] * (len(part) - 1),
    })


def bucket_of(context_counts: np.ndarray) -> np.ndarray:
    """Frequency bucket of a context: 0 for an unseen one, then one per power of two."""
    return np.minimum(np.ceil(np.log2(context_counts.astype(np.float64) + 1)).astype(np.int64), BUCKETS - 1)


def _grid(ratio: np.ndarray) -> np.ndarray:
    """Grid place of a probability over p0: 0 for none."""
    with np.errstate(divide="ignore"):
        step = np.floor(np.log2(ratio) * STEPS)
    return np.where(ratio > 0, np.clip(step, -STEPS * OCTAVES // 2, STEPS * OCTAVES - STEPS * OCTAVES // 2 - 1) + STEPS * OCTAVES // 2 + 1, 0).astype(np.int64)


_SIDE = STEPS * OCTAVES + 1


def _ratios(cells: np.ndarray) -> np.ndarray:
    return np.where(cells > 0, 2.0 ** ((cells - 1 - STEPS * OCTAVES // 2 + 0.5) / STEPS), 0.0)


def joined(n_train: int, n_types: int):
    """A group with its answers: counts of its words and of the pair at each token, and its EM cells."""

    def apply(groups: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        row = groups.iloc[0].to_dict()
        replies = replies.sort_values("part")
        words, tokens = _unpack(row["words"], _U), _unpack(row["tokens"], np.uint32)
        train, bounds = _train_mask(row)
        pair, before = _pairs(words, tokens, bounds)
        _, place = np.unique(pair, return_inverse=True)
        cw = np.concatenate([_unpack_counts(b) for b in replies["cw"]])
        cp = np.concatenate([_unpack_counts(b) for b in replies["cp"]])[place]
        # held-out counts: each training token without itself
        c2, c1, cv = (x[train].astype(np.float64) - 1 for x in (cp, cw[tokens], cw[before]))
        p0 = 1 / (n_types + 1)
        p2 = np.where(cv > 0, c2 / np.maximum(cv, 1), 0)
        p1 = c1 / max(n_train - 1, 1)
        cell = (bucket_of(cv) * _SIDE + _grid(p2 / p0)) * _SIDE + _grid(p1 / p0)
        cells, n = np.unique(cell, return_counts=True)
        del train, pair, before, place, c2, c1, cv, p2, p1, cell
        release_memory()
        return pd.DataFrame({
            "doc_ids": [row["doc_ids"]], "held": [row["held"]], "bounds": [row["bounds"]], "tokens": [row["tokens"]],
            "end": [int(np.searchsorted(words, END[0]))], "cw": [_pack_counts(cw)], "cp": [_pack_counts(cp)], "cells": [cells], "cell_counts": [n],
        })

    return apply


def learn_weights(cells: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(BUCKETS, 3) mixture weights (pair, word, uniform) by EM on the counted cells."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    bucket, pair, word = cells // _SIDE**2, cells // _SIDE % _SIDE, cells % _SIDE
    for b in range(BUCKETS):
        own = bucket == b
        n = counts[own].astype(np.float64)
        if not n.sum():
            continue
        parts = np.stack([_ratios(pair[own]), _ratios(word[own]), np.ones(len(n))], axis=1)
        for _ in range(EM_ROUNDS):
            mixed = parts * weights[b]
            weights[b] = (n[:, None] * mixed / mixed.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
            weights[b] = np.maximum(weights[b], FLOOR) / np.maximum(weights[b], FLOOR).sum()
    return weights


def scored(id_type: pa.DataType, weights: np.ndarray, n_train: int, n_types: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                release_memory()
                row = {c: batch.column(c)[i].as_py() for c in ("held", "bounds", "tokens", "end", "cw", "cp")}
                ids = batch.column("doc_ids")[i].values
                bounds, tokens = _unpack(row["bounds"], np.int64), _unpack(row["tokens"], np.uint32)
                cw, c2 = _unpack_counts(row["cw"]).astype(np.float64), _unpack_counts(row["cp"])
                before = np.empty_like(tokens)
                before[1:] = tokens[:-1]
                before[bounds[:-1]] = row["end"]
                c1, cv = cw[tokens], cw[before]
                mix_ = weights[bucket_of(cv)]
                p = mix_[:, 0] * np.where(cv > 0, c2 / np.maximum(cv, 1), 0) + mix_[:, 1] * c1 / max(n_train, 1) + mix_[:, 2] / (n_types + 1)
                base = np.log10((c1 + ADDED) / (n_train + ADDED * (n_types + 1)))
                at = bounds[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.cast(id_type), pa.array(np.frombuffer(row["held"], bool)), pa.array(np.diff(bounds), pa.int64()),
                        pa.array(np.add.reduceat((c1 > 0).astype(np.int64), at), pa.int64()),
                        pa.array(np.full(len(at), n_train), pa.int64()),
                        pa.array(np.add.reduceat(base, at), pa.float64()), pa.array(np.add.reduceat(np.log10(p), at), pa.float64()),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return apply


def training_counts(groups: DataFrame, scratch: Scratch) -> tuple[DataFrame, int, int]:
    """``(replies, N, V)``: to each group (gid) the training counts of its words and pairs, a row per range of the
    first level (part), in the order of its request; training tokens; distinct words in them."""
    n_groups, tokens = groups.agg(F.count(F.lit(1)), F.sum("n_tokens")).first()
    levels, fan = exchange_shape(max(1, -(-(tokens or 0) // PART_TOKENS)))
    # bundles of a range at each level: one at the last
    bundles = [max(1, -(-n_groups // fan**level)) for level in range(1, levels)] + [1]
    asked = groups.select("gid", "held", "bounds", "words", "tokens").mapInArrow(requests(fan, bundles[0]), ASKED)
    # the groups' requests, the largest table, are made again for the way back instead of being kept
    waiting, staged = [], []
    for level in range(1, levels):
        waiting.append(asked)
        asked = asked.groupBy("part").applyInPandas(merged(level, fan, bundles[level - 1], bundles[level]), ASKED)
        asked = scratch.stage(asked, f"asked-{level + 1}")
        staged.append(asked)
    replies = asked.groupBy("part").applyInPandas(answers, "gid bigint, part bigint, cw binary, cp binary, n bigint, v bigint")
    replies = scratch.stage(replies, "replies")
    n_train, n_types = (x or 0 for x in replies.agg(F.sum("n"), F.sum("v")).first())
    while waiting:
        own = waiting.pop()
        scratch.drop(staged.pop())
        given = replies.select(F.col("gid").alias("part"), F.col("part").alias("above"), "cw", "cp")
        lower = own.select("part", "gid", "w", "p").groupBy("part").cogroup(given.groupBy("part")).applyInPandas(
            handed_down, "gid bigint, part bigint, cw binary, cp binary"
        )
        lower = scratch.stage(lower, "handed-down")
        scratch.drop(replies)
        replies = lower
    return replies, n_train, n_types


def score_texts(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    ``held_out``: boolean column of ``docs``; the model learns from the other rows.  A null text is
    empty: it has the end token alone.  Repeated rows are scored alike, and each counts in training.
    Without training rows every weight is on equal parts and words are unknown.  An empty table gives
    an empty result; extra columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[key].dataType
    id_type, ddl = to_arrow_type(kind), kind.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    with Scratch(docs.sparkSession, "lm") as scratch:
        groups = scratch.stage(rows.mapInArrow(
            tokenised(id_type),
            f"gid bigint, n_tokens bigint, doc_ids array<{ddl}>, held binary, bounds binary, words binary, tokens binary",
        ), "groups")
        replies, n_train, n_types = training_counts(groups, scratch)
        both = groups.groupBy("gid").cogroup(replies.select("gid", "part", "cw", "cp").groupBy("gid")).applyInPandas(
            joined(n_train, n_types),
            f"doc_ids array<{ddl}>, held binary, bounds binary, tokens binary, end bigint, cw binary, cp binary, "
            "cells array<bigint>, cell_counts array<bigint>",
        )
        counted = scratch.stage(both, "counted", keep=True)
        grid = counted.select(F.explode(F.arrays_zip("cells", "cell_counts")).alias("c")).groupBy("c.cells").agg(F.sum("c.cell_counts").alias("n"))
        grid = grid.collect()  # occupied cells: at most BUCKETS x (STEPS x log2(N) + 2)^2 for N training tokens
    weights = learn_weights(np.array([r["cells"] for r in grid], np.int64), np.array([r["n"] for r in grid], np.int64))
    return counted.drop("cells", "cell_counts").mapInArrow(
        scored(id_type, weights, n_train, n_types),
        f"doc_id {ddl}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    )
