"""Language identification by a byte convolutional network.

Texts are cut into fixed-length byte windows.  Each byte has a learned embedding; filters of several
widths slide over a window, each keeps its maximum (max pooling, ReLU), and a softmax layer turns the
pooled features into language probabilities.  A text's probabilities are the mean over all of its
windows, so whole texts count whatever their length.

The network is trained in numpy on the driver with Adam, on a bounded sample of labelled rows
(``SAMPLE_PER_LANG`` distinct texts per language, ``SAMPLE_ROWS`` in all, ``WINDOWS_PER_TEXT`` windows
each; the smallest seeded hashes).  It is some 25 KB and travels with the task code.  Applying it is a
map over the texts: no shuffle, and rows keep their columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydrix.llm.words import buffers, row_chunks

#: Bytes of a window; the bounds of the training sample; the seed of weights and batches.
WINDOW = 128
SAMPLE_PER_LANG = 600
#: Times its sample that a language's first choice holds, and languages with such a choice.
SPARE, LARGEST = 2, 4096
SAMPLE_ROWS = 9600
WINDOWS_PER_TEXT = 3
SEED = 7
#: Network: embedding size, filter widths, filters of each width; training passes, batch, step size.
EMBED, WIDTHS, FILTERS = 8, (2, 3, 4), 12
EPOCHS, BATCH, RATE = 6, 64, 0.01

UNDETERMINED = "und"


@dataclass
class ByteCnn:
    langs: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # (widest x EMBED) x all filters; a narrower filter is zero beyond its width
    bias: np.ndarray
    dense: np.ndarray  # all filters x langs
    out_bias: np.ndarray


def _widest() -> int:
    return max(WIDTHS)


def _filter_mask() -> np.ndarray:
    mask = np.zeros((_widest() * EMBED, len(WIDTHS) * FILTERS), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[: w * EMBED, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask


def _patches(model: ByteCnn, windows: np.ndarray) -> np.ndarray:
    """(N, positions, widest x EMBED): the embedded bytes under a filter at every position."""
    n, length = windows.shape
    x = np.zeros((n, (length + _widest() - 1) * EMBED), np.float32)
    x[:, : length * EMBED] = model.embed[windows].reshape(n, -1)
    view = np.lib.stride_tricks.sliding_window_view(x, _widest() * EMBED, axis=1)[:, ::EMBED]
    return np.ascontiguousarray(view)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _pool(model: ByteCnn, patches: np.ndarray) -> np.ndarray:
    n, positions, width = patches.shape
    return (patches.reshape(-1, width) @ model.filters).reshape(n, positions, -1)


def window_probabilities(model: ByteCnn, windows: np.ndarray) -> np.ndarray:
    """(N, langs) softmax output for windows of bytes (shorter ones padded with zeros)."""
    parts = []
    for i in range(0, len(windows), 256):  # the activations of a few hundred windows fit the cache
        pooled = _pool(model, _patches(model, windows[i : i + 256])).max(axis=1) + model.bias
        parts.append(_softmax(np.maximum(pooled, 0) @ model.dense + model.out_bias))
    return np.concatenate(parts) if parts else np.zeros((0, len(model.langs)))


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], seed: int = SEED, epochs: int = EPOCHS) -> ByteCnn:
    """Adam on the cross-entropy; every language weighs the same whatever its share of the sample."""
    rng = np.random.default_rng(seed)
    mask = _filter_mask()
    model = ByteCnn(
        langs, rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        (rng.normal(0, 1, mask.shape) / np.sqrt(mask.sum(axis=0))).astype(np.float32) * mask,
        np.zeros(mask.shape[1], np.float32),
        rng.normal(0, 0.1, (mask.shape[1], len(langs))).astype(np.float32), np.zeros(len(langs), np.float32),
    )
    share = np.bincount(labels, minlength=len(langs)) / max(len(labels), 1)
    weight = (1 / np.maximum(share, 1e-9) / len(langs))[labels].astype(np.float32)
    names = ("embed", "filters", "bias", "dense", "out_bias")
    first = {k: np.zeros_like(getattr(model, k)) for k in names}
    second = {k: np.zeros_like(getattr(model, k)) for k in names}
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // BATCH)):
            if not len(rows):
                continue
            x, y = windows[rows], labels[rows]
            patches = _patches(model, x)
            maps = _pool(model, patches)
            at = maps.argmax(axis=1)  # rows x filters: the position that wins the pooling
            pooled = np.take_along_axis(maps, at[:, None], 1)[:, 0] + model.bias
            hidden = np.maximum(pooled, 0)
            g = _softmax(hidden @ model.dense + model.out_bias)
            g[np.arange(len(y)), y] -= 1
            g *= (weight[rows] / len(y))[:, None]
            gh = (g @ model.dense.T) * (pooled > 0)
            won = patches[np.arange(len(x))[:, None], at]  # rows x filters x patch
            g_embed = np.zeros_like(model.embed)
            spread = (gh[:, :, None] * model.filters.T[None]).reshape(len(x), -1, _widest(), EMBED)
            padded = np.concatenate([x, np.zeros((len(x), _widest() - 1), np.uint8)], axis=1)
            bytes_at = padded[np.arange(len(x))[:, None, None], at[:, :, None] + np.arange(_widest())]
            np.add.at(g_embed, bytes_at.reshape(-1), spread.reshape(-1, EMBED))
            grads = {
                "embed": g_embed, "filters": np.einsum("nf,nfw->wf", gh, won) * mask, "bias": gh.sum(0),
                "dense": hidden.T @ g, "out_bias": g.sum(0),
            }
            step += 1
            for k in names:
                first[k] += 0.1 * (grads[k] - first[k])
                second[k] += 0.001 * (grads[k] ** 2 - second[k])
                lr = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                setattr(model, k, getattr(model, k) - (lr * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32))
    return model


def training_sample(
    docs: DataFrame, text: str = "text", lang: str = "lang", per_lang: int = SAMPLE_PER_LANG, rows: int = SAMPLE_ROWS,
    per_text: int = WINDOWS_PER_TEXT, seed: int = SEED,
) -> DataFrame:
    """``(lang, windows)``: byte windows of a bounded, reproducible sample of the labelled texts.

    Copies of a text count once.  The windows lie evenly over a text; only they leave the executors,
    never whole texts.  A language's sample is its texts of the smallest hashes.  A first, narrow pass counts
    a language's distinct texts, and only hashes below a share that holds about ``SPARE`` times the sample
    go on, so that ranking a language sees a bounded number of rows whatever its size.
    """
    raw = F.col(f"`{text}`").cast("binary")
    size = F.octet_length(raw)
    starts = [F.greatest(F.lit(0), F.floor((size - WINDOW) * ((2 * i + 1) / (2 * per_text)))) for i in range(per_text)]
    cuts = F.array(*(F.substring(raw, (s + 1).cast("int"), F.lit(WINDOW)) for s in starts))
    hashed = F.xxhash64(F.lit(seed), raw)
    some = docs.where(F.col(f"`{lang}`").isNotNull() & (size > 0))
    sizes = some.groupBy(F.col(f"`{lang}`").alias("lang")).agg(F.approx_count_distinct(hashed).alias("texts"))
    share = F.least(F.lit(1.0), F.lit(float(SPARE * per_lang)) / F.col("texts"))
    # hashes are spread evenly over the 64-bit range; beyond the largest languages all texts are few
    below = (share * F.lit(2.0**64) - F.lit(2.0**63)).alias("below")
    largest = sizes.orderBy(F.col("texts").desc(), "lang").limit(LARGEST).select("lang", below)
    labelled = some.select(F.col(f"`{lang}`").alias("lang"), cuts.alias("windows"), hashed.alias("__h"))
    labelled = labelled.join(F.broadcast(largest), "lang", "left")
    labelled = labelled.where(F.col("below").isNull() | (F.col("__h") <= F.col("below"))).drop("below")
    distinct = labelled.groupBy("lang", "__h").agg(F.min("windows").alias("windows"))  # each task sends a text once
    best = Window.partitionBy("lang").orderBy("__h")  # a rank limit: each task keeps per_lang rows
    ranked = distinct.withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= per_lang)
    return ranked.orderBy("__r", "lang").limit(rows).select("lang", "windows")


def _pad(cut: bytes) -> np.ndarray:
    return np.frombuffer(cut.ljust(WINDOW, b"\0")[:WINDOW], np.uint8)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", seed: int = SEED, **bounds) -> ByteCnn | None:
    """The trained network; None where no row has both a label and a text."""
    sample = training_sample(docs, text, lang, seed=seed, **bounds).collect()
    langs = sorted({r["lang"] for r in sample})
    if not langs:
        return None
    index = {v: i for i, v in enumerate(langs)}
    pairs = sorted({(index[r["lang"]], bytes(w)) for r in sample for w in r["windows"]})
    windows = np.stack([_pad(w) for _, w in pairs])
    return train(windows, np.array([i for i, _ in pairs]), langs, seed)


_ASCII_LETTER = re.compile(r"[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text))


def letters(text: Column) -> Column:
    """Boolean column: ``has_letter``, by which ``language`` tells a language from ``und``."""

    @F.arrow_udf("boolean")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([has_letter(t) for t in texts.to_pylist()], pa.bool_())

    return apply(text)


def _windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts and the row of each; a text's last window is padded with zeros."""
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (offsets[:-1][row] + nth * WINDOW)[:, None] + np.arange(WINDOW)
    inside = at < offsets[1:][row][:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))], 0).astype(np.uint8), row


def predict(model: ByteCnn, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text: the mean of its windows' probabilities."""
    data, offsets = buffers(texts)
    names, scores = [], []
    for lo, hi in row_chunks(offsets):
        offs = offsets[lo : hi + 1] - offsets[lo]
        mean = np.zeros((hi - lo, len(model.langs)))
        windows, row = _windows_of(data[offsets[lo] : offsets[hi]], offs)
        if len(row):
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            mean[row[starts]] = np.add.reduceat(window_probabilities(model, windows).astype(np.float64), starts, axis=0)
            mean /= np.maximum(np.bincount(row, minlength=hi - lo), 1)[:, None]
        best = mean.argmax(axis=1)
        for i, t in enumerate(texts.slice(lo, hi - lo).to_pylist()):
            known = has_letter(t)
            names.append(model.langs[best[i]] if known else UNDETERMINED)
            scores.append(min(1.0, float(mean[i, best[i]])) if known else 0.0)
    return names, np.array(scores)


def language(text: Column, model: ByteCnn | None) -> Column:
    """Struct column (lang, score).  ``und`` with score 0 for a null text, one without any letter, or
    when there was nothing to learn from."""
    if model is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))

    @F.arrow_udf("struct<lang:string,score:double>")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            names, scores = predict(model, texts)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return apply(text)


def identify(docs: DataFrame, model: ByteCnn | None, text: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with the struct column ``out`` (lang, score); every row and column stays, an input
    column named ``out`` is replaced, repeated rows are judged alike, an empty table stays empty."""
    return docs.withColumn(out, language(F.col(f"`{text}`"), model))
