"""Byte-level text kernels (numpy) that the operators run inside Spark tasks.

Texts of an Arrow batch are handled as one UTF-8 byte buffer with row offsets, so words, their
64-bit fingerprints and word n-grams come from a few vectorised passes, whatever the text lengths.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that a kernel handles at once; one longer text is handled alone.
CHUNK_BYTES = 1 << 20
#: Bytes whose 64-bit intermediates fit a core's cache.
BLOCK_BYTES = 1 << 16

_U = np.uint64


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release_memory() -> None:
    """Gives freed memory back to the system: a reused Python worker otherwise keeps its last task's peak."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), elementwise; a bijection."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def seeds(n: int, stream: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values of a numbered stream."""
    return mix((np.arange(1, n + 1, dtype=_U) + _U(stream << 32)) * _U(0x9E3779B97F4A7C15))


def lower_table() -> np.ndarray:
    """Byte map that lower-cases A-Z and leaves every other byte."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()
#: Words ``[^\x20\x09-\x0D]+``: bytes that are not ASCII blanks.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, a-z and all non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_BYTE_CODE = seeds(256, 1)
_P = _U(0x9E3779B97F4A7C15 | 1)
_P_INV = _U(pow(int(_P), -1, 1 << 64))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^0..P^n and its inverse powers modulo 2^64, kept for the next chunk."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, 2 * BLOCK_BYTES)
        tables = []
        for base in (_P, _P_INV):
            t = np.full(size, base, _U)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers[0], _powers[1]


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offs = offs.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``limit`` bytes together, or one longer text."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words; row d has words first[d]..first[d+1]-1."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = word_bytes[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < len(data)]
    begins[row_starts] = inside[row_starts]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    row_ends = offsets[1:][offsets[1:] > 0] - 1
    stops[row_ends] = inside[row_ends]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the words: a polynomial over byte codes, finalised with the length.

    Computed over blocks of words that fit the cache.
    """
    out = np.empty(len(starts), _U)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK_BYTES, "right")))
        begin, stop = starts[lo], ends[hi - 1]
        power, inverse = _power_tables(int(stop - begin))
        total = np.zeros(stop - begin + 1, _U)
        np.cumsum(_BYTE_CODE[data[begin:stop]] * power[: stop - begin], out=total[1:])
        s, e = starts[lo:hi] - begin, ends[lo:hi] - begin
        out[lo:hi] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(_U) * _U(0xD6E8FEB86659FD93))
        lo = hi
    return out


_GRAM = seeds(64, 2) | _U(1)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the ``n`` words from each position; the last n-1 positions have none."""
    if len(words) < n:
        return np.zeros(0, _U)
    out = words[: len(words) - n + 1] * _GRAM[0]
    for j in range(1, n):
        out += words[j : len(words) - n + 1 + j] * _GRAM[j]
    return mix(out)
