"""Vector codes: the pivot search against full search, the operator against plain loops, odd vectors."""

import hashlib
import math
import random

import numpy as np
import pytest

from hydrix.llm import queries
from hydrix.llm.vector_codes import choose_pivots, compress_vectors, distances, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("seed", range(6))
def test_pivot_search_is_exact_and_prunes(seed):
    rng = np.random.default_rng(seed)
    centers = rng.integers(-4000, 4000, (16, 8))
    rows = centers[rng.integers(0, 16, 3000)] + rng.integers(-200 if seed % 2 else -2, 3, (3000, 8))
    entries = centers.copy()
    entries[7] = entries[3]  # a tie goes to the lower index
    pivots = choose_pivots(entries)
    which, best, tried = nearest(rows, distances(rows, pivots).astype(np.float32).astype(np.float64), entries, distances(entries, pivots).T)
    full = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (which == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
    assert tried < rows.shape[0] * len(entries) // 2


def test_pivot_search_with_equal_and_huge_values():
    rows = np.array([[0, 0], [1 << 28, -(1 << 28)], [5, 5]])
    entries = np.array([[5, 5], [5, 5], [0, 0], [1 << 28, 1 << 28]])
    for k in (1, 4):
        pivots = choose_pivots(entries, k)
        which, best, _ = nearest(rows, distances(rows, pivots).astype(np.float32).astype(np.float64), entries, distances(entries, pivots).T)
        full = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert which.tolist() == full.argmin(axis=1).tolist() and best.tolist() == full.min(axis=1).tolist()


def plain_version(rows):
    kept = [(i, v, y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    length = max((len(v) for _, v, _ in kept), default=0)
    w = -(-length // 8)
    cut = []
    for _, v, _ in kept:
        x = [math.floor(4096 * float(np.float32(c))) for c in v] + [0] * (8 * w - len(v))
        cut.append([x[p * w : p * w + w] for p in range(8)])
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0], [float(np.float32(c)) for c in kept[i][1]]))[:16]
    books = [[list(cut[i][p]) for i in first] for p in range(8)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], e)), k) for k, e in enumerate(books[p])) for p in range(8)] for x in cut]

    for _ in range(6):
        found = assign()
        for p in range(8):
            for k in range(len(books[p])):
                own = [cut[i][p] for i in range(len(cut)) if found[i][p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    label = {}
    for (_, _, y), e in zip(kept, errors):
        label[y] = label.get(y, 0) + e
    return sorted(
        ((i, "".join(f"{k:02x}" for _, k in f), e, label[y], digest) for (i, _, y), f, e in zip(kept, found, errors)), key=str
    )


def by_query(spark, rows, tmp_path, schema=SCHEMA):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{path}/embeddings.parquet")
    found = queries.op13_vector_codes(spark, path).collect()
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found), key=str)


def test_random_vectors(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i * 3, [rng.gauss(0, 0.2) + (i % 7) * 0.1 for _ in range(24)], i % 3 or None) for i in range(400)]
    assert by_query(spark, rows, tmp_path) == plain_version(rows)


def test_odd_vectors(spark, tmp_path):
    rng = random.Random(6)
    v = lambda n=16: [rng.uniform(-1, 1) for _ in range(n)]
    same = v()
    rows = [(9, None, 1), (8, [None] * 16, 1), (7, [float("nan")] + v(15), 1), (6, [float("inf")] + v(15), 2), (5, [0.0] * 16, None),
            (4, same, 2), (4, same, 2), (4, v(), 3), (None, v(), None), (3, [], 1), (2, v(5), 1), (1, v(13), 2)]
    assert by_query(spark, rows, tmp_path) == plain_version(rows)  # fewer rows than entries, ties, short vectors


def test_copies_fill_the_codebook(spark, tmp_path):
    rng = random.Random(8)
    hot = [rng.uniform(-1, 1) for _ in range(8)]
    rows = [(i, hot if i < 20 or i % 3 else [rng.uniform(-1, 1) for _ in range(8)], 1) for i in range(300)]
    assert by_query(spark, rows, tmp_path) == plain_version(rows)  # unused entries stay, ties go to the lowest


def test_empty_tables_and_other_columns(spark, tmp_path):
    assert by_query(spark, [], tmp_path) == []
    assert by_query(spark, [(1, None, 1), (2, [None], None)], tmp_path / "b") == []
    only_empty = by_query(spark, [(1, [], 1), (2, [], 1)], tmp_path / "c")
    assert [(r[0], r[1], r[2], r[3]) for r in only_empty] == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]
    wide = spark.createDataFrame([(1, [0.5] * 8, 2, 3, "x")], "vec_id long, embedding array<double>, label int, vector int, made string")
    rows, books = compress_vectors(wide)
    assert [tuple(r) for r in rows.collect()] == [(1, 2, "00" * 8, 0)] and books.entries.shape == (8, 1, 1)
    with pytest.raises(ValueError):
        compress_vectors(wide, entries=300)


def test_extreme_components_stay_within_a_long(spark):
    table = spark.createDataFrame([(i, [3e38 * (-1) ** i] * 64, 1) for i in range(20)], SCHEMA)
    rows, _ = compress_vectors(table)
    assert rows.where("error < 0").count() == 0 and rows.count() == 20
