"""Near-duplicate operators (MinHash join, embeddings, repeated strings) against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

import brute
from hydrix.llm import bucket_pointer, embed_dedup, minhash_join, words
from hydrix.llm.components import connected_components
from hydrix.session import Scratch

DOCS = "doc_id bigint, text string, cls bigint, text_ string"


def corpus(seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["é", "Ünï"]
    base = [" ".join(rng.choices(vocab, k=rng.choice([3, 8, 60, 200]))) for _ in range(25)]
    texts = [None, "", " \t\n", "one", "ONE", "two words here", *base]
    hub = rng.choices(vocab, k=120)
    for i in range(60):  # edited copies of one text, some too far from it
        w = list(hub)
        for _ in range(rng.choice([1, 2, 3, 5, 8])):
            w[rng.randrange(len(w))] = f"edit{i}"
        texts.append(" ".join(w))
    for t in base[:10]:
        texts += [t, t.upper(), t + " tail", t.replace(" ", "\n", 3)]
    texts.append(" ".join(rng.choices(vocab, k=20_000)))
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_minhash_matches_brute_force(spark, rows):
    extra = [(None, rows[9][1]), (rows[3][0], rows[3][1]), (None, "only here without an id")]
    rows = rows + extra
    got = minhash_join.near_duplicate_classes(frame(spark, rows)).collect()
    want = sorted(brute.near_duplicates(rows), key=repr)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_drop_near_duplicates_keeps_one_row_per_group(spark, rows):
    doubled = rows + [rows[4], rows[10], rows[10]]
    df = frame(spark, doubled)
    kept = minhash_join.drop_near_duplicates(df)
    assert kept.columns == df.columns
    want = [d for d, n, c in brute.near_duplicates(rows) if d == c]
    blank = [d for d, n, _ in brute.near_duplicates(doubled) if n == 0]
    assert sorted(r.doc_id for r in kept.collect()) == sorted([d for d in want if d not in blank] + blank)


def test_open_pairs_are_blocked_and_complete(spark, rows, monkeypatch):
    monkeypatch.setattr(minhash_join, "SHORT_LIST", 0)
    got = {r.doc_id: r.component_id for r in minhash_join.near_duplicate_classes(frame(spark, rows)).collect()}
    assert got == {d: c for d, _, c in brute.near_duplicates(rows)}


def test_texts_go_through_python_once_per_written_table(spark, rows, monkeypatch):
    plans, stage = {}, Scratch.stage

    def seen(self, df, name="t", keep=False):
        plans[name] = df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")
        return stage(self, df, name, keep)

    monkeypatch.setattr(Scratch, "stage", seen)
    minhash_join.near_duplicate_classes(frame(spark, rows))
    assert plans["rows"] == plans["sets"] == 1
    assert max(plans.values()) == 1


def test_kernels_return_bounded_pieces():
    texts = [None, "", "a b"] + [" ".join(f"w{i}x{j}" for j in range(20_000)) for i in range(16)] + [" "]
    batch = pa.array(texts)
    assert batch.nbytes > 2 * words.CHUNK_BYTES
    sizes, classes = [], []
    for piece in minhash_join._signature_pieces(iter([batch, batch[:0]]), minhash_join.SHINGLE):
        sizes.append(piece.field("n").to_pylist())
        classes += piece.field("cls").to_pylist()
        assert [k if k is None else len(k) for k in piece.field("keys").to_pylist()] == [
            minhash_join.COORDINATES if n else 0 for n in sizes[-1]
        ]
    assert len(sizes) > 2 and sum(sizes, []) == [0, 0, 1] + [19_996] * 16 + [0]
    pieces = list(minhash_join._set_pieces(iter([batch, batch[:0]]), minhash_join.SHINGLE))
    assert len(pieces) > 2
    assert [c for p in pieces for c in p.field("cls").to_pylist()] == classes
    assert [len(g) // 8 for p in pieces for g in p.field("grams").to_pylist()] == sum(sizes, [])
    assert [c is None for c in classes] == [n == 0 for n in sum(sizes, [])]


def test_components_of_chains_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (5, 6), (None, 3)]
    with Scratch(spark) as scratch:
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint"), scratch).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_repeats_match_brute_force(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line = text(90), text(38)
    texts = [None, "", "short", "a" * 450, "ab" * 300, passage, text(4000)]
    texts += [text(40) + " " + passage[rng.randrange(40) :] + text(30) for _ in range(12)]
    texts += [text(10) + line + text(20) for _ in range(30)] + [passage + passage, text(100)]
    texts += [texts[-1], texts[-1][:-3], "ü" + texts[-1]]
    rows = list(enumerate(texts)) + [(None, texts[8]), (3, texts[3])]
    got = bucket_pointer.remove_repeats(frame(spark, rows)).collect()
    want = [(d, *r) for (d, _), r in zip(rows, brute.repeats([t for _, t in rows]))]
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == sorted(want, key=repr)
    whole = {r.doc_id: r for r in got}
    raw = texts[9].encode()
    assert len(bucket_pointer.kept_bytes(raw, whole[9].starts, whole[9].ends)) == len(raw) - whole[9].n_removed


@pytest.mark.parametrize("block", [512, 8])
def test_vector_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    rows = []
    for i in range(220):
        v = base[i % 40 if i % 3 else 0] + rng.normal(size=16) * rng.choice([0.02, 0.08, 0.15, 0.3])
        rows.append((i, [float(x) for x in v], int(i % 2) if i % 3 else 0))
    rows += [(300, [0.0] * 16, 0), (301, None, 0), (302, [1.0, None], 0), (303, [float("nan")] * 16, 0), (304, rows[0][1], None),
             (305, rows[0][1], 0), (306, [2 * x for x in rows[0][1]], 0), (None, rows[0][1], 0), (307, [], 1), (308, [float("inf"), 1.0], 1), (0, rows[0][1], 0)]
    df = spark.createDataFrame([(i, v, y, 1) for i, v, y in rows], "vec_id bigint, embedding array<double>, label int, cls int")
    got = embed_dedup.linked_vectors(df).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == sorted(brute.vector_links(rows), key=repr)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert minhash_join.near_duplicate_classes(none).count() == 0
    assert minhash_join.drop_near_duplicates(none).count() == 0
    assert bucket_pointer.remove_repeats(none).count() == 0
    assert embed_dedup.linked_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_tables_meet_pairs_at_the_threshold():
    assert embed_dedup.tables(0) == 1 and embed_dedup.tables(embed_dedup.MOST_CELL_PROJECTIONS) < 128
    rng = np.random.default_rng(3)
    a, noise = rng.normal(size=(2, 3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    noise -= (noise * a).sum(axis=1, keepdims=True) * a
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    c = embed_dedup.THRESHOLD
    b = c * a + np.sqrt(1 - c * c) * noise
    for n in (3, 12):
        cells = [embed_dedup._cell_numbers(x, n, c) for x in (a, b)]
        assert (cells[0] == cells[1]).any(axis=1).mean() > 0.99
        assert (cells[0][:-1] == cells[1][1:]).mean() < 0.6**n  # random pairs rarely share a cell
