"""Odd rows through the text operators and every pipeline stage: nulls, empty, blank and very long texts, repeats, extra columns."""

import random

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from hydrix.llm import bucket_pointer, byte_cnn, fm_decontam, minhash_join, mixing, secrets, sharding
from hydrix.llm.queries import fold

ITEM = "this benchmark item holds exactly these twelve words in its only line"
ITEMS = [(1, ITEM), (1, ITEM), (2, None), (3, ""), (None, "a short one"), (4, "...")]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, `extra col` string"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def odd_rows(long_words=30_000):
    rng = random.Random(4)
    alone = [words(rng, 50) for _ in range(6)]
    long = words(rng, long_words) + " " + ITEM + " " + words(rng, 40) + " token = " + "A1b2" * 8
    texts = [None, "", " \t\n", "12 345", *alone, alone[0], alone[0] + " more", ITEM, "He said: " + ITEM + ", twice " + ITEM, long, long, "ü" * 500]
    rows = [(i, t, "en" if i % 3 else None, ("s1", None, "s2")[i % 3]) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, alone[1], "en", "s1"), (None, None, None, None), (7, "another text under a known id", "en", "s2")]
    return [(*r, len(r[1] or ""), f"x{i}") for i, r in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def plain():
    return [(r[0], r[1]) for r in odd_rows()]


def bag(rows):
    return sorted(map(repr, rows))


def test_secrets(docs, plain):
    got = secrets.scan_secrets(docs).select("doc_id", secrets.span_list("secrets", only_base=True).alias("base")).collect()
    assert bag((r.doc_id, r.base) for r in got) == bag((d, brute.base_secrets(t or "")) for d, t in plain)


def test_near_duplicates(docs, plain):
    got = minhash_join.near_duplicate_classes(docs).collect()
    assert bag((r.doc_id, r.n_shingles, r.component_id) for r in got) == bag(brute.near_duplicates(plain))


def test_contamination(spark, docs, plain):
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, contamination string")
    got = fm_decontam.find_contamination(docs, items).select("doc_id", "contamination.*").collect()
    want = brute.contamination([t for _, t in plain], ITEMS)
    assert bag((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in got) == bag((d, *w) for (d, _), w in zip(plain, want))


def test_repeated_strings(docs, plain):
    got = bucket_pointer.remove_repeats(docs).collect()
    want = brute.repeats([t for _, t in plain])
    assert bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == bag((d, *w) for (d, _), w in zip(plain, want))


def test_repeats_where_fingerprints_of_texts_collide(spark, monkeypatch):
    """Different texts under one 64-bit fingerprint keep apart."""
    rng = random.Random(6)
    passage = words(rng, 60)
    texts = [words(rng, 80), words(rng, 90), passage + words(rng, 30), words(rng, 20) + passage, words(rng, 50), "short", ""]
    texts += [texts[1], "a" * 450]
    rows = list(enumerate(texts)) + [(20, None)]
    monkeypatch.setattr(bucket_pointer, "fingerprint", lambda body: F.xxhash64(F.octet_length(body) < 300))
    got = bucket_pointer.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute.repeats([t for _, t in rows])
    assert bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == bag((d, *w) for (d, _), w in zip(rows, want))


def test_language(docs, plain):
    model = byte_cnn.fit(docs.where(fold("doc_id", 5) != 0))
    got = byte_cnn.identify(docs, model).collect()
    assert len(got) == len(plain) and {r.language.lang for r in got} == {"en", "und"}
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.language.lang != "und") == letters and 0 <= r.language.score <= 1


def test_mix(docs, plain):
    got = mixing.mix_sources(docs).collect()
    size = lambda t: len(brute.BLANK_WORDS.findall(t or ""))
    assert bag((r.doc_id, r.size) for r in got) == bag((d, size(t)) for d, t in plain)
    by_source = {}
    for r in odd_rows():
        by_source[r[3]] = by_source.get(r[3], 0) + size(r[1])
    order = sorted(by_source, key=lambda s: (s is None, s))
    targets = brute.target_shares({s: by_source[s] for s in order})
    for r in got:
        assert r.source_size == by_source[r.source] and r.target == pytest.approx(targets[r.source]) and 0 <= r.taken <= 2 * r.size


def test_stages(spark, docs, tmp_path):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = docs.collect()
    known = set(map(repr, rows))

    def step(name, df):
        out = stages[name](spark, df, str(tmp_path))
        assert out.columns[: len(docs.columns)] == docs.columns
        return out, out.collect()

    df, got = step("language_id", docs)
    assert bag(got) == bag(r for r in rows if any(c.isalpha() for c in r.text or ""))
    df, kept = step("near_dedup", spark.createDataFrame(got, docs.schema))
    groups = brute.near_duplicates([(r.doc_id, r.text) for r in got])
    want = {(r.doc_id, r.text) for r, (d, _, c) in zip(got, groups) if d == c}  # two texts have id 7
    assert {(r.doc_id, r.text) for r in kept} == want and len(kept) == len(want) and set(map(repr, kept)) <= known
    df, clean = step("decontaminate", spark.createDataFrame(kept, docs.schema))
    hit = [n for _, n, _ in brute.contamination([r.text for r in kept], ITEMS)]
    assert bag(clean) == bag(r for r, n in zip(kept, hit) if not n)
    clean = spark.createDataFrame(clean, docs.schema)
    df, mixed = step("mix", clean)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean.collect()}
    assert all(r["extra col"].startswith("x") for r in mixed)
    df, placed = step("shard", spark.createDataFrame(mixed, docs.schema))
    assert len(placed) == len(mixed) and df.columns == [*docs.columns, "slot", "shard"]
    slots = df.where(F.col("slot") != sharding.slot_of(F.col("doc_id").cast("string")))
    assert slots.count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_alone_on_all_odd_rows_and_on_none(spark, docs, tmp_path, name):
    spark.createDataFrame(ITEMS, "item_id long, text string").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, docs, str(tmp_path))
    assert got.columns[: len(docs.columns)] == docs.columns and got.count() > 0
    none = stage(spark, docs.where("false"), str(tmp_path))
    assert none.columns == got.columns and none.count() == 0
