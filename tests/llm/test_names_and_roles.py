"""Columns of the caller's table come back unchanged; secrets fill one role each."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hydrix.llm import fm_decontam, minhash_join, mixing, secrets, sharding
from hydrix.llm.keyfilter import key_filter, may_match

HELPERS = ["__slot", "__shard", "__okey", "__text", "__plan", "__thash", "__maybe", "__rkey", "__s", "__word", "__bit", "__bits",
           "found", "owner", "place", "entry", "rkey", "maybe", "okey", "plan", "piece", "language", "contamination", "Found", "salt"]
HELPERS = [h for i, h in enumerate(HELPERS) if h.lower() not in {x.lower() for x in HELPERS[:i]}]


def table(spark, texts):
    rows = [(i, t, "en", "s") + tuple(f"{h}-{i}" for h in HELPERS) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{h}` string" for h in HELPERS))


def check_helpers(rows):
    assert rows
    for r in rows:
        assert [r[h] for h in HELPERS] == [f"{h}-{r.doc_id}" for h in HELPERS]


TEXTS = ["one two three four five six seven eight nine ten"] * 3 + [f"other words number {i} of a text that is alone {i * 7}" for i in range(20)] + [None, ""]


@pytest.mark.parametrize("apply", [
    lambda d: sharding.place(d), lambda d: mixing.mixed_documents(d), lambda d: minhash_join.drop_near_duplicates(d),
    lambda d: may_match(d, F.col("doc_id"), key_filter(d.select(F.col("doc_id").alias("k")), "k"), "may"),
], ids=["place", "mixed_documents", "drop_near_duplicates", "may_match"])
def test_helper_names_do_not_touch_columns(spark, apply):
    df = table(spark, TEXTS)
    out = apply(df)
    assert out.columns[: len(df.columns)] == df.columns
    check_helpers(out.collect())


def test_pipeline_stages_keep_columns(spark, tmp_path):
    docs = table(spark, TEXTS)
    items = [(1, "none of these words is in a document at all so nothing goes away")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        check_helpers(docs.collect())


def kinds(text):
    return sorted(k for _, _, k in secrets.linked_spans(text, secrets.base_spans(text)))


def test_a_span_fills_one_role():
    assert kinds('Login: "Zx9AbcDEFghij1234567890" is the name') == []
    assert kinds("user: bob saw https://en.example.org/wiki/SomeArticle2019AboutThings1") == []
    assert kinds("user: bob Zx9AbcDEFghij1234567890 https://db.example.org/x") == ["endpoint", "weak_id", "weak_secret"]
    assert kinds("user: bob pass=abcd https://db.example.org/SomeArticle2019AboutThings1") == ["endpoint", "weak_id", "weak_secret"]


def by_definition(text, scope=secrets.SCOPE):
    """Every part against every other part."""
    base = secrets.base_spans(text)
    taken = [(s, e) for s, e, _ in base]
    parts = {}
    for role, pattern in (("secret", secrets.LABELLED_SECRET), ("id", secrets.WEAK_ID), ("endpoint", secrets.ENDPOINT), ("secret", secrets.MIXED_TOKEN)):
        new = [m.span() for m in pattern.finditer(text)]
        new = [(a, b) for a, b in new if all(b <= s or a >= e for s, e in taken)]
        taken += new
        parts.setdefault(role, []).extend(new)
    strong_id = [(s, e) for s, e, k in base if k == "access"]
    strong = [(s, e) for s, e, k in base if k != "access"]
    near = lambda x, others: any(x[0] - e <= scope and s - x[1] <= scope for s, e in others)
    ids, weak, ends = parts["id"], parts["secret"], parts["endpoint"]
    out = [(*x, "weak_id") for x in ids if near(x, strong + weak)]
    out += [(*x, "weak_secret") for x in weak if near(x, strong_id + ids) or (near(x, strong) and near(x, ends))]
    return sorted(out + [(*x, "endpoint") for x in ends if near(x, strong_id + ids) and near(x, strong + weak)])


def test_linking_matches_the_definition_on_random_texts():
    rng = random.Random(12)
    pieces = ["user: bob", "login=", "password=abcd", "pwd: Zx9AbcDEFghij1234567890", "Zx9AbcDEFghij1234567890", "https://a.example.org/p", "host=db:5432",
              "AKIA" + "A" * 16, "AKIA12", "deadbeef01234567", "token: abcdefghijklmnop", " ", "\n", "é", '"', "x" * 90, "client_id=abc", "://", "="]
    seen = 0
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randrange(1, 14)))
        got = sorted(secrets.linked_spans(text, secrets.base_spans(text)))
        assert got == by_definition(text), text
        seen += len(got)
        spans = sorted([(s, e) for s, e, _ in got])
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert seen > 1000


def test_phrases_of_blocks_equal_those_of_one(spark):
    rng = random.Random(1)
    items = [(str(i % 7) if i else None, " ".join(rng.choices("abcde", k=rng.choice([0, 1, 9, 10, 11, 40])))) for i in range(60)]
    items += items[:9]
    got = fm_decontam.make_phrases(items)
    want = {}
    for item, text in items:
        words = text.split()
        for at in range(max(min(len(words), 1), len(words) - 9)):
            owners = want.setdefault(tuple(words[at : at + 10]), set())
            if item is not None:
                owners.add(item)
    hashes = fm_decontam.word_hashes
    import numpy as np

    letters = np.frombuffer(b"a b c d e", np.uint8)
    code = dict(zip("abcde", np.searchsorted(got.vocabulary, hashes(letters, np.arange(0, 9, 2), np.arange(1, 10, 2))) + 1))
    found = {}
    for w in range(len(got.windows)):
        owners = {got.items[o] for o in got.owners[got.owner_start[w] : got.owner_start[w + 1]]}
        found[tuple(got.windows[w][got.windows.shape[1] - got.lengths[w] :].tolist())] = owners
    assert found == {tuple(int(code[x]) for x in k): v for k, v in want.items()}


def test_empty_benchmark(spark):
    docs = table(spark, ["some words"]).select("doc_id", "text")
    for items in ([], [(1, None)], [(None, "..")]):
        found = fm_decontam.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
        assert found.first().contamination.n_hit == 0


@pytest.mark.parametrize("shards", [1, 16])
def test_shards_take_their_quotas_of_blocks(spark, shards):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(1, 300)), rng.choice(["a", "B", None])) for i in range(300)] + [(7, "same row", "a")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(df, shards=shards, block=64).collect()
    other = mixing.mix_sources(df, shards=4, block=64).collect()
    assert sorted((r.doc_id, r.taken, r.block or -1) for r in got) == sorted((r.doc_id, r.taken, r.block or -1) for r in other)
    assert {r.shard for r in got if r.taken} == set(range(1, shards + 1))
    assert all((r.shard is None) == (r.taken == 0) for r in got)
    with mixing.Scratch(spark, "t") as scratch:
        _, _, quotas = mixing.mix_plan(df, scratch, shards=shards, block=64)
        quota = {(r.source, r.shard): (r.first_block, r.first_block + r.quota) for r in quotas.collect()}
    for r in got:
        if r.taken:
            first, end = quota[r.source, r.shard]
            assert first <= r.block < end
    # a document starts where the documents of smaller keys end
    by_source = {}
    for r in df.withColumn("k", mixing.order_key("doc_id", "text", mixing.SEED)).collect():
        by_source.setdefault(r.source, []).append((r.k, r.doc_id, r.text, len(r.text.split())))
    start = {(s, d, t): sum(n for j, _, _, n in own if j < k) for s, own in by_source.items() for k, d, t, _ in own}
    texts = {(r[2], r[0]): r[1] for r in rows}
    for r in got:
        if r.taken and r.doc_id != 7:
            assert r.block == start[r.source, r.doc_id, texts[r.source, r.doc_id]] // 64
