"""Cases of the review of round 2: what the operators left out before."""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hydrix.llm import byte_cnn, interpolation_lm, mixing, secrets, url_graph


def test_training_sample_takes_distinct_texts(spark):
    rows = [(f"text number {i}", "en") for i in range(200)] + [("kurz", "de"), ("text number 7", "de")]
    df = spark.createDataFrame(rows, "text string, lang string")
    first = df.where("lang = 'en'").orderBy(F.xxhash64(F.lit(byte_cnn.SEED), F.col("text").cast("binary"))).first()
    copied = df.union(spark.createDataFrame([tuple(first)] * 1000, df.schema))  # their hash is the smallest
    got = [(r.lang, bytes(r.windows[0])) for r in byte_cnn.training_sample(copied, per_lang=50).collect()]
    assert len(set(got)) == len(got) == 52
    assert sorted(got) == sorted((r.lang, bytes(r.windows[0])) for r in byte_cnn.training_sample(df, per_lang=50).collect())


def test_weak_labels_in_any_case():
    def kinds(text):
        return sorted(k for _, _, k in secrets.linked_spans(text, secrets.base_spans(text)))

    every = ["endpoint", "weak_id", "weak_secret"]
    assert kinds("DB_USER=alice\nDB_PASSWORD=hunter2\nDB_HOST=db.example.org:5432") == every
    assert kinds("Username: alice Password: hunter2") == ["weak_id", "weak_secret"]
    assert kinds("Login: alice PWD=abcd HTTPS://db.example.org/x") == every
    assert kinds("Login: alice Pass=abcd Server: db") == every
    assert kinds("Password: hunter2") == [] and kinds("HOST=db PASSWORD=abcd") == []
    assert kinds("login: alice " + "abcdefghij" * 3 + "1") == []  # a long token counts only in mixed case


def test_lm_counts_beyond_32_bits():
    lm = interpolation_lm
    words = np.sort(np.array([lm.END[0], 12345], np.uint64))
    end = int(np.searchsorted(words, lm.END[0]))
    group = {
        "gid": 0, "doc_ids": [1], "held": np.array([False]).tobytes(), "bounds": lm._pack(np.array([0, 2])),
        "words": lm._pack(words), "tokens": lm._pack(np.array([1 - end, end], np.uint32)),
    }
    columns = {c: pa.array([group[c]]) for c in ("gid", "held", "bounds", "words", "tokens")}
    (asked,) = lm.requests(1)(iter([pa.RecordBatch.from_pydict(columns)]))
    many, groups = 0xF0000000, 3  # groups that each hold the text "w" as often
    part = pd.concat([asked.to_pandas().assign(gid=g, nw=lm._pack(np.full(2, many, np.uint32)), np=lm._pack(np.full(2, many, np.uint32))) for g in range(groups)])
    replies = lm.answers(part)
    n, v = int(replies["n"].sum()), int(replies["v"].sum())
    assert (n, v) == (2 * groups * many, 2)
    counted = lm.joined(n, v)(pd.DataFrame([group]), replies[replies["gid"] == 0])
    weights = np.full((lm.BUCKETS, 3), [0.5, 0.25, 0.25])
    (got,) = lm.scored(pa.int64(), weights, n, v)(iter([pa.RecordBatch.from_pandas(counted, preserve_index=False)]))
    c = groups * many
    assert got["base_score"][0].as_py() == pytest.approx(2 * math.log10((c + 0.1) / (n + 0.1 * (v + 1))), rel=1e-12)
    assert got["score"][0].as_py() == pytest.approx(2 * math.log10(0.5 + 0.25 * c / n + 0.25 / (v + 1)), rel=1e-12)


def test_lm_grid_covers_every_ratio():
    lm = interpolation_lm
    ratios = 2.0 ** np.arange(-63.9, 64, 0.31)  # up to V + 1, down to (V + 1) / N
    assert np.abs(np.log2(lm._ratios(lm._grid(ratios)) / ratios)).max() <= 0.5 / lm.STEPS + 1e-9
    assert lm._grid(np.array([0.0]))[0] == 0 and lm._grid(ratios).max() < lm._SIDE
    # pair counts of 16 million types: half of the tokens are sure, half unseen, so the pair weight is 1/2
    types = 1 << 24
    cells = ((5 * lm._SIDE + lm._grid(np.array([types, 0.0]))) * lm._SIDE + lm._grid(np.array([1.0, 1.0]))).astype(np.int64)
    pair, _, _ = lm.learn_weights(cells, np.array([500, 500]))[5]
    assert pair == pytest.approx(0.5, abs=1e-6)


def test_url_scores_settle_on_cycles_and_long_chains(spark):
    link = '<a href="http://{}/">'
    pages = [(0, "http://a.x.org/", "")] + [(i + 1, f"http://h{i}/", link.format(f"h{i + 1}")) for i in range(20)] + [(21, "http://h20/", "")]
    rules = (("a.x.org", "/", "allow"), ("h0", "/", "allow"))
    got = {r.host: r for r in url_graph.judge_urls(spark.createDataFrame(pages, "page_id bigint, url string, html string"), rules=rules).collect()}
    assert got["a.x.org"].trust == pytest.approx(0.5 * 0.15 / (1 - 0.85**2), abs=1e-5)  # to its parent and back
    assert got["h20"].trust == pytest.approx(0.5 * 0.15 * 0.85**20, abs=1e-9)


def test_unlabelled_texts_with_letters_stay(spark):
    rows = [(1, "some text", None), (2, "123 --", None), (3, None, None), (4, "é中", None), (5, "", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = corpus_pipeline.language_id(spark, df, "")
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_cut_documents_are_prefixes_as_they_stand(spark):
    texts = {i: f" \t{i}  " + "word \n\n next\tone  " * 40 for i in range(60)}
    df = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in texts.items()], "doc_id bigint, text string, source string")
    got = mixing.mixed_documents(df).collect()
    cut = [r for r in got if r.text != texts[r.doc_id]]
    assert 1 <= len(cut) <= 2 and len({r.source for r in cut}) == len(cut)
    assert all(texts[r.doc_id].startswith(r.text) and not r.text[-1].isspace() for r in cut)
