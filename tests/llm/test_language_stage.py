"""The network against plain loops, its sample on hot languages, and its say in the pipeline."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hydrix.llm import byte_cnn


@pytest.fixture(scope="module")
def labelled(spark):
    en, de = "the cat and the dog went to the town ", "der Hund und die Katze in einem Haus "
    rows = [(i, (en if i % 2 else de) * (1 + i % 9) + str(i), "en" if i % 2 else "de") for i in range(400)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def by_loops(model, text):
    """Mean over windows of softmax(relu(max over positions of filter . patch + bias) . dense)."""
    data = text.encode()
    total = np.zeros(len(model.langs))
    windows = [data[i : i + byte_cnn.WINDOW].ljust(byte_cnn.WINDOW, b"\0") for i in range(0, len(data), byte_cnn.WINDOW)]
    widest, embed = max(byte_cnn.WIDTHS), model.embed.shape[1]
    for w in windows:
        pooled = []
        for f in range(model.filters.shape[1]):
            best = -math.inf
            for at in range(byte_cnn.WINDOW):
                value = 0.0
                for j in range(min(widest, byte_cnn.WINDOW - at)):  # beyond the window there is nothing
                    for e in range(embed):
                        value += float(model.embed[w[at + j], e]) * float(model.filters[j * embed + e, f])
                best = max(best, value)
            pooled.append(max(best + float(model.bias[f]), 0.0))
        scores = [sum(p * float(model.dense[i, k]) for i, p in enumerate(pooled)) + float(model.out_bias[k]) for k in range(len(model.langs))]
        top = max(scores)
        odds = [math.exp(s - top) for s in scores]
        total += np.array([o / sum(odds) for o in odds])
    return total / len(windows)


def test_forward_pass_equals_plain_loops(labelled):
    model = byte_cnn.fit(labelled)
    texts = ["the dog", "die Katze in " * 15, "é the 漢字 und"]
    names, scores = byte_cnn.predict(model, pa.array(texts))
    for text, name, score in zip(texts, names, scores):
        want = by_loops(model, text)
        assert name == model.langs[int(want.argmax())] and score == pytest.approx(want.max(), abs=1e-4)


def test_sample_is_the_smallest_hashes_of_a_hot_language(spark):
    rows = [(f"text number {i}", "en") for i in range(6000)] + [(f"kurzer Text {i}", "de") for i in range(30)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(16)
    raw = F.col("text").cast("binary")
    smallest = df.where("lang = 'en'").orderBy(F.xxhash64(F.lit(byte_cnn.SEED), raw)).limit(40).collect()
    got = byte_cnn.training_sample(df, per_lang=40).collect()
    assert sorted(bytes(r.windows[0]) for r in got if r.lang == "en") == sorted(r.text.encode() for r in smallest)
    assert sum(r.lang == "de" for r in got) == 30


def test_texts_that_score_like_a_guess_go(spark, labelled, monkeypatch):
    model = byte_cnn.fit(labelled)
    even = byte_cnn.ByteCnn(model.langs, model.embed, model.filters, model.bias, model.dense * 0, model.out_bias * 0)
    assert corpus_pipeline.language_id(spark, labelled, "").count() == 400
    monkeypatch.setattr(byte_cnn, "fit", lambda docs: even)  # a network that cannot tell
    assert corpus_pipeline.language_id(spark, labelled, "").count() == 0
    one = byte_cnn.ByteCnn(["en"], model.embed, model.filters, model.bias, model.dense[:, :1], model.out_bias[:1])
    monkeypatch.setattr(byte_cnn, "fit", lambda docs: one)
    assert corpus_pipeline.language_id(spark, labelled, "").count() == 400
