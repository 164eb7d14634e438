"""The corpus pipeline on sf0.001 against its stages' brute-force versions, and odd inputs of its stages."""

from pyspark.sql import functions as F

import brute
import corpus_pipeline
from hydrix.llm import mixing, sharding

SF = "/root/testdata/sf0.001"


def test_pipeline_rows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(d, t) for d, t in rows if t and any(c.isalpha() for c in t)]
    kept = {d for d, n, c in brute.near_duplicates(rows) if d == c}
    rows = [(d, t) for d, t in rows if d in kept]
    clean = {d for (d, t), (_, hit, _) in zip(rows, brute.contamination([t for _, t in rows], items)) if not hit}
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == [*spark.read.parquet(f"{SF}/documents.parquet").columns, "slot", "shard"]
    counts = {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert set(counts) <= clean and max(counts.values()) <= 3  # two copies and a part at most
    words = sum(len(brute.BLANK_WORDS.findall(t)) for d, t in rows if d in clean)
    taken = got.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert abs(taken - 1.5 * words) <= mixing.BLOCK * 21
    assert got.where(F.col("slot") != sharding.slot_of(F.col("doc_id").cast("string"))).count() == 0


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix", "shard"]
