"""Registered queries of the training-data operators: thin bindings to the driver's tables.

``QUERIES[name](spark, sf_dir)`` applies an operator with production parameters to its whole table
and derives the contract's digest columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrix.llm import (
    bucket_pointer,
    byte_cnn,
    embed_dedup,
    fill_middle,
    fm_decontam,
    heavy,
    interpolation_lm,
    line_dedup,
    minhash_join,
    mixing,
    secrets,
    sharding,
    url_graph,
    vector_codes,
)
from hydrix.llm.oracle import ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def _sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def op1_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_graph.judge_urls(_table(spark, sf_dir, "pages"))


def op2_secret_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan_secrets(docs)
    return found.select(
        "doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex",
        _sha256(secrets.span_list("secrets", only_base=True)).alias("base_sha256"),
        secrets.span_list("secrets").alias("spans"),
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.place(docs).select("doc_id", "slot", "shard")


def op4_projection_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.linked_vectors(_table(spark, sf_dir, "embeddings"))


def op5_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation_lm.score_texts(_table(spark, sf_dir, "documents"), fold("doc_id", 10) == 0)


def op6_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = byte_cnn.fit(docs.where(~held_out))
    found = byte_cnn.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), "language.score")


def op7_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_duplicate_classes(_table(spark, sf_dir, "documents"))


def op8_fm_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fm_decontam.find_contamination(docs, _table(spark, sf_dir, "benchmark")).select("doc_id", "contamination.*")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        _sha256(F.array_join("items", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_bucket_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bucket_pointer.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "block", "shard")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", _sha256(F.col("fim.output")).alias("output_sha256"),
        _sha256(fill_middle.restore_text(F.col("fim.output"), F.col("fim.form"))).alias("restored_sha256"),
    )


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "lines.n_lines", "lines.n_dropped", _sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256")
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress_vectors(_table(spark, sf_dir, "embeddings"))
    sums = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("rows"))
    found = heavy.join_by_key(coded, sums, ["label"], F.col("rows"), coded.count(), F.col("vec_id"))
    return found.select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_graph, op2_secret_linking, op3_sharding, op4_projection_collisions, op5_deleted_interpolation,
        op6_byte_cnn, op7_minhash_join, op8_fm_decontam, op9_bucket_pointer, op10_source_mix, op11_fill_middle, op12_line_dedup, op13_vector_codes,
    )
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
