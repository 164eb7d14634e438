"""Corpus pipeline: language ID, near-dedup, decontamination, source mixing, sharding.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and returns the
DataFrame that the next stage reads.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrix.llm import byte_cnn, fm_decontam, minhash_join, mixing, sharding
from hydrix.llm.queries import fold
from hydrix.session import stage


#: Clean documents score well above: of 51,282 with four languages none scored below 1.2 times a guess.
LEAST_OVER_CHANCE = 1.2


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the table does not use."""
    while name in docs.columns:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in which no language can be told: null texts, those without any letter, and those whose best
    score by the network is hardly above that of a guess (``LEAST_OVER_CHANCE`` times one over the languages).

    The network learns from the labelled rows of this stage's own input.  A table without labels has no
    model, and one language has no alternative: then only the texts without a letter go.
    """
    out = _free(docs, "language")
    model = byte_cnn.fit(docs.where(fold("doc_id", 5) != 0))
    if model is None:
        return docs.where(byte_cnn.letters(F.col("text")))
    found = byte_cnn.identify(docs, model, out=out)
    least = LEAST_OVER_CHANCE / len(model.langs) if len(model.langs) > 1 else 0.0
    return found.where((F.col(f"{out}.lang") != byte_cnn.UNDETERMINED) & (F.col(f"{out}.score") >= least)).drop(out)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (the smallest id)."""
    return minhash_join.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold any benchmark window."""
    out = _free(docs, "contamination")
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = fm_decontam.find_contamination(docs, benchmark, out=out)
    return found.where(F.col(f"{out}.n_hit") == 0).drop(out)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes of a document (see ``mixing.mixed_documents``)."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents with their slot and shard."""
    return sharding.place(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]
#: No SQL: a trained network and near-duplicate components cannot be put as SQL over whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
