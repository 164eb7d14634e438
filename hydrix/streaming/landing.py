"""Landed pages -> bronze Parquet, incrementally (the bronze step of the source, re-aimed).

The source pulls pages from an HTTP API in a driver loop.  Here the pages are files dropped into a
landing folder; a Structured Streaming query turns every new envelope file into bronze rows:

* file source with a declared envelope schema (no inference), ``maxFilesPerTrigger`` bounds a batch;
* ``inline(data)`` per envelope, stateless, no shuffle;
* Parquet file sink with a checkpoint: exactly-once per landed file, and a restarted query (lost
  driver or executors) resumes where the checkpoint says;
* ``availableNow`` trigger: process what has landed, then stop (a scheduled batch job), or a
  ``processingTime`` trigger to keep running.

``land_pages`` keeps the envelopes themselves, as Parquet with their manifest (page number, size, content
hash).  The end of the crawl and the copies that count are then found without opening a page again
(``sources.crawl_landed``).

Duplicate pages (the source re-requests its last page) are not removed here; the silver build's keyed
dedup removes the repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hydrix.session import path_exists
from hydrix.sources.paged import CORRUPT, DATA, envelope_schema, well_formed, with_manifest


def ingest_pages(
    spark: SparkSession,
    landing_dir: str,
    bronze_dir: str,
    row_schema: StructType,
    *,
    checkpoint: str | None = None,
    on_malformed: str = "raise",
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the ingest query and return it (call ``awaitTermination()`` for ``available_now``).

    The checkpoint is ``<bronze_dir>/_checkpoint`` unless one is named, so every run into the same
    bronze table goes on where the last one ended.  A named checkpoint that does not exist yet is
    refused for a table that already has a sink log: the sink would skip its first batches.  An
    envelope that does not parse stops the query (``on_malformed="raise"``) or is left out ("skip";
    ``page_stats`` over the landing folder counts such pages).
    """
    pages = _landing_stream(spark, landing_dir, envelope_schema(row_schema, corrupt=True), on_malformed, max_files_per_trigger)
    return _append(pages.select(F.inline(DATA)), bronze_dir, checkpoint, available_now, processing_time)


def land_pages(
    spark: SparkSession,
    landing_dir: str,
    pages_dir: str,
    row_schema: StructType,
    *,
    checkpoint: str | None = None,
    on_malformed: str = "raise",
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Like ``ingest_pages``, for envelopes with page numbers that stay envelopes: ``page``, ``data``, ``next``
    and the manifest columns.  Read them back as Parquet and pass them to ``crawl_landed``."""
    schema = envelope_schema(row_schema, with_page=True, corrupt=True)
    pages = _landing_stream(spark, landing_dir, schema, on_malformed, max_files_per_trigger)
    return _append(with_manifest(pages.drop(CORRUPT)), pages_dir, checkpoint, available_now, processing_time)


def _landing_stream(
    spark: SparkSession, landing_dir: str, schema: StructType, on_malformed: str, max_files_per_trigger: int | None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return well_formed(reader.json(landing_dir), on_malformed)


def _append(
    rows: DataFrame, target: str, checkpoint: str | None, available_now: bool, processing_time: str | None
) -> StreamingQuery:
    """Starts the query that appends ``rows`` to a Parquet table, exactly once per landed file."""
    spark, target = rows.sparkSession, target.rstrip("/")
    checkpoint = checkpoint or f"{target}/_checkpoint"
    if path_exists(spark, f"{target}/_spark_metadata") and not path_exists(spark, checkpoint):
        raise ValueError(f"{target} was filled under another checkpoint than {checkpoint}")
    writer = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(target)
