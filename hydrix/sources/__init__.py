"""Readers and writers: JSON Lines, Parquet, paged envelopes, previews."""

from hydrix.sources.files import (
    guard_not_input,
    read_json,
    read_parquet,
    write_json,
    write_parquet,
    written_counts,
)
from hydrix.sources.paged import (
    crawl_landed,
    crawl_pages,
    envelope_schema,
    page_rows,
    page_stats,
    read_pages,
    with_manifest,
    write_pages,
)
from hydrix.sources.publish import Publication, recover
from hydrix.sources.preview import preview_rows, schema_text

__all__ = [
    "Publication",
    "recover",
    "crawl_landed",
    "crawl_pages",
    "envelope_schema",
    "guard_not_input",
    "page_rows",
    "page_stats",
    "preview_rows",
    "read_json",
    "read_pages",
    "read_parquet",
    "schema_text",
    "with_manifest",
    "write_json",
    "write_pages",
    "write_parquet",
    "written_counts",
]
