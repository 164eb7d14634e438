"""Incremental ingest of landed page files with Structured Streaming."""

from hydrix.streaming.landing import ingest_pages, land_pages

__all__ = ["ingest_pages", "land_pages"]
