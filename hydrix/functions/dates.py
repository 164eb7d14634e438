"""Date helpers for ISO-8601 sample timestamps."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydrix._util import as_col


def parse_date(c: Column | str) -> Column:
    """ISO text -> DATE with Spark's string-to-date rules; bad text gives NULL, never an error.

    ``2026-01-05T10:00:00Z`` -> 2026-01-05.  Plain ``to_date`` raises on bad text under ANSI mode.
    """
    return F.try_to_date(as_col(c))


def iso_date_part(c: Column | str) -> Column:
    """Text before the first ``T``; NULL and empty text give NULL."""
    return F.substring_index(F.nullif(as_col(c), F.lit("")), "T", 1)


def year_of(c: Column | str) -> Column:
    """Calendar year of a DATE/TIMESTAMP as INT."""
    return F.year(as_col(c))


def _as_date(v: str | _dt.date) -> _dt.date:
    return v if isinstance(v, _dt.date) else _dt.date.fromisoformat(v)


def in_window(c: Column | str, start: str | _dt.date, end: str | _dt.date) -> Column:
    """Inclusive date window predicate ``start <= c <= end``; NULL dates are outside."""
    lo, hi = _as_date(start), _as_date(end)
    if lo > hi:
        raise ValueError(f"empty window: {lo} > {hi}")
    return as_col(c).between(F.lit(lo), F.lit(hi))
