"""Column -> Column functions (all native Spark expressions, no Python UDF)."""

from hydrix.functions.arith import count_true, flag, percentage, ratio
from hydrix.functions.categories import DEFAULT_CATEGORY, DEFAULT_RULES, categorize
from hydrix.functions.dates import in_window, iso_date_part, parse_date, year_of
from hydrix.functions.measures import is_censored, parse_measurement, strip_blanks

__all__ = [
    "DEFAULT_CATEGORY",
    "DEFAULT_RULES",
    "categorize",
    "count_true",
    "flag",
    "in_window",
    "is_censored",
    "iso_date_part",
    "parse_date",
    "parse_measurement",
    "percentage",
    "ratio",
    "strip_blanks",
    "year_of",
]
