"""Laboratory-result text parser (F4, F4b) as native column expressions.

Semantics: NULL -> NULL; decimal comma -> dot; surrounding blanks (Unicode too) removed; a leading
``<`` marks a detection limit and yields the limit value (or NULL with ``censored="null"``);
anything that is not a plain decimal/scientific number yields NULL.  The value is parsed as a
double and then narrowed to FLOAT, the same two roundings a Python ``float`` returned into a
``FloatType`` column goes through.

Documented deviation from Python ``float()``: ``nan``, ``inf``, ``1_000`` and non-ASCII digits
give NULL here (the ASCII guard rejects them).  ``<=``, ``>`` and other prefixes give NULL as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydrix._util import as_col

# Fixed value: the accepted numeric text (after comma->dot and trimming).
NUMERIC_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
# The characters that text may contain.  Within this alphabet the double parser behind Spark's
# ``try_cast`` accepts exactly NUMERIC_TEXT (no hex, no d/f suffix, no NaN/Infinity, no '_'), so an
# alphabet test plus ``try_cast`` implements the pattern without running a regex per row.
NUMERIC_CHARS = "0123456789+-.eE"

# Blanks removed around the text: every character Python's ``str.isspace`` accepts (the set that
# ``str.strip`` and ``float`` remove), derived from the rule rather than listed by hand.
BLANKS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

CENSORED_POLICIES = ("limit", "null")


# Every character of BLANKS has a code point <= 32 or >= 133: text whose first and last characters
# lie strictly between needs no trimming, which is the common case.
_LOW, _HIGH = 32, 133


def strip_blanks(c: Column | str) -> Column:
    """Remove leading/trailing white space, including Unicode blanks such as no-break spaces.

    ``btrim`` over the explicit blank set, run only when an end character could be a blank (two
    code-point tests on the ends otherwise); no regex.
    """
    c = as_col(c)
    first, last = F.ascii(c), F.ascii(F.substring(c, -1, 1))
    maybe_blank = (first <= _LOW) | (first >= _HIGH) | (last <= _LOW) | (last >= _HIGH)
    return F.when(maybe_blank, F.btrim(c, F.lit(BLANKS))).otherwise(c)


def is_censored(c: Column | str) -> Column:
    """True when the (trimmed) text is a detection-limit value such as ``<0,005``."""
    return strip_blanks(as_col(c)).startswith("<")


def parse_measurement(c: Column | str, censored: str = "limit") -> Column:
    """Text such as ``<0,005``, ``0,010`` or `` 12.5 `` -> FLOAT (see module docstring)."""
    if censored not in CENSORED_POLICIES:
        raise ValueError(f"censored must be one of {CENSORED_POLICIES}, got {censored!r}")
    # any input type is read as its text, as the source's str() did (e.g. a column inferred as double)
    text = strip_blanks(F.replace(as_col(c).cast("string"), F.lit(","), F.lit(".")))
    below_limit = text.startswith("<")
    body = strip_blanks(F.when(below_limit, F.substring(text, 2, 1 << 30)).otherwise(text))
    plain = F.translate(body, NUMERIC_CHARS, "") == F.lit("")
    value = F.when(plain, body.try_cast("double")).cast("float")
    if censored == "null":
        value = F.when(~below_limit, value)
    return value
