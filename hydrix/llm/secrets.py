"""Secret scan with multipart credential linking.

A *strong* secret is reported on its own form alone (the base kinds).  *Weak* candidates -- a short
access identifier, an unlabelled random-looking value, a service endpoint -- are common in harmless
text, so one is reported only when the complementary parts of a credential co-occur: the operator
joins identifier, secret and endpoint intervals that lie within one scope (``scope`` characters from
the end of one part to the start of the other) and reports

* a weak identifier with a secret (strong or weak) in scope,
* a weak secret with an identifier (strong or weak) in scope, or with both a strong secret and an
  endpoint,
* an endpoint that has both an identifier and a secret in scope.

A span fills one role.  Strong secrets come first, then labelled secrets, labelled identifiers, endpoints and
long random-looking tokens; a candidate that overlaps a part taken before it is none.  So the parts that meet
are always disjoint: a value is never its own complement, and a piece of a URL is no secret beside it.

All parts of a text are in that text's row, so the interval join is a sorted sweep
(``searchsorted`` over part starts) inside the row: nothing is shuffled, no pairs are made, and a
text with many parts costs n log n.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns, their kinds in reporting order, and the least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
# A maximal run is the only match that these two can have in it, so the least length is in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN = 12
#: Every assignment holds one of these in lower case; finding none is cheaper than the pattern.
ASSIGN_HINTS = ("passw", "secret", "token", "key")
BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("weak_id", "weak_secret", "endpoint")
KINDS = {k: i for i, k in enumerate(BASE_KINDS + WEAK_KINDS)}

#: Weak forms: a labelled or prefixed identifier, a labelled short value or a long mixed token, a URL or host:port.
WEAK_ID = re.compile(
    r"(?:(?-i:AKIA[A-Z0-9]+)|(?:access_?key_?id|client_?id|account_?id|user(?:name)?|login)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,})",
    re.IGNORECASE | re.ASCII,
)
LABELLED_SECRET = re.compile(
    r"(?i:password|passwd|pwd|pass|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{4,}", re.ASCII
)
MIXED_TOKEN = re.compile(
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[A-Z])(?=[A-Za-z0-9+/_=-]*[a-z])(?=[A-Za-z0-9+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}",
    re.ASCII,
)
ENDPOINT = re.compile(
    r"(?:[A-Za-z][A-Za-z0-9+]{1,9}://[A-Za-z0-9][^\s\"'<>]*|(?i:host|endpoint|server|url)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9][A-Za-z0-9.-]*(?::[0-9]{2,5})?)",
    re.ASCII,
)
#: A text without one of these cannot hold a weak part that links; it saves the three weak scans.
_HINT = re.compile(r"AKIA|[:=]|://")

SCOPE = 200
RESULT = (
    "n_assign long, n_access long, n_hex long, kinds array<string>, starts array<long>, ends array<long>, base array<boolean>"
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the strong secrets, leftmost and non-overlapping within a kind."""
    found, lowered = [], text.lower()
    if any(h in lowered for h in ASSIGN_HINTS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS[s[2]]))


class _Intervals:
    """Sorted part intervals of one role; ``near`` says which others have one within the scope."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = np.array([s for s, _ in spans], np.int64)
        self.ends = np.maximum.accumulate(np.array([e for _, e in spans], np.int64)) if spans else self.starts

    def near(self, spans: list[tuple[int, int]], scope: int) -> np.ndarray:
        if not len(self.starts) or not spans:
            return np.zeros(len(spans), bool)
        lo = np.array([s for s, _ in spans], np.int64) - scope
        hi = np.array([e for _, e in spans], np.int64) + scope
        last = np.searchsorted(self.starts, hi, "right") - 1  # the parts that begin before the scope ends
        return (last >= 0) & (self.ends[np.maximum(last, 0)] >= lo)


def linked_spans(text: str, base: list[tuple[int, int, str]], scope: int = SCOPE) -> list[tuple[int, int, str]]:
    """Weak candidates whose complementary parts co-occur within ``scope`` characters."""
    if not _HINT.search(text):
        return []
    taken = [(s, e) for s, e, _ in base]

    def free(pattern: re.Pattern) -> list[tuple[int, int]]:
        spans = [m.span() for m in pattern.finditer(text)]
        covered = _Intervals(taken).near([(a + 1, b - 1) for a, b in spans], 0)
        found = [s for s, c in zip(spans, covered) if not c]
        taken.extend(found)
        return found

    strong_ids = [(s, e) for s, e, k in base if k == "access"]
    strong_secrets = [(s, e) for s, e, k in base if k != "access"]
    weak, ids, ends = free(LABELLED_SECRET), free(WEAK_ID), free(ENDPOINT)
    if not (ids or strong_ids or (ends and strong_secrets)):
        return []  # nothing that a weak secret could complement
    weak += free(MIXED_TOKEN)
    identifier, secret, endpoint = _Intervals(strong_ids + ids), _Intervals(strong_secrets + weak), _Intervals(ends)
    found = [(s, e, "weak_id") for (s, e), ok in zip(ids, secret.near(ids, scope)) if ok]
    with_id = identifier.near(weak, scope)
    labelled = _Intervals(strong_secrets).near(weak, scope) & endpoint.near(weak, scope)
    found += [(s, e, "weak_secret") for (s, e), ok in zip(weak, with_id | labelled) if ok]
    both = identifier.near(ends, scope) & secret.near(ends, scope)
    return found + [(s, e, "endpoint") for (s, e), ok in zip(ends, both) if ok]


def secret_spans(text: Column, scope: int = SCOPE) -> Column:
    """Struct column of all secrets in a text: counts by base kind, and the spans in order.

    ``kinds``, ``starts``, ``ends`` (code points, end exclusive) and ``base`` run in parallel, sorted
    by start, then kind as listed in ``KINDS``.  A null or empty text has no spans; equal starts of
    different kinds are all kept; whole texts are scanned whatever their length.
    """

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                t = t or ""
                base = base_spans(t)
                spans = sorted(base + linked_spans(t, base, scope), key=lambda s: (s[0], KINDS[s[2]], s[1]))
                kinds = [k for _, _, k in spans]
                rows.append((*(sum(k == b for _, _, k in base) for b in BASE_KINDS), kinds, [s for s, _, _ in spans],
                             [e for _, e, _ in spans], [k in BASE_KINDS for k in kinds]))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "kinds", "starts", "ends", "base"])

    return scan(text)


def scan_secrets(docs: DataFrame, text: str = "text", out: str = "secrets", scope: int = SCOPE) -> DataFrame:
    """``docs`` with the struct column ``out`` of ``secret_spans``; every row and column stays.

    An input column of the name ``out`` is replaced.  An empty table gives an empty result.
    """
    return docs.withColumn(out, secret_spans(F.col(f"`{text}`"), scope))


def span_list(spans: str, only_base: bool = False) -> Column:
    """``kind:start:end`` of a ``secret_spans`` struct, comma-joined in order."""
    part = F.arrays_zip(*(F.col(f"{spans}.{c}").alias(c) for c in ("kinds", "starts", "ends", "base")))
    if only_base:
        part = F.filter(part, lambda s: s["base"])
    return F.array_join(F.transform(part, lambda s: F.concat_ws(":", s["kinds"], s["starts"], s["ends"])), ",")
