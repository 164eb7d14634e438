"""Keyword-based parameter families (F5) as one ordered CASE chain.

The text is lower-cased and the rules are tried in order; the first family with a keyword contained
in the text wins.  NULL and empty text fall to the default.  Matching is plain substring matching, so
``ph`` also matches ``phosphore`` and ``fer`` any word containing it: that is the intended behaviour.

Rules are data: pass your own ``rules`` list to change families or keywords.  The chain stays a
native expression (constant-folded, inside whole-stage codegen); for rule lists in the thousands,
use the rules as a table (``hydrix.operators.rule_tables``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydrix._util import as_col

Rule = tuple[str, Sequence[str]]

# Parameter families and their keywords, in match order, then the fallback label.
DEFAULT_RULES: tuple[Rule, ...] = (
    ("Microbiologie", ("bactérie", "coli", "enterocoque", "coliforme", "spore")),
    ("Chimie_Pesticides", ("nitrate", "nitrite", "pesticide", "atrazine", "glyphosate", "terbutylazine")),
    ("Chimie_Metaux", ("plomb", "cuivre", "aluminium", "chrome", "baryum", "fer", "magnésium")),
    ("Physico-Chimie", ("ph", "conductivité", "température")),
    ("Radioactivité", ("radio", "tritium", "dose")),
)
DEFAULT_CATEGORY = "Autre"


def sql_string(value: str) -> str:
    """A Spark SQL string literal for ``value`` (backslash and quote escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def categorize_sql(column: str, rules: Sequence[Rule] = DEFAULT_RULES, default: str = DEFAULT_CATEGORY) -> str:
    """The same CASE chain as Spark SQL text over a named column."""
    if not rules:
        raise ValueError("rules must not be empty")
    text = f"lower(CAST(`{column.replace('`', '``')}` AS STRING))"
    whens = []
    for label, keywords in rules:
        if not keywords:
            raise ValueError(f"rule {label!r} has no keywords")
        hit = " OR ".join(f"contains({text}, {sql_string(kw.lower())})" for kw in keywords)
        whens.append(f"WHEN {hit} THEN {sql_string(label)}")
    return f"CASE {' '.join(whens)} ELSE {sql_string(default)} END"


def categorize(
    c: Column | str,
    rules: Sequence[Rule] = DEFAULT_RULES,
    default: str = DEFAULT_CATEGORY,
) -> Column:
    """Family label of a parameter name; first matching rule wins, else ``default``.

    For a column name the chain is handed to Spark as one SQL expression (one call instead of one
    per keyword while building the plan); the evaluated expression is the same either way.
    """
    if not rules:
        raise ValueError("rules must not be empty")
    if isinstance(c, str):
        return F.expr(categorize_sql(c, rules, default))
    text = F.lower(as_col(c).cast("string"))
    chain = None
    for label, keywords in rules:
        if not keywords:
            raise ValueError(f"rule {label!r} has no keywords")
        hit = None
        for kw in keywords:
            cond = text.contains(kw.lower())
            hit = cond if hit is None else (hit | cond)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain.otherwise(F.lit(default))
