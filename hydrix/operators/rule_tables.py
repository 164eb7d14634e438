"""Keyword families (F5) with the rules as a table, for lists that are too long for a CASE chain.

A rule is a row ``(rank, label, keyword)``.  A name belongs to the label of the lowest-ranked rule whose
keyword it contains, both in lower case (equal ranks: the smallest label); names without a hit, NULL and empty
names get the default.  For rules ranked by family this is what ``functions.categorize`` gives.

Only the distinct names are matched.  A keyword that occurs in a name is one of the name's substrings, so the
substrings of the keyword lengths that the rules have are joined with the rules by equality: the work for a
name grows with its length times the number of different keyword lengths, not with the number of rules.  Each
name's best rule is joined back to the rows.  Both join strategies are left to Spark's size checks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrix._util import require_columns
from hydrix.functions.categories import DEFAULT_CATEGORY, DEFAULT_RULES, Rule

RANK, LABEL, KEYWORD = "rank", "label", "keyword"


def rule_table(spark: SparkSession, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """A rule list as a table, ranked in match order."""
    rows = [(i, label, kw) for i, (label, keywords) in enumerate(rules) for kw in keywords]
    return spark.createDataFrame(rows, f"{RANK} int, {LABEL} string, {KEYWORD} string")


def name_labels(names: DataFrame, rules: DataFrame) -> DataFrame:
    """``_name``, ``_label``: the label of every name (lower case, distinct) that a rule fits.

    ``names`` has the one column ``_name``.  Rules with a NULL rank, label or keyword, or an empty keyword,
    fit nothing.  Substrings are generated row by row and reduced to distinct ones per name.
    """
    require_columns(rules, [RANK, LABEL, KEYWORD])
    word = F.lower(F.col(KEYWORD))
    usable = F.col(RANK).isNotNull() & F.col(LABEL).isNotNull() & (F.length(word) > 0)
    best = F.min(F.struct(F.col(RANK), F.col(LABEL))).alias("_best")
    rules = rules.filter(usable).groupBy(word.alias("_word")).agg(best)
    lengths = rules.select(F.array_sort(F.collect_set(F.length("_word")))).scalar()
    size = names.withColumn("_size", F.explode(lengths)).filter(F.col("_size") <= F.length("_name"))
    starts = size.withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("_name") - F.col("_size") + 1)))
    parts = starts.select("_name", F.expr("substring(_name, _at, _size)").alias("_word"))
    hits = parts.join(rules, "_word").groupBy("_name").agg(F.min("_best").alias("_best"))
    return hits.select("_name", F.col(f"_best.{LABEL}").alias("_label"))


def categorize_by_table(
    df: DataFrame, name: str, rules: DataFrame, out: str = "categorie", default: str = DEFAULT_CATEGORY
) -> DataFrame:
    """``df`` with the label of its column ``name`` in ``out`` (replaced if it is there); every row stays."""
    require_columns(df, [name])
    lowered = F.lower(F.col(f"`{name}`").cast("string"))
    found = name_labels(df.select(lowered.alias("_name")).filter(F.length("_name") > 0).distinct(), rules)
    key, label = "_rule_name", "_rule_label"
    while {key, label} & set(df.columns):
        key, label = "_" + key, "_" + label
    found = found.select(F.col("_name").alias(key), F.col("_label").alias(label))
    joined = df.join(found, lowered == F.col(f"`{key}`"), "left")
    return joined.withColumn(out, F.coalesce(F.col(f"`{label}`"), F.lit(default))).drop(key, label)
