"""Rules as a table give the labels of the CASE chain, for any number of rules."""

import random

import pytest

from hydrix.functions import categorize
from hydrix.operators import categorize_by_table, rule_table
from hydrix.operators.rule_tables import KEYWORD, LABEL, RANK

SCHEMA = f"{RANK} int, {LABEL} string, {KEYWORD} string"


def _labels(df, out="categorie"):
    return sorted((r["id"], r[out]) for r in df.select("id", out).collect())


def test_random_rules_match_the_chain(spark):
    rng = random.Random(3)
    word = lambda lo, hi: "".join(rng.choice("abÉé'\\") for _ in range(rng.randint(lo, hi)))
    rules = [(f"f{i % 9}", tuple(word(2, 5) for _ in range(3))) for i in range(40)]
    names = [word(0, 12) for _ in range(300)] + [None, "", "a"] + ["ab" * 5000]
    df = spark.createDataFrame(list(enumerate(names * 2)), "id int, name string")
    got = categorize_by_table(df, "name", rule_table(spark, rules))
    assert got.columns == ["id", "name", "categorie"]
    assert _labels(got) == _labels(df.withColumn("categorie", categorize("name", rules)))


def test_thousands_of_rules(spark):
    rules = spark.range(5000).selectExpr(f"cast(id as int) as {RANK}", f"'f' || id % 7 as {LABEL}", f"'k' || id || '.' as {KEYWORD}")
    df = spark.range(20_000).selectExpr("cast(id as int) as id", "'x k' || id % 6000 || '. K' || id % 50 || '.' as name")
    got = dict(_labels(categorize_by_table(df, "name", rules)))
    for i in (0, 7, 4999, 5000, 5999, 19_999):
        first = min([i % 50] + ([i % 6000] if i % 6000 < 5000 else []))
        assert got[i] == f"f{first % 7}"
    assert len(got) == 20_000


def test_odd_rules_and_ties(spark):
    rules = spark.createDataFrame(
        [(1, "b", "xx"), (1, "a", "XX"), (0, None, "xx"), (None, "n", "xx"), (0, "empty", ""), (0, "null", None), (2, "late", "x")], SCHEMA)
    df = spark.createDataFrame([(0, "oXXo"), (1, "x"), (2, None), (3, ""), (4, "y")], "id int, name string")
    assert _labels(categorize_by_table(df, "name", rules, default="d")) == [(0, "a"), (1, "late"), (2, "d"), (3, "d"), (4, "d")]
    none = spark.createDataFrame([], SCHEMA)
    assert _labels(categorize_by_table(df, "name", none, default="d")) == [(i, "d") for i in range(5)]
    assert categorize_by_table(df.limit(0), "name", rules).count() == 0


def test_columns_with_helper_names_stay(spark):
    df = spark.createDataFrame([(0, "pH", 7, 8, "old", 9)], "id int, name string, _rule_name int, _rule_label int, categorie string, _name int")
    (row,) = categorize_by_table(df, "name", rule_table(spark)).collect()
    assert row == (0, "pH", 7, 8, "Physico-Chimie", 9)
    with pytest.raises(ValueError, match="absent"):
        categorize_by_table(df, "absent", rule_table(spark))
