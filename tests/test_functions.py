"""Hand-written cases for the column functions (dates, lab-result parser, keyword families, ratios)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydrix.functions import (
    categorize,
    in_window,
    is_censored,
    iso_date_part,
    parse_date,
    parse_measurement,
    percentage,
    ratio,
    year_of,
)


def f32(x):
    return None if x is None else float(np.float32(x))


def _one_col(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {dtype}")
    rows = df.select("i", expr_fn(F.col("s")).alias("out")).orderBy("i").collect()
    return [r["out"] for r in rows]


PARSE_CASES = [
    (None, None),
    ("0,010", 0.010),
    ("<0,005", 0.005),
    ("< 0,005", 0.005),
    (" 12.5 ", 12.5),
    ("\t5", 5.0),
    ("1e3", 1000.0),
    ("-5", -5.0),
    (".5", 0.5),
    ("5.", 5.0),
    ("+7", 7.0),
    (" 3,5 ", 3.5),  # no-break spaces around the value
    ("< 0,5", 0.5),
    ("", None),
    ("<", None),
    (">100", None),
    ("<=0,5", None),
    ("N.M.", None),
    ("1 000", None),
    ("1,234.5", None),
    ("1.0d", None),
    ("0x10", None),
    ("nan", None),
    ("inf", None),
    ("1_000", None),
    ("١٢", None),  # non-ASCII digits
]


def test_parse_measurement_hand_cases(spark):
    got = _one_col(spark, [c[0] for c in PARSE_CASES], parse_measurement)
    assert got == [f32(c[1]) for c in PARSE_CASES]


def test_parse_measurement_is_float32(spark):
    df = spark.createDataFrame([("0,005",)], "s string").select(parse_measurement("s").alias("v"))
    assert df.schema["v"].dataType.typeName() == "float"
    assert df.first()["v"] == f32(0.005) != 0.005


def test_parse_measurement_censored_null(spark):
    values = ["<0,005", "0,010", None, " < 1", "N.M."]
    got = _one_col(spark, values, lambda c: parse_measurement(c, censored="null"))
    assert got == [None, f32(0.010), None, None, None]


def test_parse_measurement_bad_policy():
    with pytest.raises(ValueError):
        parse_measurement("x", censored="zero")


def test_is_censored(spark):
    assert _one_col(spark, ["<1", " <1", "1", None], is_censored) == [True, True, False, None]


CATEGORY_CASES = [
    (None, "Autre"),
    ("", "Autre"),
    ("Escherichia coli", "Microbiologie"),
    ("Bactéries coliformes", "Microbiologie"),
    ("Nitrates (en NO3)", "Chimie_Pesticides"),
    ("Glyphosate", "Chimie_Pesticides"),  # contains "ph" too; the earlier rule wins
    ("Plomb", "Chimie_Metaux"),
    ("Fer total", "Chimie_Metaux"),
    ("Coefficient de transfert", "Chimie_Metaux"),  # "fer" inside a word
    ("pH", "Physico-Chimie"),
    ("TEMPÉRATURE", "Physico-Chimie"),
    ("Phosphore", "Physico-Chimie"),  # substring overreach is the intended behaviour
    ("Conductivité à 25°C", "Physico-Chimie"),
    ("Tritium", "Radioactivité"),
    ("Dose totale indicative", "Radioactivité"),
    ("Entérocoques", "Autre"),  # accent not in the keyword
    ("Chlore libre", "Autre"),
]


def test_categorize_hand_cases(spark):
    got = _one_col(spark, [c[0] for c in CATEGORY_CASES], categorize)
    assert got == [c[1] for c in CATEGORY_CASES]


def test_categorize_custom_rules(spark):
    rules = [("A", ["x"]), ("B", ["y", "X"])]
    assert _one_col(spark, ["xy", "Y", "z", None], lambda c: categorize(c, rules, "none")) == ["A", "B", "none", "none"]
    with pytest.raises(ValueError):
        categorize("s", [])


def test_parse_date_never_raises(spark):
    values = ["2026-01-05T10:00:00Z", None, "bad", "", "2026-13-01", "2026-02-30T00:00:00Z"]
    got = _one_col(spark, values, parse_date)
    assert got == [dt.date(2026, 1, 5), None, None, None, None, None]
    assert _one_col(spark, values[:2], lambda c: year_of(parse_date(c))) == [2026, None]


def test_iso_date_part(spark):
    assert _one_col(spark, ["2026-01-05T10:00:00Z", "2026-01-05", "", None], iso_date_part) == [
        "2026-01-05", "2026-01-05", None, None]


def test_in_window(spark):
    df = spark.createDataFrame([(dt.date(2026, 1, d),) for d in (1, 10, 20, 21)] + [(None,)], "d date")
    got = [r[0] for r in df.select(in_window("d", "2026-01-10", "2026-01-20")).collect()]
    assert got == [False, True, True, False, None]
    with pytest.raises(ValueError):
        in_window("d", "2026-02-01", "2026-01-01")


def test_ratio_and_percentage(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (None, 2)], "a long, b long")
    rows = df.select(ratio("a", "b").alias("r"), percentage("a", "b").alias("p")).collect()
    assert rows[0]["r"] == 1 / 3 and rows[0]["p"] == 33.33
    assert rows[1]["r"] is None and rows[1]["p"] is None  # no ANSI divide-by-zero error
    assert rows[2]["r"] is None


def test_non_string_inputs_are_read_as_text(spark):
    df = spark.createDataFrame([(0.005, 7), (None, None)], "d double, n int")
    rows = df.select(parse_measurement("d").alias("v"), parse_measurement(F.col("n")).alias("w"),
                     categorize("n").alias("c")).collect()
    assert (rows[0].v, rows[0].w, rows[0].c) == (f32(0.005), 7.0, "Autre")
    assert (rows[1].v, rows[1].w, rows[1].c) == (None, None, "Autre")
