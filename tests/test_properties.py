"""Property tests: operators against brute-force Python on random small tables and partitionings."""

from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hydrix.operators import (
    at_least_mostly,
    between,
    conformity_by_group,
    dedup_keys,
    dedup_stats,
    not_null,
    null_profile,
    run_checks,
)

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

key = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
status = st.one_of(st.none(), st.sampled_from(["OK", "KO"]))
value = st.one_of(st.none(), st.integers(-5, 40))
rows_st = st.lists(st.tuples(key, key, status, value), min_size=0, max_size=40)


def _df(spark, rows, parts):
    data = [(i, a, b, s, v) for i, (a, b, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, a string, b string, s string, v int")
    return df.repartition(parts) if parts else df


@settings(**SETTINGS)
@given(rows=rows_st, parts=st.integers(0, 5))
def test_dedup_matches_brute_force(spark, rows, parts):
    df = _df(spark, rows, parts)
    got = sorted(r.id for r in dedup_keys(df, ["a", "b"], ["id"]).collect())
    first = {}
    for i, (a, b, _, _) in enumerate(rows):
        first.setdefault((a, b), i)
    assert got == sorted(first.values())
    stats = dedup_stats(df, ["a", "b"]).first()
    assert (stats.rows_before, stats.rows_after) == (len(rows), len(first))


@settings(**SETTINGS)
@given(rows=rows_st, parts=st.integers(0, 5))
def test_conformity_matches_brute_force(spark, rows, parts):
    out = conformity_by_group(_df(spark, rows, parts), ["a"], F.col("s") == "OK").collect()
    got = {r.a: (r.total_tests, r.nb_conformes, r.nb_non_conformes, r.taux_conformite) for r in out}
    exp = defaultdict(lambda: [0, 0, 0])
    for a, _, s, _ in rows:
        exp[a][0] += 1
        exp[a][1] += s == "OK"
        exp[a][2] += s == "KO"
    assert got == {a: (t, ok, ko, ok / t) for a, (t, ok, ko) in exp.items()}


@settings(**SETTINGS)
@given(rows=rows_st, parts=st.integers(0, 5))
def test_checks_match_brute_force(spark, rows, parts):
    res = {
        r.check_name: r
        for r in run_checks(
            _df(spark, rows, parts), [not_null("s"), between("v", 0, 30), at_least_mostly("v", 0, 5.0)], "t"
        ).collect()
    }
    n = len(rows)
    nulls = sum(s is None for _, _, s, _ in rows)
    out_of_range = sum(v is not None and (v < 0 or v > 30) for *_, v in rows)
    negative = sum(v is not None and v < 0 for *_, v in rows)
    assert (res["not_null"].unexpected_count, res["not_null"].success) == (nulls, nulls == 0)
    assert (res["between"].unexpected_count, res["between"].total) == (out_of_range, n)
    pct = negative / n * 100 if n else 0
    assert (res["min_tolerance"].unexpected_count, res["min_tolerance"].success) == (negative, pct < 5.0)


@settings(**SETTINGS)
@given(rows=st.one_of(rows_st, st.lists(st.tuples(key, key, status, value), min_size=32, max_size=32)))
def test_null_profile_matches_brute_force(spark, rows):
    got = {r.column_name: (r.null_count, r.null_pct) for r in null_profile(_df(spark, rows, 0)).collect()}
    n = len(rows)
    cols = {"id": [0] * n, "a": [r[0] for r in rows], "b": [r[1] for r in rows], "s": [r[2] for r in rows],
            "v": [r[3] for r in rows]}
    for c, vals in cols.items():
        z = Counter(v is None for v in vals)[True]
        assert got[c][0] == z
        # Spark's round(): HALF_UP on the double's shortest decimal form
        exp = float(Decimal(repr(z * 100.0 / n)).quantize(Decimal("0.01"), ROUND_HALF_UP)) if n else None
        assert got[c][1] == exp


# keyword fragments (some cut, some upper-cased) mixed with noise, to hit and miss the rules
_FRAGMENTS = ["coli", "Nitrate", "PLOMB", "fer", "ph", "Tritium", "dose", "bactérie", "magnésium", "température",
              "conductivit", "radi", "spore", "é", "E", " ", "x", "o", "-", "(", "3"]


def _family(text):
    from hydrix.functions.categories import DEFAULT_CATEGORY, DEFAULT_RULES

    if text is None:
        return DEFAULT_CATEGORY
    low = text.lower()
    for label, keywords in DEFAULT_RULES:
        if any(k in low for k in keywords):
            return label
    return DEFAULT_CATEGORY


@settings(**SETTINGS)
@given(texts=st.lists(st.one_of(st.none(), st.lists(st.sampled_from(_FRAGMENTS), max_size=5).map("".join)),
                      min_size=1, max_size=30))
def test_categorize_matches_first_rule_model(spark, texts):
    from hydrix.functions import categorize

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, p string")
    rows = df.select("i", categorize("p").alias("by_name"), categorize(F.col("p")).alias("by_column")).collect()
    for r in rows:
        assert r.by_name == r.by_column == _family(texts[r.i]), texts[r.i]
