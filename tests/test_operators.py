"""Operators: conformity, trend, non-conformity, dedup, profiling and checks on hand-made frames."""

import pytest
from pyspark.sql import functions as F

from hydrix.operators import (
    aggregate_consistency,
    assert_checks,
    at_least_mostly,
    between,
    check_between,
    check_min,
    check_min_tolerance,
    check_not_null,
    conformity_by_group,
    count_parse_failures,
    date_window,
    dedup_any,
    dedup_keys,
    dedup_stats,
    describe_numeric,
    distinct_values,
    nonconformity_by_group,
    not_null,
    null_profile,
    numeric_columns,
    numeric_extremes,
    parse_failures,
    require_fields,
    run_checks,
    standardize_columns,
    suite_summary,
    value_counts,
    worst_k,
    yearly_trend,
)
from hydrix.operators.quality import CheckFailed


def test_conformity_null_predicate_counts_in_total_only(spark):
    df = spark.createDataFrame([("g", "A"), ("g", "B"), ("g", None)], "g string, s string")
    r = conformity_by_group(df, ["g"], F.col("s") == "A").first()
    assert (r.total_tests, r.nb_conformes, r.nb_non_conformes) == (3, 1, 1)
    assert r.taux_conformite == pytest.approx(1 / 3)


def test_conformity_requires_group(spark):
    df = spark.createDataFrame([("g", "A")], "g string, s string")
    with pytest.raises(ValueError):
        conformity_by_group(df, [], F.col("s") == "A")
    with pytest.raises(ValueError):
        conformity_by_group(df, ["nope"], F.col("s") == "A")


def test_yearly_trend_nulls(spark):
    df = spark.createDataFrame(
        [(2024, "p", 1.0), (2024, "p", None), (2024, "p", 3.0), (None, "p", 5.0)], "y int, p string, v double"
    )
    rows = {(r.y, r.p): (r.moyenne_resultat, r.nb_mesures) for r in yearly_trend(df, "y", ["p"], "v").collect()}
    assert rows == {(2024, "p"): (2.0, 3), (None, "p"): (5.0, 1)}


def test_nonconformity_drops_null_and_sorts(spark):
    df = spark.createDataFrame(
        [("a", "OK"), ("a", "KO"), ("b", "KO"), ("b", "KO"), ("c", None), ("d", "KO")], "p string, s string"
    )
    rows = [tuple(r) for r in nonconformity_by_group(df, ["p"], F.col("s") == "OK").collect()]
    assert rows == [("b", 2), ("a", 1), ("d", 1)]


def test_value_counts_null_is_a_value(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,)], "c string")
    assert [tuple(r) for r in value_counts(df, "c").collect()] == [("x", 2), (None, 1)]


def test_worst_k_tie_break_and_nulls_first(spark):
    df = spark.createDataFrame(
        [("b", 0.0), ("a", 0.0), ("c", 0.5), ("d", None), ("e", 1.0)], "commune string, taux_conformite double"
    )
    assert [r.commune for r in worst_k(df, 3).collect()] == ["d", "a", "b"]
    with pytest.raises(ValueError):
        worst_k(df, 0)


def test_distinct_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "x string, y int")
    assert distinct_values(df, ["x", "y"]).count() == 2


def test_dedup_null_keys_equal_and_deterministic(spark):
    rows = [("k", None, 3), ("k", None, 1), (None, None, 2), (None, None, 0), ("k", "v", 5)]
    df = spark.createDataFrame(rows, "a string, b string, id int")
    for parts in (1, 3, 7):
        out = dedup_keys(df.repartition(parts), ["a", "b"], ["id"])
        assert sorted(r.id for r in out.collect()) == [0, 1, 5]
    with pytest.raises(ValueError):
        dedup_keys(df, ["a"], [])
    assert dedup_any(df, ["a", "b"]).count() == 3


def test_dedup_stats(spark):
    df = spark.createDataFrame([("k", None), ("k", None), (None, None), ("j", "x")], "a string, b string")
    assert tuple(dedup_stats(df, ["a", "b"]).first()) == (4, 3, 1)
    empty = df.filter("false")
    assert tuple(dedup_stats(empty, ["a"]).first()) == (0, 0, 0)


def test_standardize_and_require(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("b", "x", float("nan"))], "p string, q string, v double")
    out = standardize_columns(df, {"p": "param"})
    assert out.columns == ["param", "q", "v"]
    with pytest.raises(ValueError):
        standardize_columns(df, {"missing": "x"})
    with pytest.raises(ValueError):
        standardize_columns(df, {"p": "q"})
    kept = require_fields(df, ["q", "v"]).collect()  # NaN is not NULL: the row stays
    assert len(kept) == 1 and kept[0].p == "b"


def test_parse_failures(spark):
    df = spark.createDataFrame([("1", 1.0), ("N.M.", None), (None, None)], "raw string, v double")
    assert parse_failures(df, "raw", "v").count() == 1
    assert count_parse_failures(df, "raw", "v").first()[0] == 1


def test_date_window_adds_year_predicate(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.date(2024, 1, d), 2024) for d in (9, 10, 20, 21)], "d date, y int")
    out = date_window(df, "d", "2024-01-10", "2024-01-20", year_col="y")
    assert [r.d.day for r in out.collect()] == [10, 20]


def test_numeric_columns_and_describe(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (3, None, "b")], "i int, d double, s string")
    assert numeric_columns(df) == ["i", "d"]
    rows = {r.column_name: r for r in describe_numeric(df).collect()}
    assert rows["i"].n == 2 and rows["i"].mean == 2.0 and rows["i"].min == 1.0 and rows["i"].max == 3.0
    assert rows["d"].n == 1 and rows["d"].stddev is None
    ext = numeric_extremes(df, "i").first()
    assert (ext["min"], ext["max"], ext["avg"]) == (1.0, 3.0, 2.0)


def test_null_profile_and_empty_table(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    rows = {r.column_name: (r.null_count, r.null_pct) for r in null_profile(df).collect()}
    assert rows == {"a": (1, 25.0), "b": (2, 50.0)}
    empty = {r.column_name: r.null_pct for r in null_profile(df.filter("false")).collect()}
    assert empty == {"a": None, "b": None}


def _results(df):
    return {(r.column_name, r.check_name): r for r in df.collect()}


def test_checks_between_null_passes_and_one_bad_row_fails(spark):
    df = spark.createDataFrame([(2000,), (None,), (2030,)], "y int")
    r = check_between(df, "y", 2000, 2030, "t").first()
    assert (r.unexpected_count, r.total, r.success, r.status) == (0, 3, True, "passed")
    bad = df.union(spark.createDataFrame([(1999,)], "y int"))
    r = check_between(bad, "y", 2000, 2030, "t").first()
    assert (r.unexpected_count, r.success, r.status) == (1, False, "failed")


def test_check_min_strict_and_not_null(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (None, "b")], "n int, s string")
    assert check_min(df, "n", 0, "t", strict=True).first().unexpected_count == 1
    assert check_min(df, "n", 0, "t").first().unexpected_count == 0
    assert check_not_null(df, ["s"], "t").first().unexpected_count == 1


@pytest.mark.parametrize(
    "bad,total,ok",
    [(1, 20, False), (1, 21, True), (0, 0, True), (5, 100, False), (4, 100, True)],
)
def test_tolerance_boundary(spark, bad, total, ok):
    rows = [(-1.0,)] * bad + [(1.0,)] * (total - bad)
    df = spark.createDataFrame(rows, "v double")
    r = check_min_tolerance(df, "v", 0, "t").first()
    assert r.success is ok and r.unexpected_count == bad


def test_absent_column_is_reported_skipped(spark):
    df = spark.createDataFrame([(1,)], "a int")
    res = _results(run_checks(df, [not_null("a"), not_null("gone"), at_least_mostly("gone2", 0)], "t"))
    assert res[("gone", "not_null")].status == "skipped"
    assert res[("gone", "not_null")].success is None and res[("gone", "not_null")].unexpected_count is None
    assert res[("a", "not_null")].status == "passed"
    s = suite_summary(run_checks(df, [not_null("a"), not_null("gone")], "t")).first()
    assert (s.n_rules, s.n_checks, s.n_passed, s.n_failed, s.n_skipped, s.all_passed, s.failed) == (
        2, 1, 1, 0, 1, True, "")


def test_suite_summary_lists_failures(spark):
    df = spark.createDataFrame([(None, 5)], "a int, b int")
    res = run_checks(df, [not_null("a"), between("b", 0, 1), not_null("b")], "t")
    s = suite_summary(res).first()
    assert (s.n_passed, s.n_failed, s.all_passed) == (1, 2, False)
    assert s.failed == "t:between:b,t:not_null:a"
    with pytest.raises(CheckFailed):
        assert_checks(res, "raise")
    assert len(assert_checks(res, "report")) == 3


def test_aggregate_consistency(spark):
    conf = spark.createDataFrame(
        [("a", 3, 1, 2), ("b", 2, 2, 1), (None, 1, 0, 1)], "commune string, total_tests long, nb_conformes long, nb_non_conformes long"
    )
    worst = spark.createDataFrame([("a",), (None,), ("zz",)], "commune string")
    res = {r.check_name: r for r in aggregate_consistency(conf, worst, ["commune"], "c").collect()}
    assert res["rule"].unexpected_count == 1 and res["rule"].success is False  # b: 2 + 1 > 2
    assert res["subset_of"].unexpected_count == 1 and res["subset_of"].total == 3  # zz is not a group


def test_failing_rows_and_report(spark):
    from hydrix.operators import failing_rows, render_report

    df = spark.createDataFrame([(1999,), (2000,), (None,), (2031,)], "y int")
    assert sorted(r.y for r in failing_rows(df, between("y", 2000, 2030)).collect()) == [1999, 2031]
    assert failing_rows(df, not_null("y")).count() == 1
    with pytest.raises(ValueError):
        failing_rows(df, not_null("nope"))
    rows = run_checks(df, [between("y", 2000, 2030), not_null("gone")], "t").collect()
    text = render_report(rows)
    assert "FAIL t.y between 2000 and 2030" in text and "2 of 4 rows unexpected" in text
    assert "SKIP t.gone is not null" in text


def test_scale_conf():
    from hydrix.session import scale_conf

    conf = scale_conf(100 * 10**12)  # 100 TB
    reducers = int(conf["spark.sql.shuffle.partitions"])
    maps = 100 * 10**12 / int(conf["spark.sql.files.maxPartitionBytes"])
    assert maps * reducers <= 1.01 * 10**10
    assert 100 * 10**12 / reducers <= int(conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) * 2 * 1.01
    ten = int(scale_conf(10**15)["spark.sql.shuffle.partitions"])
    assert ten >= 0.99 * reducers  # no cap: partitions grow, their number does not fall
    assert int(scale_conf(10)["spark.sql.shuffle.partitions"]) == 200
    assert int(scale_conf(10**13, shuffle_bytes=10**11)["spark.sql.shuffle.partitions"]) == 373


def test_numeric_profiles_reject_text_columns(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    with pytest.raises(ValueError, match="not numeric"):
        numeric_extremes(df, "s")
    with pytest.raises(ValueError, match="not numeric"):
        describe_numeric(df, ["i", "s"])


def test_orderable_columns_skip_maps_and_variants(spark):
    from hydrix.operators.dedup import orderable_columns

    df = spark.sql("select 1 as k, map('a', 1) as m, parse_json('{\"a\": 1}') as v, array(struct(1 as x)) as s, 'x' as t")
    assert orderable_columns(df, exclude=["k"]) == ["s", "t"]
    assert dedup_keys(df, ["k"], orderable_columns(df, exclude=["k"])).count() == 1


def test_check_subset_with_repeated_parent_keys(spark):
    from hydrix.operators import check_subset

    sup = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    sub = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    r = check_subset(sub, sup, ["k"], "t").first()
    assert (r.total, r.unexpected_count, r.success) == (3, 1, False)


def test_apply_conf_sets_and_returns_previous(spark):
    from hydrix.session import apply_conf, restore_conf, scale_conf

    conf = scale_conf(10**12)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert spark.conf.get(initial, None) is None
    before = apply_conf(spark, conf)
    try:
        assert spark.conf.get("spark.sql.shuffle.partitions") == conf["spark.sql.shuffle.partitions"]
        assert int(conf["spark.sql.files.maxPartitionBytes"]) == 128 << 20  # 1 TB: few enough blocks
    finally:
        restore_conf(spark, before)
    # every option is back, including those that were unset (left set, they would slow the session)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before["spark.sql.shuffle.partitions"]
    assert spark.conf.get(initial, None) is None


def test_row_count_and_select_numeric(spark):
    from hydrix.operators import row_count, select_numeric

    df = spark.createDataFrame([(1, 2.0, "a"), (2, None, "b")], "i int, d double, s string")
    assert row_count(df).first().n_rows == 2 and row_count(df.filter("false")).first().n_rows == 0
    assert select_numeric(df).columns == ["i", "d"]
