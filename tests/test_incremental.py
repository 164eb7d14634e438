"""Batches, re-runs and publishing: the same tables as one full build, whatever the order and the failures."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from hydrix import bindings as B
from hydrix.plans import build_silver, gold, incremental, medallion
from hydrix.plans.gold import GoldSpec, build_gold, status_is
from hydrix.plans.incremental import compact_states, merge_batch, publish_gold, read_states, rerun_window
from hydrix.plans.medallion import run_medallion, write_gold
from hydrix.session import scratch_path
from hydrix.sources import Publication, read_parquet, recover, write_parquet

def pred():
    return status_is(B.STATUS_OK)


SPEC = GoldSpec(exact_means=True)


@pytest.fixture(scope="module")
def m(spark):
    # a second year, so that there is more than one partition
    rows = B.m_view(spark, SF_SMALL)
    old = F.when(F.col("event_id") % 4 == 0, F.regexp_replace("date_prelevement", "2024", "2023")).otherwise(F.col("date_prelevement"))
    return read_parquet(spark, write_parquet(rows.withColumn("date_prelevement", old), scratch_path(spark, "t-inc-m")))


@pytest.fixture(scope="module")
def full(spark, m):
    silver = read_parquet(spark, write_parquet(build_silver(m, B.SILVER_SPEC), scratch_path(spark, "t-inc-silver")))
    return _rows(silver), {t: _rows(df) for t, df in build_gold(silver, pred(), SPEC).items()}


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def _batches(m):
    return {f"b{i}": m.filter(F.pmod(F.hash("event_id"), F.lit(3)) == i) for i in range(3)}


def _take(spark, root, name, rows):
    return merge_batch(spark, rows, root, name, pred(), spec=B.SILVER_SPEC, gold_spec=SPEC)


def _check(spark, root, full):
    assert _rows(spark.read.parquet(f"{root}/silver/measurements")) == full[0]
    publish_gold(spark, root, SPEC)
    for t, rows in full[1].items():
        assert _rows(spark.read.parquet(f"{root}/gold/{t}")) == rows, t


def test_batches_in_any_order_give_the_full_build(spark, m, full):
    batches = _batches(m)
    replaced = 0
    for order in (("b0", "b1", "b2"), ("b2", "b0", "b1")):
        root = scratch_path(spark, "t-inc")
        for name in order:
            replaced += _take(spark, root, name, batches[name]).removed
        assert _take(spark, root, order[1], batches[order[1]]).repeated  # again: nothing happens
        _check(spark, root, full)
    assert replaced > 0
    compact_states(spark, root, SPEC)
    assert [r.batch for r in read_states(spark, root).select("batch").distinct().collect()] == ["compacted"]
    _check(spark, root, full)


@pytest.mark.parametrize("step", ["gold_states", "apply_delta", "write_small"])
def test_a_batch_that_died_goes_on(spark, m, full, monkeypatch, step):
    root = scratch_path(spark, "t-inc-fail")
    batches = _batches(m)
    _take(spark, root, "b0", batches["b0"])
    real = getattr(incremental, step)

    def die(*a, **k):
        if step == "apply_delta":
            real(*a, **k)  # it was applied, but nobody knows
        raise RuntimeError("injected")

    monkeypatch.setattr(incremental, step, die)
    with pytest.raises(RuntimeError, match="injected"):
        _take(spark, root, "b1", batches["b1"])
    monkeypatch.setattr(incremental, step, real)
    assert not _take(spark, root, "b1", batches["b1"]).repeated
    _take(spark, root, "b2", batches["b2"])
    _check(spark, root, full)


def _files(path, part):
    folder = f"{path.removeprefix('file:')}/{part}"
    return sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))


def test_untouched_partitions_keep_their_files(spark, m):
    root = scratch_path(spark, "t-inc-files")
    _take(spark, root, "a", m.filter("event_id >= 100"))
    path = f"{root}/silver/measurements"
    before = {p: _files(path, p) for p in ("annee=2023", "annee=2024")}
    only_2023 = m.filter("event_id > 900 and date_prelevement like '2023%'").withColumn("event_id", F.col("event_id") - 5000)
    result = _take(spark, root, "b", only_2023)
    assert result.removed > 0  # lower event ids win: rows were replaced
    assert _files(path, "annee=2024") == before["annee=2024"] and _files(path, "annee=2023") != before["annee=2023"]
    new_rows = only_2023.withColumn("code_prelevement", F.concat(F.lit("new"), F.col("event_id")))
    stored = _files(path, "annee=2023")
    assert _take(spark, root, "c", new_rows).removed == 0
    assert set(stored) < set(_files(path, "annee=2023"))  # appended: no stored file was touched


def test_window_rerun_replaces_only_its_rows(spark, m):
    path = scratch_path(spark, "t-rerun")
    silver = build_silver(m, B.SILVER_SPEC)
    write_parquet(silver, path, partition_by=("annee",))
    before, files = spark.read.parquet(path).collect(), _files(path, "annee=2023")
    window = ("2024-01-10", "2024-01-20")
    fixed = m.withColumn("libelle_unite", F.lit("ug/L"))
    n = rerun_window(spark, fixed, path, window, spec=B.SILVER_SPEC)
    after = spark.read.parquet(path)
    inside = F.coalesce(F.col("date_prelevement_clean").between(*window), F.lit(False))
    assert n == after.filter(inside).count() > 0
    assert {r.libelle_unite for r in after.filter(inside).collect()} == {"ug/L"}
    assert {r.libelle_unite for r in after.filter(~inside).collect()} == {"mg/L"}
    assert after.count() == len(before) and _files(path, "annee=2023") == files
    assert rerun_window(spark, m.filter("false"), path, ("2023-01-01", "2023-12-31"), spec=B.SILVER_SPEC) == 0
    assert spark.read.parquet(path).filter("annee = 2023").count() == 0  # the year lost its rows, not the others
    assert spark.read.parquet(path).filter("annee = 2024 or annee is null").count() > 0


def test_failure_in_the_third_gold_table_leaves_the_former_ones(spark, m, monkeypatch):
    root = scratch_path(spark, "t-publish")
    silver = read_parquet(spark, write_parquet(build_silver(m, B.SILVER_SPEC), f"{root}/silver"))
    write_gold(spark, silver, pred(), f"{root}/gold", SPEC)
    former = {t: _rows(spark.read.parquet(f"{root}/gold/{t}")) for t in gold.GOLD_TABLES}
    real, calls = medallion.write_parquet, []

    def die(df, path, **k):
        calls.append(path)
        if len(calls) == 4:  # the aggregate, then the third table
            raise RuntimeError("injected")
        return real(df, path, **k)

    monkeypatch.setattr(medallion, "write_parquet", die)
    with pytest.raises(RuntimeError, match="injected"):
        write_gold(spark, silver.filter("event_id < 500"), pred(), f"{root}/gold", SPEC)
    monkeypatch.setattr(medallion, "write_parquet", real)
    assert {t: _rows(spark.read.parquet(f"{root}/gold/{t}")) for t in gold.GOLD_TABLES} == former
    assert not os.path.exists(f"{root}/gold/_staged".removeprefix("file:")) or not os.listdir(f"{root}/gold/_staged".removeprefix("file:"))


def test_failed_gate_leaves_the_former_run(spark, m):
    from hydrix.operators.quality import CheckFailed

    root = scratch_path(spark, "t-gate")
    run_medallion(spark, m.filter("date_prelevement not like 'le%'"), root, predicate=pred(), silver_spec=B.SILVER_SPEC)
    former = _rows(spark.read.parquet(f"{root}/silver/measurements")), _rows(spark.read.parquet(f"{root}/gold/conformite_commune"))
    with pytest.raises(CheckFailed):  # bad dates
        run_medallion(spark, m, root, predicate=pred(), silver_spec=B.SILVER_SPEC, on_failure="raise")
    assert former == (_rows(spark.read.parquet(f"{root}/silver/measurements")), _rows(spark.read.parquet(f"{root}/gold/conformite_commune")))


def test_a_switch_that_was_cut_off_is_completed(spark, monkeypatch):
    from hydrix.sources import publish

    root = scratch_path(spark, "t-switch")

    def write(n):
        with Publication(spark, root) as p:
            for name in ("a", "b", "c"):
                write_parquet(spark.range(n), p.path(name))
            p.switch()

    write(3)
    real, calls = publish.rename_path, []

    def die(spark, source, target):
        calls.append(target)
        if len(calls) == 5:  # the journal, a away, a in, b away
            raise RuntimeError("injected")
        real(spark, source, target)

    monkeypatch.setattr(publish, "rename_path", die)
    with pytest.raises(RuntimeError, match="injected"):
        write(5)
    monkeypatch.setattr(publish, "rename_path", real)
    assert recover(spark, root) and not recover(spark, root)
    assert [spark.read.parquet(f"{root}/{t}").count() for t in "abc"] == [5, 5, 5]
    with pytest.raises(ValueError, match="not completely written"):
        with Publication(spark, root) as p:
            p.path("a")
            p.switch()
    assert spark.read.parquet(f"{root}/a").count() == 5
