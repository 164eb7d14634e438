"""Gates from stored states: the rows of a full gate, and only changed partitions are scanned."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from hydrix import bindings as B
from hydrix.operators import quality as Q
from hydrix.operators.check_states import merge_states, partition_states, state_results
from hydrix.operators.quality import run_checks
from hydrix.plans import gate_partitions, gate_states, silver_checks, silver_gate
from hydrix.session import delete_path, scratch_path
from hydrix.sources import read_parquet, write_parquet

BY = "code_dept"


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def silver(spark):
    path = write_parquet(B.silver_m(spark, SF_SMALL), scratch_path(spark, "t-gate-silver"))
    return read_parquet(spark, path).withColumn(BY, F.when(F.col(BY) != "7", F.col(BY)))  # one NULL partition


def _same_as_full(spark, run, path, checks=None):
    assert _rows(run.results) == _rows(silver_gate(read_parquet(spark, path), checks))


def test_states_of_parts_add_up(silver):
    checks = [*silver_checks(), Q.not_null("absent"), Q.at_least_mostly("resultat_valeur_float", 10, 30.0)]
    parts = partition_states(silver, checks, [BY, "annee"])
    whole = run_checks(silver, checks, "silver")
    assert _rows(state_results(parts, checks, "silver", silver.columns)) == _rows(whole)
    assert _rows(state_results(merge_states(parts, BY), checks, "silver", silver.columns)) == _rows(whole)


def test_no_rows(silver):
    checks = [*silver_checks(), Q.not_null("absent")]
    empty = silver.limit(0)
    got = state_results(partition_states(empty, checks, BY), checks, "silver", silver.columns)
    assert _rows(got) == _rows(run_checks(empty, checks, "silver"))
    with pytest.raises(ValueError, match="no check"):
        partition_states(silver, [], BY)
    with pytest.raises(ValueError, match="absent"):
        partition_states(silver, checks, "absent")


@pytest.mark.parametrize("most", [10_000, 1])
def test_only_changed_partitions_are_scanned(spark, silver, monkeypatch, most):
    monkeypatch.setattr(gate_states, "MOST_PARTITIONS", most)
    root = scratch_path(spark, "t-gate")
    path, states = f"{root}/table", f"{root}/states"
    write_parquet(silver.filter(f"{BY} is null or {BY} <> '3'"), path, partition_by=[BY])
    first = gate_partitions(spark, path, states, BY)
    assert (first.scanned, first.reused) == (9, 0)
    _same_as_full(spark, first, path)

    again = gate_partitions(spark, path, states, BY)
    assert (again.scanned, again.reused) == (0, 9)
    _same_as_full(spark, again, path)

    # a new partition, and a second file for the NULL one
    late = silver.filter(f"{BY} = '3' or {BY} is null").withColumn("annee", F.lit(1900))
    write_parquet(late, path, mode="append", partition_by=[BY])
    grown = gate_partitions(spark, path, states, BY)
    assert (grown.scanned, grown.reused) == ((2, 8) if most > 2 else (10, 0))
    _same_as_full(spark, grown, path)

    # a partition that went away is forgotten
    delete_path(spark, f"{path}/{BY}=5")
    shrunk = gate_partitions(spark, path, states, BY)
    assert (shrunk.scanned, shrunk.reused) == (0, 9)
    _same_as_full(spark, shrunk, path)

    # other checks do not use these states
    other = [Q.not_null("commune"), Q.at_least("resultat_valeur_float", 10)]
    changed = gate_partitions(spark, path, states, BY, checks=other)
    assert (changed.scanned, changed.reused) == (9, 0)
    _same_as_full(spark, changed, path, other)


def test_unchanged_partitions_are_not_read(spark, silver, monkeypatch):
    root = scratch_path(spark, "t-gate-unread")
    path, states, read = f"{root}/table", f"{root}/states", []

    def recorded(rows, *args):
        read.append({r[0].split(f"{BY}=")[1].split("/")[0] for r in rows.select("_metadata.file_path").distinct().collect()})
        return partition_states(rows, *args)

    monkeypatch.setattr(gate_states, "partition_states", recorded)
    write_parquet(silver, path, partition_by=[BY])
    gate_partitions(spark, path, states, BY)
    write_parquet(silver.filter(f"{BY} = '3'"), path, mode="append", partition_by=[BY])
    gate_partitions(spark, path, states, BY)
    gate_partitions(spark, path, states, BY)
    assert [len(files) for files in read] == [10, 1, 0] and read[1] == {"3"}


def test_a_column_that_comes_in_voids_the_states(spark, silver):
    root = scratch_path(spark, "t-gate-column")
    path, states = f"{root}/table", f"{root}/states"
    checks = [Q.not_null("extra"), Q.not_null("commune")]
    write_parquet(silver, path, partition_by=[BY])
    assert [r.status for r in gate_partitions(spark, path, states, BY, checks=checks).results.collect()] == ["skipped", "passed"]
    write_parquet(silver.withColumn("extra", F.lit(None).cast("string")), f"{root}/next", partition_by=[BY])
    run = gate_partitions(spark, f"{root}/next", states, BY, checks=checks)
    assert run.reused == 0 and [r.status for r in run.results.collect()] == ["failed", "passed"]
