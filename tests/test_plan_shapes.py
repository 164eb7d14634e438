"""Physical-plan properties that matter at scale, read from ``explain()``."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from hydrix import bindings as B
from hydrix.operators import require_fields


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(B.QUERIES))
def test_no_python_in_any_plan(spark, name):
    text = plan(E.queries()[name](spark, SF_SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas", text)


def test_dedup_limits_rows_before_the_shuffle(spark):
    text = plan(B.QUERIES["silver_layer"](spark, SF_SMALL), "simple")
    partial = text.index("WindowGroupLimit")  # printed top-down: final first
    assert "Partial" in text and "Final" in text
    lines = [ln for ln in text.splitlines() if "WindowGroupLimit" in ln or "Exchange hashpartitioning" in ln]
    kinds = ["Final" if "Final" in ln else "Partial" if "Partial" in ln else "Exchange" for ln in lines]
    assert kinds == ["Final", "Exchange", "Partial"], lines
    assert partial >= 0


def test_required_fields_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", None, 1)], "a string, b string, c int").write.parquet(path)
    text = plan(require_fields(spark.read.parquet(path), ["a", "b"]).select("c"))
    assert re.search(r"PushedFilters: \[IsNotNull\(a\), IsNotNull\(b\)\]", text)
    assert "ReadSchema: struct<a:string,b:string,c:int>" in text


def test_scans_read_only_needed_columns(spark):
    text = plan(B.QUERIES["conformity_by_group"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in text
    text = plan(B.QUERIES["gold_trend"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in text


def test_aggregates_are_partial_then_final(spark):
    text = plan(B.QUERIES["conformity_by_group"](spark, SF_SMALL), "simple")
    assert text.count("HashAggregate") == 2 and "partial_count" in text
    assert "SortAggregate" not in text


def test_worst_k_is_a_top_k_not_a_sort(spark):
    text = plan(B.QUERIES["worst_k"](spark, SF_SMALL), "simple")
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_checks_are_one_aggregate_pass(spark):
    text = plan(B.QUERIES["silver_gate"](spark, SF_SMALL), "simple")
    # one global aggregate over silver: a single Exchange SinglePartition
    assert text.count("Exchange SinglePartition") == 1
    text = plan(B.QUERIES["null_profile"](spark, SF_SMALL), "simple")
    assert text.count("Exchange SinglePartition") == 1 and text.count("FileScan parquet") == 1
