"""Readers/writers: JSON Lines and Parquet round trips, missing input, self-overwrite guard, pages."""

import json
import os

import pytest
from pyspark.errors import AnalysisException

from hydrix.session import scratch_path
from hydrix.sources import (
    page_rows,
    page_stats,
    preview_rows,
    read_json,
    read_pages,
    read_parquet,
    schema_text,
    write_json,
    write_pages,
    write_parquet,
    written_counts,
)

ROW_SCHEMA = "id long, name string, v double"


@pytest.fixture()
def small(spark):
    return spark.createDataFrame([(i, f"n{i % 3}", i / 4) for i in range(25)], ROW_SCHEMA)


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_jsonl_roundtrip_declared_schema(spark, small):
    path = write_json(small, scratch_path(spark, "t-json"))
    back = read_json(spark, path, small.schema)
    assert back.schema == small.schema
    assert sorted(back.collect()) == sorted(small.collect())


def test_json_inferred_and_corrupt_lines(spark):
    d = _local(scratch_path(spark, "t-corrupt"))
    os.makedirs(d)
    with open(f"{d}/part.json", "w") as f:
        f.write('{"a": 1, "t": "2026-01-05T10:00:00Z"}\nnot json\n')
    df = read_json(spark, d)
    assert "_corrupt_record" in df.columns
    assert dict(df.dtypes)["t"] == "string"


def test_parquet_roundtrip_and_verify(spark, small):
    path = write_parquet(small, scratch_path(spark, "t-pq"))
    assert sorted(read_parquet(spark, path).collect()) == sorted(small.collect())
    counts = {r["name"]: r["count"] for r in written_counts(spark, path, "name").collect()}
    assert counts == {"n0": 9, "n1": 8, "n2": 8}


def test_missing_input_policy(spark):
    missing = scratch_path(spark, "t-missing")
    assert read_parquet(spark, missing, on_missing="skip") is None
    assert read_json(spark, missing, on_missing="skip") is None
    with pytest.raises(AnalysisException):
        read_parquet(spark, missing)
    with pytest.raises(ValueError):
        read_parquet(spark, missing, on_missing="ignore")


def test_refuses_to_overwrite_own_input(spark, small):
    path = write_parquet(small, scratch_path(spark, "t-self"))
    df = read_parquet(spark, path)
    with pytest.raises(ValueError, match="refusing"):
        write_parquet(df.filter("id > 3"), path)
    assert read_parquet(spark, path).count() == 25  # the input is intact


def test_overwrite_guard_compares_qualified_paths(spark, small, tmp_path, monkeypatch):
    spaced = write_parquet(small, str(tmp_path / "with space" / "t"))
    for target in (spaced, f"file:{spaced}", f"file://{spaced}/", str(tmp_path / "with space")):
        with pytest.raises(ValueError, match="refusing"):
            write_parquet(read_parquet(spark, spaced), target)
    with pytest.raises(ValueError, match="refusing"):  # read through a subquery
        spark.read.parquet(spaced).createOrReplaceTempView("t_self")
        write_parquet(spark.sql("select 1 as one where exists (select * from t_self)"), spaced)
    import os

    relative = os.path.relpath(spaced)  # the JVM resolves it against the folder it was started in
    with pytest.raises(ValueError, match="refusing"):
        write_parquet(read_parquet(spark, relative), spaced)
    assert read_parquet(spark, spaced).count() == 25


def test_write_pages_and_read_back(spark, small):
    path = write_pages(small, scratch_path(spark, "t-pages"), 10, "id")
    pages = read_pages(spark, path, small.schema)
    envelopes = sorted((len(r["data"]), r["next"]) for r in pages.collect())
    assert envelopes == [(5, None), (10, "page=1"), (10, "page=2")]
    assert sorted(page_rows(pages).collect()) == sorted(small.collect())
    s = page_stats(pages).first()
    assert (s.n_pages, s.n_rows, s.n_empty_pages, s.has_last_page) == (3, 25, 0, True)


def test_multiline_pages_empty_page_and_missing_last(spark):
    d = _local(scratch_path(spark, "t-ml"))
    os.makedirs(d)
    pages = [
        {"data": [{"id": 1, "name": "a", "v": 0.5}, {"id": 2, "name": "b", "v": None}], "next": "p2"},
        {"data": [], "next": "p3"},
    ]
    for i, p in enumerate(pages):
        with open(f"{d}/page{i}.json", "w") as f:
            json.dump(p, f, indent=2)
    from pyspark.sql.types import _parse_datatype_string

    env = read_pages(spark, d, _parse_datatype_string(ROW_SCHEMA), multiline=True)
    assert sorted(r.id for r in page_rows(env).collect()) == [1, 2]
    s = page_stats(env).first()
    assert (s.n_pages, s.n_rows, s.n_empty_pages, s.has_last_page) == (2, 2, 1, False)


def test_preview(spark, small):
    rows = preview_rows(small, 3, cols=["id", "name"], order_by=["id"]).collect()
    assert [tuple(r) for r in rows] == [(0, "n0"), (1, "n1"), (2, "n2")]
    assert preview_rows(small, 4).count() == 4
    assert "name: string" in schema_text(small)
    with pytest.raises(ValueError):
        preview_rows(small, 0)


def test_json_malformed_lines_visible_or_fatal(spark):
    d = _local(scratch_path(spark, "t-bad-json"))
    os.makedirs(d)
    with open(f"{d}/part.json", "w") as f:
        f.write('{"id": 1, "name": "a", "v": 0.5}\n{broken\n{"id": 3, "name": "c", "v": 1.5}\n')
    df = read_json(spark, d, ROW_SCHEMA, corrupt_column="_bad").cache()
    assert df.count() == 3 and df.filter("_bad IS NOT NULL").count() == 1
    assert df.filter("_bad IS NULL").count() == 2
    df.unpersist()
    with pytest.raises(Exception):
        read_json(spark, d, ROW_SCHEMA, mode="FAILFAST").collect()
    assert read_json(spark, d, ROW_SCHEMA, mode="DROPMALFORMED").count() == 2
    with pytest.raises(ValueError):
        read_json(spark, d, ROW_SCHEMA, mode="LENIENT")


def test_crawl_follows_the_paging_rules(spark):
    from pyspark.sql.types import _parse_datatype_string

    from hydrix.sources import crawl_pages, envelope_schema

    row = _parse_datatype_string(ROW_SCHEMA)
    env = [
        (0, [(1, "a", 0.5), (2, "b", None)], "p1"),
        (1, [(3, "c", 1.0)], "p2"),
        (1, [(3, "c", 1.0)], "p2"),  # re-requested page
        (2, [], "p3"),  # empty page: the crawl stops here
        (3, [(9, "z", 9.0)], None),  # never reached
    ]
    pages = spark.createDataFrame(env, envelope_schema(row, with_page=True))
    assert sorted(r.id for r in page_rows(pages, page_col="page").collect()) == [1, 2, 3]
    assert sorted(r.page for r in crawl_pages(pages).collect()) == [0, 1, 2]
    s = page_stats(pages, page_col="page").first()
    assert (s.n_pages, s.n_rows, s.end_page, s.n_repeated_pages, s.n_pages_after_end) == (5, 5, 2, 1, 1)
    # no end page landed yet: every page is kept
    open_ended = pages.filter("page < 2")
    assert sorted(r.id for r in page_rows(open_ended, page_col="page").collect()) == [1, 2, 3]
    assert page_stats(open_ended, page_col="page").first().end_page is None
    # a page without "next" ends the crawl after its own rows
    last = spark.createDataFrame([(0, [(1, "a", 0.5)], None), (1, [(2, "b", 1.0)], None)],
                                 envelope_schema(row, with_page=True))
    assert [r.id for r in page_rows(last, page_col="page").collect()] == [1]


def test_empty_copy_and_malformed_page(spark, small):
    from hydrix.sources import crawl_pages

    path = write_pages(small, scratch_path(spark, "t-pages-bad"), 10, "id", with_page=True)
    pages = read_pages(spark, path, small.schema, with_page=True)
    empty = pages.filter("page = 1").selectExpr("page", "slice(data, 1, 0) as data", "cast(null as string) as next", "_corrupt_page")
    landed = pages.unionByName(empty)
    assert sorted(page_rows(landed, page_col="page").collect()) == sorted(small.collect())
    s = page_stats(landed.filter("page <> 1 or size(data) = 0"), page_col="page").first()
    assert (s.end_page, s.n_missing_pages, s.n_malformed) == (1, 0, 0)
    gap = page_stats(pages.filter("page <> 1"), page_col="page").first()
    assert (gap.n_missing_pages, gap.end_page, gap.has_last_page) == (1, 2, True)
    local = path.removeprefix("file:")
    with open(f"{local}/zz.json", "w") as f:
        f.write('{"page": 5, "data": [{"id"\n')
    broken = read_pages(spark, path, small.schema, with_page=True)
    s = page_stats(broken, page_col="page").first()
    assert (s.n_malformed, s.n_pages, s.end_page) == (1, 3, 2)
    assert page_stats(broken).first().n_malformed == 1
    with pytest.raises(Exception, match="malformed page envelope"):
        page_rows(broken).collect()
    assert page_rows(broken, page_col="page", on_malformed="skip").count() == 25
    plan = crawl_pages(broken, on_malformed="skip")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(page") <= 1  # the few repeated pages only


def test_write_pages_with_page_numbers(spark, small):
    path = write_pages(small, scratch_path(spark, "t-pages-n"), 10, "id", with_page=True)
    pages = read_pages(spark, path, small.schema, with_page=True)
    assert sorted((r.page, r.next) for r in pages.collect()) == [(0, "page=1"), (1, "page=2"), (2, None)]
    assert sorted(page_rows(pages, page_col="page").collect()) == sorted(small.collect())


def test_crawl_with_known_end_page(spark):
    from pyspark.sql.types import _parse_datatype_string

    from hydrix.sources import crawl_pages, envelope_schema

    row = _parse_datatype_string(ROW_SCHEMA)
    env = [(0, [(1, "a", 0.5)], "p1"), (1, [(2, "b", 1.0)], "p2"), (2, [(3, "c", 2.0)], "p3")]
    pages = spark.createDataFrame(env, envelope_schema(row, with_page=True))
    assert sorted(r.page for r in crawl_pages(pages, end_page=1).collect()) == [0, 1]
