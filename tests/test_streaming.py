"""Incremental page ingest: each landed file is ingested exactly once across restarts."""

import pytest

from hydrix.session import scratch_path
from hydrix.sources import crawl_landed, crawl_pages, page_rows, page_stats, write_pages
from hydrix.streaming import ingest_pages, land_pages

SCHEMA = "id long, name string, v double"


def test_ingest_pages_once_per_file(spark):
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(SCHEMA)
    root = scratch_path(spark, "t-stream")
    landing, bronze, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/ckpt"

    first = spark.createDataFrame([(i, f"n{i}", i * 0.5) for i in range(30)], SCHEMA)
    write_pages(first, f"{landing}/batch1", 10, "id")
    q = ingest_pages(spark, f"{landing}/*", bronze, schema, checkpoint=ckpt)
    q.awaitTermination()
    assert spark.read.parquet(bronze).count() == 30

    # restart with the same checkpoint: old files are not read again, new ones are
    second = spark.createDataFrame([(i, f"n{i}", i * 0.5) for i in range(30, 45)], SCHEMA)
    write_pages(second, f"{landing}/batch2", 10, "id")
    q = ingest_pages(spark, f"{landing}/*", bronze, schema, checkpoint=ckpt)
    q.awaitTermination()
    back = spark.read.parquet(bronze)
    assert back.count() == 45
    assert sorted(r.id for r in back.collect()) == list(range(45))


def _landing(spark, root):
    from pyspark.sql.types import _parse_datatype_string

    first = spark.createDataFrame([(i, f"n{i}", i * 0.5) for i in range(10)], SCHEMA)
    write_pages(first, f"{root}/landing/batch1", 10, "id")
    return _parse_datatype_string(SCHEMA)


def test_second_run_without_a_named_checkpoint_goes_on(spark):
    root = scratch_path(spark, "t-stream-default")
    schema = _landing(spark, root)
    ingest_pages(spark, f"{root}/landing/*", f"{root}/bronze", schema).awaitTermination()
    write_pages(spark.createDataFrame([(i, "x", 0.0) for i in range(10, 25)], SCHEMA), f"{root}/landing/batch2", 10, "id")
    ingest_pages(spark, f"{root}/landing/*", f"{root}/bronze", schema).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{root}/bronze").collect()) == list(range(25))
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest_pages(spark, f"{root}/landing/*", f"{root}/bronze", schema, checkpoint=f"{root}/fresh")


def test_malformed_page_stops_the_ingest(spark):
    import os

    root = scratch_path(spark, "t-stream-bad")
    schema = _landing(spark, root)
    os.makedirs(f"{root}/landing/bad".removeprefix("file:"))
    with open(f"{root}/landing/bad/p.json".removeprefix("file:"), "w") as f:
        f.write('{"data": [{"id": 1\n')
    with pytest.raises(Exception, match="malformed page envelope"):
        ingest_pages(spark, f"{root}/landing/*", f"{root}/strict", schema).awaitTermination()
    ingest_pages(spark, f"{root}/landing/*", f"{root}/bronze", schema, on_malformed="skip").awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == 10


def _land(spark, root, pages):
    """Lands ``(page, ids or None, next)`` envelopes, one file per call; the landed Parquet."""
    import json
    import os

    folder = f"{root}/landing/b{len(os.listdir(f'{root}/landing'.removeprefix('file:'))) if os.path.isdir(f'{root}/landing'.removeprefix('file:')) else 0}"
    os.makedirs(folder.removeprefix("file:"))
    with open(f"{folder}/p.json".removeprefix("file:"), "w") as f:
        for page, ids, link in pages:
            data = None if ids is None else [{"id": i, "name": f"n{i}", "v": 0.5} for i in ids]
            f.write(json.dumps({"page": page, "data": data, "next": link}) + "\n")
    schema = spark.createDataFrame([], SCHEMA).schema
    land_pages(spark, f"{root}/landing/*", f"{root}/pages", schema).awaitTermination()
    return spark.read.parquet(f"{root}/pages")


def _ids(pages):
    return sorted(r.id for r in page_rows(pages).collect())


def test_landed_pages_follow_the_paging_rules(spark):
    root = scratch_path(spark, "t-landed")
    landed = _land(spark, root, [(1, [1, 2], "p2"), (1, [1, 2], "p2"), (2, [3], "p3"), (2, [], "p3"), (3, [4], "p4")])
    assert _ids(crawl_landed(landed)) == [1, 2, 3, 4]  # no end yet
    # the second run adds the end page, a late page, and a fuller copy of page 3
    landed = _land(spark, root, [(4, None, "p5"), (5, [9], "p6"), (3, [4, 5], "p4"), (1, [1, 2], "p2")])
    assert _ids(crawl_landed(landed)) == [1, 2, 3, 4, 5]
    assert _ids(crawl_landed(landed, end_page=5)) == [1, 2, 3, 4, 5, 9]
    assert _ids(crawl_pages(landed)) == [1, 2, 3, 4, 5]
    plain = crawl_pages(landed.select("page", "data", "next"))  # without the manifest: the same pages
    assert _ids(plain) == [1, 2, 3, 4, 5]
    stats = page_stats(landed, page_col="page").first()
    assert stats == page_stats(landed.select("page", "data", "next"), page_col="page").first()
    assert (stats.end_page, stats.n_pages, stats.n_repeated_pages) == (4, 9, 4)


def test_landed_pages_are_opened_once(spark):
    root = scratch_path(spark, "t-landed-plan")
    landed = _land(spark, root, [(1, [1], "p2"), (1, [1], "p2"), (2, [2], None)])
    plan = page_rows(crawl_landed(landed))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    schemas = [line.split("ReadSchema:")[1] for line in physical.splitlines() if "ReadSchema:" in line]
    assert sum("data:array" in s for s in schemas) == 1


def test_landed_page_without_a_number(spark):
    root = scratch_path(spark, "t-landed-null")
    landed = _land(spark, root, [(1, [1], "p2"), (None, [7], "p3"), (2, [2], None)])
    with pytest.raises(Exception, match="without a number, rows: 1"):
        crawl_landed(landed).collect()
    assert _ids(crawl_landed(landed, on_malformed="skip")) == [1, 2]
    assert crawl_landed(landed.limit(0).filter("false"), on_malformed="skip").count() == 0
