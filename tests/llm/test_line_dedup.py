"""Line dedup against a plain version, hot lines, odd rows and column names."""

import random

import pytest
from pyspark.sql import functions as F

from hydrix.llm import heavy
from hydrix.llm.line_dedup import BLANKS, drop_shared_lines, without_lines

SCHEMA = "doc_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_version(rows, least_chars=20, least_docs=3):
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(doc)
    last = {k: max(v, key=lambda d: (d is not None, d)) for k, v in holders.items() if len(v) >= least_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc]
        out.append((doc, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def found(spark, rows, **options):
    table = drop_shared_lines(spark.createDataFrame(rows, SCHEMA), **options)
    return sorted(((r.doc_id, r.text, r.lines.n_lines, r.lines.n_dropped) for r in table.collect()), key=str)


def test_random_texts(spark):
    rng = random.Random(2)
    pool = ["short", "", "   ", "A long line of more than twenty letters", "a LONG line of more than twenty letters \t",
            "Élan vital: une ligne bien assez longue", "élan vital: une ligne bien assez longue", "漢字" * 12, "x" * 20, "X" * 19]
    rows = [(i, "\n".join(rng.choice(pool) + (str(rng.randrange(40)) if rng.random() < 0.5 else "") for _ in range(rng.randrange(0, 9)))) for i in range(300)]
    assert found(spark, rows) == plain_version(rows)
    assert found(spark, rows, least_chars=1, least_docs=2) == plain_version(rows, 1, 2)


def test_odd_rows(spark):
    line = "this line is in many of the documents"
    rows = [(1, line), (2, f"{line}\n"), (3, f"\n{line}\n{line}\nown"), (None, f"{line}\nnull id"), (None, f"{line}\nnull id"),
            (5, None), (6, ""), (7, "\r\n" + line + "\r"), (7, f"second row of an id\n{line}"), (4, f"{line}\n\n\n")]
    want = plain_version(rows)
    assert found(spark, rows) == want
    assert (1, "", 1, 1) in want and (5, None, 1, 0) in want  # all lines gone; a null text stays null
    two_docs = [(1, line), (1, line), (2, line), (2, f"{line}\n{line}")]
    assert found(spark, two_docs) == plain_version(two_docs)  # repeated rows are not more documents


def test_hot_line_and_repeated_rows(spark):
    hot, warm = "a line that a third of all documents hold", "a line that some documents hold"
    rows = [(i, f"{hot}\nown words of document {i}\n{hot}" if i % 3 else f"{warm} \nnothing of note here {i}") for i in range(3000)]
    rows += [(9000, f"{hot}\nthe same row many times over")] * 1500
    assert found(spark, rows) == plain_version(rows)


def test_long_text(spark):
    shared = [f"a shared line with the number {i}" for i in range(30000)]
    rows = [(d, "\n".join(x for i, x in enumerate(shared) if i % 2 or d)) for d in range(4)]
    assert found(spark, rows) == plain_version(rows)


def test_runs_between_positions(spark):
    table = spark.createDataFrame([("a\nb\nc\nd", p) for p in ([], [0], [3], [0, 1, 2, 3], [1, 2])], "text string, p array<int>")
    got = [r[0] for r in table.select(without_lines(F.col("text"), F.col("p"))).collect()]
    assert got == ["a\nb\nc\nd", "b\nc\nd", "a\nb\nc", "", "a\nd"]


def test_empty_table_and_other_columns(spark):
    assert found(spark, []) == []
    names = "doc_id long, text string, dropped int, doc string, text1 int, line1 int, salt int, heavy int, lines int, pos int"
    rows = [(i, "one line that all documents here share", 1, "d", 2, 3, 4, 5, 6, 7) for i in range(3)]
    table = drop_shared_lines(spark.createDataFrame(rows, names))
    assert table.columns == ["doc_id", "text", "dropped", "doc", "text1", "line1", "salt", "heavy", "pos", "lines"]
    assert sorted((r.doc_id, r.text, r.dropped, r.doc, r.text1, r.line1, r.salt, r.heavy, r.pos) for r in table.collect()) == [
        (i, "" if i < 2 else rows[0][1], 1, "d", 2, 3, 4, 5, 7) for i in range(3)
    ]


def test_only_dataframe_functions(spark):
    table = drop_shared_lines(spark.createDataFrame([(1, "x")], SCHEMA))
    assert "Python" not in table._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [4, 4096])
def test_join_by_key_keeps_every_row(spark, monkeypatch, most):
    monkeypatch.setattr(heavy, "MOST", most)
    rows = [(k, i) for i, k in enumerate([None] * 40 + [1] * 60 + [2] * 5 + [3, 4, 9])]
    table = spark.createDataFrame(rows, "k long, salt int")
    sums = table.where("k is null or k < 9").groupBy("k").agg(F.count(F.lit(1)).alias("rows"))
    got = heavy.join_by_key(table, sums, ["k"], F.col("rows"), len(rows), F.col("salt")).collect()
    size = {None: 40, 1: 60, 2: 5, 3: 1, 4: 1, 9: None}
    assert sorted((r.salt, r.k, r.rows) for r in got) == [(i, k, size[k]) for k, i in rows]
