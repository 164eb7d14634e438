"""Fill-in-the-middle: the skip list against plain sums, the operator against a plain version, odd rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from hydrix.llm import fill_middle
from hydrix.llm.fill_middle import SkipList, fill_in_middle, restore_text

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 17, 300, 5000])
def test_every_rank_is_reached_exactly(n):
    rng = random.Random(n)
    widths = [rng.choice([1, 1, 2, 40, 1000]) for _ in range(n)]
    units = SkipList(list(widths))
    before = [0]
    for w in widths:
        before.append(before[-1] + w)
    longest = 0
    for rank in range(n + 1):
        points, steps = units.cut(rank)
        assert points == before[rank]
        longest = max(longest, steps)
    assert longest <= 8 * 4 * max(1, n.bit_length())  # some links a lane, not one a unit
    with pytest.raises(ValueError):
        units.cut(n + 1)


def test_express_lanes_carry_summed_widths():
    units = SkipList(list(range(1, 2001)))
    assert len(units.lanes) > 3
    for lane, (steps, points, below) in enumerate(units.lanes):
        assert sum(steps) == 2000 and sum(points) == 2001000
        if below is not None:
            lower_steps, lower_points, _ = units.lanes[lane - 1]
            for i in range(len(steps)):
                assert steps[i] == sum(lower_steps[below[i] : below[i + 1]])
                assert points[i] == sum(lower_points[below[i] : below[i + 1]])


def plain_version(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return len(lines), "plain", text, None, None
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < 50:
        return len(lines), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(lines), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def check(spark, rows):
    made = fill_in_middle(spark.createDataFrame(rows, SCHEMA))
    found = made.select("doc_id", "text", "fim.*", restore_text(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    for got, (doc_id, text) in zip(sorted(found, key=key), sorted(rows, key=key), strict=True):
        want = plain_version(doc_id, text)
        assert (got.n, got.form, got.output, got.prefix_chars, got.middle_chars) == want
        assert got.back == (text or "")
    return found


def test_odd_texts(spark):
    texts = [None, "", "\n", "\n\n\n", "one line", "a\nb", "a\nb\n", "<P>\nx", "x\n<M>", "<\nS>\n<P\n>", "é😀\n漢字\r\nz\n" * 50,
             "ends in <\n<S\nM>", "x" * 100000, "\n".join("line %d" % i for i in range(30000))]
    rows = [(i, t) for i, t in enumerate(texts * 6)] + [(None, "a\nb\nc\n"), (None, None), (3, "same\nrow\n"), (3, "same\nrow\n")]
    found = check(spark, rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_random_texts(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab\n<>PSM é") for _ in range(rng.randrange(0, 60)))) for i in range(600)]
    check(spark, rows)


def test_very_long_text(spark):
    text = "".join(f"ligne {i} é\n" for i in range(400000))
    check(spark, [(9, text), (10, text)])


def test_empty_table_and_other_columns(spark):
    assert fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []
    table = spark.createDataFrame([(1, "a\nb\n", 5, "x", 2)], "doc_id long, text string, cuts int, fim string, n int")
    made = fill_in_middle(table)
    assert made.columns == ["doc_id", "text", "cuts", "n", "fim"]
    row = made.first()
    assert (row.cuts, row.n, row.fim.n) == (5, 2, 2)


def test_other_units_and_shares(spark):
    table = spark.createDataFrame([(i, "un deux trois quatre") for i in range(50)], SCHEMA)
    words = fill_in_middle(table, unit=r"\S+", middle_percent=50).select("fim.*", restore_text(F.col("fim.output"), F.col("fim.form")).alias("back"))
    rows = words.collect()
    assert {r.n for r in rows} == {4} and {r.back for r in rows} == {"un deux trois quatre"}
    assert 0 < sum(r.form == "plain" for r in rows) < 50
    assert fill_in_middle(table, suffix_first_percent=100).where("fim.form = 'psm'").count() == 0
    assert fill_middle.SEED == 7
