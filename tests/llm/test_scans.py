"""Scans, scoring, language ID, mixing, sharding and url rules against brute force and properties."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

import brute
from hydrix.llm import byte_cnn, fm_decontam, interpolation_lm, mixing, queries, secrets, sharding, url_graph

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, language string"


def docs(spark, rows):
    return spark.createDataFrame([(r + (None, None, None))[:5] for r in rows], DOCS)


def test_base_secrets_match_the_patterns(spark):
    rng = random.Random(4)
    parts = ["password=", "Token : '", "API_KEY=", "apikey:", "AKIA", "secret=", "deadbeef01234567", "ABCDEFGH12345678", "é", " ", "=", "x" * 14, "Key=", "passwd"]
    texts = ["".join(rng.choices(parts, k=12)) for _ in range(150)] + [None, "", "a" * 3000]
    got = secrets.scan_secrets(docs(spark, list(enumerate(texts)))).select("doc_id", secrets.span_list("secrets", True).alias("b"), secrets.span_list("secrets").alias("s")).collect()
    for r in got:
        assert r.b == brute.base_secrets(texts[r.doc_id] or "")
        assert set(filter(None, r.b.split(","))) <= set(r.s.split(","))


def test_weak_parts_are_reported_only_together():
    def kinds(text):
        return [k for _, _, k in secrets.linked_spans(text, secrets.base_spans(text))]

    assert kinds("user: alice") == [] and kinds("see https://example.org/a") == [] and kinds("password=abcd") == []
    assert sorted(kinds("user: alice password=abcd")) == ["weak_id", "weak_secret"]
    assert sorted(kinds("user: alice password=abcd at https://db.example.org:5432/x")) == ["endpoint", "weak_id", "weak_secret"]
    assert kinds("user: alice" + " " * 300 + "password=abcd") == []
    assert kinds("AKIA" + "A" * 16 + " password=abcd") == ["weak_secret"]


@pytest.mark.parametrize("block_bytes", [fm_decontam.BLOCK_BYTES, 300])
def test_contamination_matches_brute_force(spark, block_bytes):
    rng = random.Random(9)
    vocab = ["a", "b1", "c", "é", "Dd"]
    items = [(i % 9 if i else None, " ".join(rng.choices(vocab, k=rng.choice([0, 2, 10, 13, 25])))) for i in range(14)] + [(50, None)]
    texts = [None, "", "..", "\n"] + [" ".join(rng.choices(vocab + ["zz", "-"], k=rng.choice([3, 40, 400]))) + "," + items[rng.randrange(14)][1] for _ in range(40)]
    found = fm_decontam.find_contamination(
        docs(spark, list(enumerate(texts))), spark.createDataFrame(items, "item_id bigint, text string"), block_bytes=block_bytes
    ).select("doc_id", "contamination.*").collect()
    want = brute.contamination(texts, items)
    for r in found:
        assert (r.n_words, r.n_hit, r.items) == want[r.doc_id]
        assert sum(r.word_ends) - sum(r.word_starts) == r.n_hit
        spans = [brute.ALNUM_WORDS.findall(brute.lowered((texts[r.doc_id] or "")[a:b])) for a, b in zip(r.starts, r.ends)]
        assert [len(s) for s in spans] == [b - a for a, b in zip(r.word_starts, r.word_ends)]


def test_lm_scores(spark):
    got = {r.doc_id: r for r in queries.op5_deleted_interpolation(spark, SF).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for (d, _), (n, known, total, base) in zip(rows, brute.base_scores(rows)):
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
        assert r.held_out == (zlib.crc32(str(d).encode()) % 10 == 0)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_without_training_rows_and_nulls(spark):
    df = docs(spark, [(1, "a b"), (2, None), (None, "")])
    got = interpolation_lm.score_texts(df, F.lit(True)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens) for r in got) == [(1, 0, 0), (1, 0, 0), (3, 0, 0)]
    assert interpolation_lm.score_texts(docs(spark, []), F.lit(False)).count() == 0


def test_language_on_held_out_documents(spark):
    got = queries.op6_byte_cnn(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_edge_cases(spark):
    df = docs(spark, [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "123 --", "de"), (5, "", None)])
    found = byte_cnn.identify(df, byte_cnn.fit(df)).select("doc_id", "language.*").collect()
    assert {r.doc_id: r.lang for r in found if r.doc_id > 2} == {3: "und", 4: "und", 5: "und"}
    assert {r.doc_id: r.lang for r in found if r.doc_id < 3} == {1: "en", 2: "de"}
    assert byte_cnn.fit(df.where("false")) is None
    assert byte_cnn.identify(df, None).where("language.lang <> 'und'").count() == 0


def test_targets_and_taken_words(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 900)), None, rng.choice(["a", "B", "c", "d", "é", None, "a"])) for i in range(400)]
    rows += [(900, "big " * 30_000, None, "z"), (901, None, None, "y"), rows[0], (None, "x y", None, "a")]
    got = mixing.mix_sources(docs(spark, rows)).collect()
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = brute.target_shares({s: sizes[s] for s in order})
    taken = {s: 0 for s in sizes}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= mixing.BLOCK for s in sizes)
    again = mixing.mix_sources(docs(spark, rows[::-1])).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    copies = mixing.mixed_documents(docs(spark, rows))
    words = {r.source: r.n for r in copies.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert words == {s: n for s, n in taken.items() if n}
    assert mixing.mix_sources(docs(spark, [])).count() == 0


def test_quotas_are_highest_quotients(spark):
    targets = {"a": 5300.0, "b": 100.0, "c": 2600.0, "d": 0.0, "e": 333.0}
    df = spark.createDataFrame([(s, int(t), 1.0, t) for s, t in targets.items()], "source string, source_size bigint, weight double, target double")
    got = {(r.source, r.shard): (r.first_block, r.quota) for r in mixing.shard_quotas(df, 100, 4).collect()}
    for shard in range(1, 5):
        seats = dict.fromkeys(targets, 0)
        for _ in range(round(sum(targets.values()) / 100 * shard / 4)):
            best = max(targets, key=lambda s: (targets[s] / (2 * seats[s] + 1), [-ord(s)]))
            seats[best] += 1
        assert {s: sum(got[s, shard]) for s in targets} == seats


def test_table_gives_every_shard_its_turns():
    names = [f"s{i}" for i in range(7)]
    table = sharding.fill_table(names, 101)
    assert sorted(table.count(i) for i in range(7)) == [14, 14, 14, 14, 15, 15, 15]
    fewer = sharding.fill_table(names[:-1], 101)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved <= 40
    with pytest.raises(ValueError):
        sharding.fill_table(names, 100)


def test_placement(spark):
    rows = [(i, f"t{i}") for i in range(500)] + [(None, "x"), (None, None), (3, "other")]
    df = docs(spark, rows)
    got = sharding.place(df).collect()
    table = sharding.fill_table([f"shard-{i:05d}" for i in range(sharding.SHARDS)])
    for r in got:
        key = str(r.doc_id) if r.doc_id is not None else r.text or ""
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r.slot, r.shard) == (slot, f"shard-{table[slot]:05d}")
    assert len(got) == len(rows) and sharding.place(docs(spark, [])).count() == 0


def test_url_rules_and_propagation(spark):
    link = '<a href="http://{}/x">'
    pages = [
        (1, "HTTP://A.COM/x", None), (2, "http://a.com", ""), (3, "http://example.com/en/1", ""), (4, "https://www.Example.com/en/1?q", ""),
        (5, "http://x.net/es/?a", ""), (6, "http://x.net/de/", ""), (7, None, None), (8, "no scheme", ""), (9, "http://notcom/x", ""),
        (10, "http://farm.org/", link.format("x.net") * 3), (11, "http://good.org/p#f", link.format("a.com")), (12, "http://linked.org/", ""),
        (13, "http://a.com/y", link.format("linked.org")), (14, "http://x.net/fr/x", ""), (None, "http://x.net/fr/x", ""),
    ]
    got = {r.page_id: r for r in url_graph.judge_urls(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in (1, 3, 4, 5)] == [
        ("a.com", "/x", "com/", "allow"), ("example.com", "/en/1", "example.com/en/", "block"),
        ("www.example.com", "/en/1", "www.example.com/en/", "allow"), ("x.net", "/es/", "net/es/", "block"),
    ]
    assert (got[2].path, got[2].rule) == ("", None) and (got[7].host, got[7].path, got[7].verdict) == ("", "", "allow")
    assert got[8].host == "" and got[9].rule is None and got[11].path == "/p"
    assert got[6].verdict == "block" and got[10].verdict == "block"  # the bad host, and one that links to it
    assert got[12].verdict == "allow" and got[12].trust > 0  # linked from a trusted host
    assert len(got) == len(pages)


def test_oracle_keys():
    assert set(queries.oracle_sql()) <= set(queries.QUERIES)
    assert {k.split("_")[0] for k in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
