"""Link-graph propagation against a linear solve, interpolation scores against plain counting and EM."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import brute
from hydrix.llm import interpolation_lm as lm
from hydrix.llm import url_graph
from hydrix.llm.queries import fold

HOSTS = ["a.com", "b.com", "www.example.com", "example.com", "x.y.example.com", "n.net", "m.n.net", "o.org", "p.o.org", "q.org", "r.org", "alone.org"]
PATHS = ["/en/1", "/es/2", "/fr/3", "/de/4", ""]


def linked_pages(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        links = "".join(f'<a href="https://{rng.choice(HOSTS[:-1])}/p">x</a>' for _ in range(rng.randrange(4)))
        rows.append((i, f"http://{rng.choice(HOSTS[:-1])}{rng.choice(PATHS)}", links if rng.random() < 0.9 else None))
    return rows + [(150, "http://alone.org/de/", ""), (151, None, None), (152, "no address", "")] + rows[:5]


def solved(rows):
    """host -> (trust, distrust): the fixed points of both propagations."""
    import re

    address = {i: re.match(r"[^:]*://([^/?#]*)([^?#]*)", u or "") for i, u, _ in rows}
    edges, seeds, seen = Counter(), {"allow": Counter(), "block": Counter()}, set()
    for i, _, html in rows:
        host, path = address[i].groups() if address[i] else ("", "")
        if not host:
            continue
        seen.add(host)
        for dst in re.findall(r'href="https://([^/]+)', html or ""):
            if dst != host:
                edges[host, dst] += 1
        fits = [(len(h + p), v) for h, p, v in url_graph.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        if fits:
            seeds[max(fits)[1]][host] += 1
    tree = set()
    for host in seen:
        while host.count(".") > 1:
            tree |= {(host, host.split(".", 1)[1]), (host.split(".", 1)[1], host)}
            host = host.split(".", 1)[1]
    edges.update(dict.fromkeys(tree, 1))
    hosts = sorted({h for e in edges for h in e} | seen)
    at, d = {h: i for i, h in enumerate(hosts)}, url_graph.DAMPING
    scores = []
    for verdict in ("allow", "block"):
        flow = np.zeros((len(hosts), len(hosts)))
        for (a, b), n in edges.items():
            if verdict == "allow":
                flow[at[b], at[a]] += n
            else:
                flow[at[a], at[b]] += n
        flow /= np.maximum(flow.sum(axis=0), 1)
        start = np.array([seeds[verdict][h] for h in hosts], float) / sum(seeds[verdict].values())
        scores.append(np.linalg.solve(np.eye(len(hosts)) - d * flow, (1 - d) * start))
    return {h: (scores[0][i], scores[1][i]) for h, i in at.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_propagation_equals_a_linear_solve(spark, seed):
    rows = linked_pages(seed)
    want = solved(rows)
    got = url_graph.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows)
    judged = set()
    for r in got:
        trust, distrust = want.get(r.host, (0.0, 0.0))
        assert (r.trust, r.distrust) == (pytest.approx(trust, abs=1e-5), pytest.approx(distrust, abs=1e-5))
        if r.rule is None and abs(distrust - trust) > 1e-4 or not r.host:
            judged.add(r.verdict)
            assert r.verdict == ("block" if distrust > trust else "allow")
    assert judged == {"block", "allow"}


def reference_scores(rows, folds=10):
    tokens = [brute.BLANK_WORDS.findall(brute.lowered(t)) + [None] for _, t in rows]
    train = [bool(zlib.crc32(str("" if d is None else d).encode()) % folds) for d, _ in rows]
    pairs = [list(zip([None, *w], w)) for w in tokens]  # a text begins after an end
    c1 = Counter(x for w, t in zip(tokens, train) if t for x in w)
    c2 = Counter(x for p, t in zip(pairs, train) if t for x in p)
    n, p0 = sum(c1.values()), 1 / (len(c1) + 1)
    bucket = lambda c: math.ceil(math.log2(c + 1))
    cell = lambda ratio: 2 ** ((math.floor(math.log2(ratio) * lm.STEPS) + 0.5) / lm.STEPS) if ratio > 0 else 0.0
    held = Counter()  # every training token from the counts without itself
    for p, t in zip(pairs, train):
        for v, w in p if t else ():
            cv = c1[v] - 1
            held[bucket(cv), cell((c2[v, w] - 1) / cv / p0 if cv else 0), cell((c1[w] - 1) / max(n - 1, 1) / p0)] += 1
    weights = {}
    for b in {b for b, _, _ in held}:
        own = [((x, y, 1.0), k) for (c, x, y), k in held.items() if c == b]
        total, mix = sum(k for _, k in own), [1 / 3] * 3
        for _ in range(lm.EM_ROUNDS):
            share = [0.0] * 3
            for parts, k in own:
                mixed = [m * x for m, x in zip(mix, parts)]
                for i in range(3):
                    share[i] += k * mixed[i] / sum(mixed) / total
            share = [max(s, lm.FLOOR) for s in share]
            mix = [s / sum(share) for s in share]
        weights[b] = mix
    out = []
    for p in pairs:
        score = 0.0
        for v, w in p:
            l2, l1, l0 = weights.get(bucket(c1[v]), [1 / 3] * 3)
            score += math.log10(l2 * (c2[v, w] / c1[v] if c1[v] else 0) + l1 * c1[w] / max(n, 1) + l0 * p0)
        out.append(score)
    return out


@pytest.mark.parametrize("group,part,fan", [
    (lm.GROUP_BYTES, lm.PART_TOKENS, lm.FAN), (700, 300, lm.FAN), (700, 300, 4), (400, 150, 3), (700, 20000, 2),
])  # one level, one with several parts, two and three levels, one part of many groups
def test_scores_equal_plain_counting(spark, monkeypatch, group, part, fan):
    monkeypatch.setattr(lm, "FAN", fan)
    monkeypatch.setattr(lm, "GROUP_BYTES", group)
    monkeypatch.setattr(lm, "PART_TOKENS", part)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)] + ["Été", "THE", "the"]
    text = lambda: " ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(63)], k=rng.randint(1, 60)))
    rows = [(i, text()) for i in range(120)] + [(120, None), (121, ""), (None, text()), (130, "\t \n"), (131, " unseen words only ")]
    rows += [rows[3]] * 4
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "words long, doc_id long, text string")
    got = sorted(lm.score_texts(df, fold("doc_id", 10) == 0).collect(), key=repr)
    want = [(d, b[0], b[1], b[2], b[3], s) for (d, _), b, s in zip(rows, brute.base_scores(rows), reference_scores(rows))]
    key = lambda r: (repr(r[0]), r[1], r[4])
    got = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got], key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:4] == w[:4]
        assert g[4:] == (pytest.approx(w[4], rel=1e-9), pytest.approx(w[5], rel=1e-9))


def test_exchange_grows_by_levels():
    assert lm.exchange_shape(1) == (1, 1) and lm.exchange_shape(64) == (1, 64) and lm.exchange_shape(256) == (1, 256)
    assert lm.exchange_shape(257) == (2, 17) and lm.exchange_shape(1 << 24) == (3, 256)
    for parts in (2, 300, 70_000, 10**8):
        levels, fan = lm.exchange_shape(parts)
        assert fan <= lm.FAN and (fan - 1) ** levels < parts <= fan**levels


def test_levels_answer_in_the_order_of_the_requests(spark, monkeypatch):
    """Blocks a group sends stay at the fan, whatever the number of parts; two levels answer like one."""
    texts = [(i, " ".join(f"w{(i * 7 + j * j) % 211}" for j in range(40))) for i in range(400)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setattr(lm, "GROUP_BYTES", 600)
    found = []
    for part, fan in ((400, 256), (400, 7)):
        monkeypatch.setattr(lm, "PART_TOKENS", part)
        monkeypatch.setattr(lm, "FAN", fan)
        with lm.Scratch(spark, "test") as scratch:
            rows = df.select("doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "text")
            groups = scratch.stage(rows.mapInArrow(
                lm.tokenised(pa.int64()),
                "gid bigint, n_tokens bigint, doc_ids array<bigint>, held binary, bounds binary, words binary, tokens binary",
            ))
            replies, n, v = lm.training_counts(groups, scratch)
            by_group = {}
            for r in sorted(replies.collect(), key=lambda r: (r.gid, r.part)):
                by_group.setdefault(r.gid, []).append(r)
            assert max(len(rs) for rs in by_group.values()) <= fan
            found.append((n, v, {
                g: (np.concatenate([lm._unpack_counts(r.cw) for r in rs]).tolist(), np.concatenate([lm._unpack_counts(r.cp) for r in rs]).tolist())
                for g, rs in by_group.items()
            }))
    assert len(found[0][2]) > 20 and found[0] == found[1]
