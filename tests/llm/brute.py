"""Plain-Python versions of the operators' contracts, for small fixtures."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return (text or "").translate(UPPER)


def find(parent, a):
    while parent[a] != a:
        parent[a] = parent[parent[a]]
        a = parent[a]
    return a


def components(ids, links):
    """Smallest non-null id reachable from each row."""
    parent = list(range(len(ids)))
    for a, b in links:
        parent[find(parent, a)] = find(parent, b)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = find(parent, i)
            least[r] = min(least.get(r, d), d)
    return [least.get(find(parent, i)) for i in range(len(ids))]


def shingle_sets(texts, k=5):
    out = []
    for t in texts:
        w = BLANK_WORDS.findall(lowered(t))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def near_duplicates(rows):
    sets = shingle_sets([t for _, t in rows])
    holders = defaultdict(list)
    links = []
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in holders[g])
        links += [(i, j) for j, n in common.items() if 100 * n >= 75 * (len(s) + len(sets[j]) - n)]
        for g in s:
            holders[g].append(i)
    comp = components([d for d, _ in rows], links)
    return [(d, len(s), c if s else d) for (d, _), s, c in zip(rows, sets, comp)]


def contamination(texts, items, window=10):
    windows = {}
    for item, t in items:
        w = ALNUM_WORDS.findall(lowered(t))
        for a in range(max(min(1, len(w)), len(w) - window + 1)):
            windows.setdefault(tuple(w[a : a + window]), set()).add(item)
    lengths = {len(k) for k in windows}
    out = []
    for t in texts:
        w = ALNUM_WORDS.findall(lowered(t))
        hit, found = set(), set()
        for n in lengths:
            for a in range(len(w) - n + 1):
                if (k := tuple(w[a : a + n])) in windows:
                    hit |= set(range(a, a + n))
                    found |= windows[k]
        out.append((len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def repeats(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if b else b""
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def base_scores(rows, folds=10):
    """(n_tokens, n_known, N, base) per row."""
    tokens = [BLANK_WORDS.findall(lowered(t)) + [None] for _, t in rows]
    counts = Counter()
    for (d, _), w in zip(rows, tokens):
        if zlib.crc32(str("" if d is None else d).encode()) % folds:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    return [
        (len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) for w in tokens
    ]


def vector_links(rows, threshold=0.98):
    """rows: (id, vector, label)."""
    unit = []
    for _, v, label in rows:
        good = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None)
    links = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold
    ]
    n = Counter(x for pair in links for x in pair)
    comp = components([r[0] for r in rows], links)
    return [(r[0], n[i], c if unit[i] is not None else r[0]) for i, (r, c) in enumerate(zip(rows, comp))]


def base_secrets(text):
    """kind:start:end of the base kinds, straight from the contract's patterns."""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(found))


def target_shares(sizes, weights=(3, 1, 2), budget=1.5, cap=2.0):
    """sizes: source -> words, in order.  Resharing by rounds."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    total, target, capped = budget * sum(sizes.values()), {}, set()
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        open_ = [s for s in sizes if s not in capped]
        target = {s: cap * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in open_) for s in sizes}
        over = [s for s in open_ if target[s] > cap * sizes[s]]
        if not over:
            return target
        capped |= set(over)
        if len(capped) == len(sizes):
            return {s: cap * sizes[s] for s in sizes}
