"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().lower().split()


def katz(rows, discounts, order=2, k=5, mod=5, held=1):
    """rows: (doc_id, text). (doc_id, held_out, n_tokens, n_known, N, base_score, score), by recursion token by token."""
    seqs = [(i, zlib.crc32(("" if i is None else str(i)).encode()) % mod == held, [*words(t), "</s>"]) for i, t in rows]
    grams = [Counter() for _ in range(order + 1)]  # by length
    for _, h, s in seqs:
        if not h:
            t = ["<s>", *s]
            for j in range(1, len(t)):
                for m in range(1, order + 1):
                    if j - m + 1 >= (1 if m == 1 else 0):
                        grams[m][tuple(t[j - m + 1 : j + 1])] += 1
    uni = grams[1]
    n, v = sum(uni.values()), len(uni)
    d = [None, *(discounts(dict(Counter(c.values()))) for c in grams[1:])]
    disc = lambda c, m: c * (d[m][c - 1] if c <= k else 1.0)
    unk = sum(c - disc(c, 1) for c in uni.values()) / n
    after = defaultdict(dict)
    for m in range(2, order + 1):
        for g, c in grams[m].items():
            after[g[:-1]][g[-1]] = c
    weights = {}

    def weight(x):
        """s / c(x), and alpha(x)"""
        if x not in weights:
            m, total = len(x) + 1, sum(after[x].values())
            kept = sum(disc(c, m) for c in after[x].values())
            s = total / (total + 1) if kept > total * (1 - 1e-12) else 1.0
            weights[x] = s / total, (1 - s * kept / total) / (1 - sum(p(x[1:], w) for w in after[x]))
        return weights[x]

    def p(x, w):
        if not x:
            return disc(uni[w,], 1) / n if (w,) in uni else unk
        if x not in after:
            return p(x[1:], w)
        unit, alpha = weight(x)
        return disc(after[x][w], len(x) + 1) * unit if w in after[x] else alpha * p(x[1:], w)

    for x in list(after) if len(after) * v < 2_000_000 else list(after)[:: max(1, len(after) // 100)]:  # exactly normalised
        q = sum(p(x, w) for (w,) in uni) + p(x, None)
        assert abs(q - 1) < 1e-9, q
    out = []
    for i, h, s in seqs:
        t = ["<s>", *s]
        base = sum(math.log10((uni[w,] + 0.5) / (n + 0.5 * (v + 1))) for w in s)
        score = sum(math.log10(p(tuple(t[max(0, j - order + 1) : j]), t[j])) for j in range(1, len(t)))
        out.append((i, h, len(s), sum((w,) in uni for w in s), n, base, score))
    return out


def alignment(rows, a, b):
    """rows: (doc_id, text); a(text) and b(text): lists of (id, bytes). (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    made = []
    for i, t in rows:
        raw = (" " + t).encode() if t else b""
        x, y = (a(" " + t), b(t)) if t else ([], [])
        if b"".join(v for _, v in x) != raw or b"".join(v for _, v in y) != raw:
            x = y = []
        spans = []
        for side in (x, y):
            at, out = 0, []
            for k, v in side:
                out.append((at, at + len(v), k))
                at += len(v)
            spans.append(out)
        links = [(p[2], q[2]) for p in spans[0] for q in spans[1] if p[0] < q[1] and q[0] < p[1]]
        ends = sorted({p[1] for p in spans[0]} & {q[1] for q in spans[1]})
        groups, low = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(p[2]) for p in s if low < p[1] <= e) for s in spans))
            low = e
        made.append((i, len(x), len(y), groups, links))
    count = Counter(link for *_, links in made for link in links)
    best = defaultdict(int)
    for (_, q), n in count.items():
        best[q] = max(best[q], n)
    return [(i, n, m, len(g), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), ";".join(g)) for i, n, m, g, links in made]


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def decontamination(rows, items, size):
    """rows: (doc_id, text), items: (item_id, text). (doc_id, n_words, n_hit, ids)."""
    windows = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add("" if i is None else str(i))
    out = []
    for i, t in rows:
        w, hit, ids = item_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    ids |= windows[x]
        out.append((i, len(w), len(hit), sorted(ids)))
    return out


def search(rows, items, k):
    """rows: (doc_id, text), items: (item_id, text). (item_id, rank, doc_id, score)."""
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_texts, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for i, t in items:
        scored = []
        for d, c, n in docs:
            m = 50 + 50 * n * n_texts // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_texts + 2) / (2 * df[x] + 1))) * (10**9 * c[x] // (1000 * c[x] + 20 * m)) for x in set(terms(t)) if c[x])
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out
