import math
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest

from llm import katz


def brute(rows, order):
    def tokens(t):
        return re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())) + [None]

    counts = {k: Counter() for k in range(1, order + 1)}
    follow = {}
    for _, t, held in rows:
        if not held:
            w = [0] * (order - 1) + tokens(t)
            for i in range(order - 1, len(w)):
                for k in range(1, order + 1):
                    g = tuple(w[i - k + 1 : i + 1])
                    counts[k][g] += 1
                    follow.setdefault(g[:-1], set()).add(g[-1])
    total, types = sum(counts[1].values()), len(counts[1])

    def of(c):
        n = Counter(c.values())
        return np.array([0] + [n[r] for r in range(1, katz.TOP + 2)])

    d = {k: katz.discounts(of(c)) for k, c in counts.items()}
    cut = lambda k, c: c * (d[k][c] if c <= katz.TOP else 1.0)

    @lru_cache(None)
    def weight(h):
        """(count of a context, its backoff weight)"""
        k, seen = len(h) + 1, [counts[len(h) + 1][(*h, w)] for w in follow[h]]
        n = sum(seen)
        left = n - sum(cut(k, c) for c in seen)
        if left <= 1e-9:
            left, n = 1.0, n + 1
        return n, left / n / (1 - sum(p(h[1:], w) for w in follow[h])) if h else left / n

    @lru_cache(None)
    def p(h, w):
        if h not in follow:
            return p(h[1:], w)
        n, back = weight(h)
        c = counts[len(h) + 1][(*h, w)]
        return cut(len(h) + 1, c) / n if c else back * (p(h[1:], w) if h else 1.0)

    out = {}
    for i, t, held in rows:
        w = [0] * (order - 1) + tokens(t)
        words = w[order - 1 :]
        base = sum(math.log10((counts[1][(x,)] + 0.1) / (total + 0.1 * (types + 1))) for x in words)
        score = sum(math.log10(p(tuple(w[j - order + 1 : j]), w[j])) for j in range(order - 1, len(w)))
        out[i] = (held, len(words), sum((x,) in counts[1] for x in words), total, base, score)
    for h in [(0,) * (order - 1), *[h for h in follow if len(h) == order - 1][:20], (b"never",)]:
        assert abs(sum(p(h, w) for (w,) in counts[1]) + p(h, b"unknown") - 1) < 1e-9
    return out


@pytest.mark.parametrize("limits", [{}, {"chunk_bytes": 20_000, "task_entries": 5000}, {"order": 2, "chunk_bytes": 9_000, "task_entries": 700}, {"order": 4, "task_entries": 20_000}])
def test_matches_brute_force(spark, sf, limits):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = [(9001, None), (9002, ""), (9003, "the THE the"), (9004, "quite-unknown-word zzzz"), (9005, "the " * 500)]
    data = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = [(r.doc_id, r.text, zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in data.collect()]
    want = brute(rows, limits.get("order", katz.ORDER))
    got = katz.scores(data.withColumn("held", katz.crc_of_id() % 10 == 0), **limits).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], abs=1e-6) and r.score == pytest.approx(w[5], abs=1e-6)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_tables(spark):
    one = spark.createDataFrame([(1, "a b", True), (1, None, True)], "doc_id long, text string, held boolean").selectExpr("*", "1 as chunk", "2 as answers")
    got = katz.scores(one.select("doc_id", "text", "held")).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.score) for r in got) == [(1, 1, 0, 0.0), (1, 3, 0, 0.0)]
    assert katz.scores(one.select("doc_id", "text", "held").limit(0)).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_context_of_half_of_all_tokens(spark, order):
    """One context holds half of all bigrams, in a very long text too, and is spread over tasks."""
    texts = [" ".join(f"the w{(7 * i + j * j) % 90}" for j in range(40)) for i in range(60)] + ["the x " * 3000, "", "the unseen thing"]
    rows = [(i, t, i % 10 == 0 or i == 62) for i, t in enumerate(texts)]
    want = brute(rows, order)
    got = katz.scores(spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3), order=order, chunk_bytes=4000, task_entries=300).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert r.base_score == pytest.approx(want[r.doc_id][4], rel=1e-9) and r.score == pytest.approx(want[r.doc_id][5], rel=1e-9)
