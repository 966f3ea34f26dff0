import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import suffixes


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[a : a + length] for _, t in texts for a in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        cover = np.zeros(len(t), bool)
        for a in range(len(t) - length + 1):
            if seen[t[a : a + length]] > 1:
                cover[a : a + length] = True
        kept = np.frombuffer(t, np.uint8)[~cover].tobytes()
        spans = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        out.append((i, len(t), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=300) | st.lists(st.sampled_from([b"ab", b"a", b"abcabd" * 12, b"\0", b"\xff"]), max_size=40).map(b"".join))
def test_suffix_array(data):
    text = np.frombuffer(data, np.uint8).astype(np.uint16) + 1
    ranks = suffixes.Ranks(text) if len(text) else None
    order = suffixes.suffix_array(text, len(text) + 1, ranks)
    want = sorted(range(len(data)), key=lambda i: data[i:])
    assert order.tolist() == want
    if len(data):
        got = suffixes.common_prefixes(order, ranks, 500).tolist()
        for k in range(1, len(want)):
            a, b = data[want[k - 1] :], data[want[k] :]
            assert got[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("length,gram,limits", [(400, 64, {}), (40, 12, {}), (40, 12, {"most": 2, "task_bytes": 5000}), (40, 12, {"most": 10**6})])
def test_matches_brute_force(spark, sf, length, gram, limits):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    base = max(t for _, t in rows if 1500 < len(t) < 4000)
    extra = [(10_000 + i, f"é{i}" * (i % 5) + base[i * 7 : 900 + i * 3] + str(i * i)) for i in range(30)]
    extra += [(20_000, None), (20_001, ""), (20_002, "a" * 900), (20_003, "xyz" * 300), (20_003, "xyz" * 300), (20_003, "other")]
    data = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = sorted(tuple(r) for r in suffixes.removed(data, length, gram=gram, **limits).collect())
    assert got == brute(rows + extra, length)


def test_odd_tables(spark):
    odd = spark.createDataFrame([(None, "a" * 500), (1, "a" * 399)], "doc_id long, text string").selectExpr("*", "1 as t", "2 as runs", "3 as n_bytes")
    assert [(r.doc_id, r.n_removed, bytes(r.kept)) for r in suffixes.removed(odd, with_text=True).collect()] == [(1, 0, b"a" * 399)]
    assert suffixes.removed(odd.limit(0)).count() == 0


def test_groups_are_dealt_by_their_number(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    text = max((r.text or "" for r in docs.collect()), key=lambda t: len(t) if len(t) < 4000 else 0)
    docs = spark.createDataFrame([(i, f"{text[i * 5 :]}{i}") for i in range(60)], "doc_id long, text string")
    spark.sparkContext.setJobGroup("dealt", "groups of segments")
    try:
        assert suffixes.removed(docs, 40, gram=12, task_bytes=20).filter("n_removed > 0").count() == 60
    finally:
        spark.sparkContext.setJobGroup("", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("dealt") for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) >= 30  # the session's shuffles have 4
