import re

import duckdb
import pytest

from llm import minhash


def brute(rows, k, percent):
    sets = {}
    for i, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
        sets[i] = {tuple(words[j : j + k]) for j in range(max(len(words) - k + 1, 1))} if words else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids, owners = sorted(sets), {}
    for i in ids:
        for s in sets[i]:
            owners.setdefault(s, []).append(i)
    for i in ids:
        common = {}
        for s in sets[i]:
            for j in owners[s]:
                common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if j > i and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("k,percent,limits", [(3, 85, {}), (5, 80, {}), (3, 85, {"task_shingles": 3000, "task_docs": 3})])
def test_matches_brute_force(spark, sf, k, percent, limits):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    base = max((t for _, t in rows if 300 < len(t) < 900), key=len).split()
    extra = [(10_000 + i, " ".join(base[: len(base) - i % 7] + [f"w{i % 11}"])) for i in range(40)]
    extra += [(20_000, None), (20_001, ""), (20_002, "one two"), (20_003, "One  two"), (20_004, "solo")]
    rows += extra
    data = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(data, k, percent, **limits).collect()}
    assert got == brute(rows, k, percent)


def test_odd_tables(spark):
    odd = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "a b c")], "doc_id long, text string").selectExpr("*", "1 as component_id", "'x' as n_shingles")
    assert sorted(tuple(r) for r in minhash.near_duplicates(odd).collect()) == [(1, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert minhash.near_duplicates(odd.limit(0)).count() == 0
