import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm import tiling


def greedy(a, b, least):
    """Tiles by the plain definition: again and again the longest match of unmarked words."""
    fa, fb, total = [True] * len(a), [True] * len(b), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and fa[i + n] and fb[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return total
        total += n
        fa[i : i + n] = fb[j : j + n] = [False] * n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=30), st.lists(st.integers(1, 4), max_size=40))
def test_tiles(a, b):
    x, y = np.array(a, np.uint64) * 77777777777, np.array(b, np.uint64) * 77777777777
    tiles = tiling.tile(x, y, 3) if len(x) and len(y) else []
    used_a, used_b = set(), set()
    for p, q, n in tiles:
        assert n >= 3 and a[p : p + n] == b[q : q + n]
        assert not used_a & set(range(p, p + n)) and not used_b & set(range(q, q + n))
        used_a |= set(range(p, p + n))
        used_b |= set(range(q, q + n))
    # ties may be broken differently, but nothing long enough is left, and the first tile is a longest match
    free_a, free_b = [v if i not in used_a else -1 - i for i, v in enumerate(a)], [v if i not in used_b else -99 - i for i, v in enumerate(b)]
    assert greedy(free_a, free_b, 3) == 0
    if not tiles:
        assert greedy(a, b, 3) == 0


def test_planted(spark, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = bench.collect()
    words = items[0].text.split()
    half = len(words) // 2
    clean = "zzz " * 50
    docs = [
        (1, clean + items[0].text + clean),
        (2, " ".join(words[half:]) + " " + clean + " ".join(words[:half])),
        (3, clean),
        (4, " ".join(words[: len(words) // 3]) + clean),
        (5, clean + items[1].text.upper().replace(".", "!!")),
        (6, None),
        (7, ""),
        (None, items[0].text),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as coverage")
    for size in (tiling.BLOCK_WORDS, 100):
        got = {(r.doc_id, r.item_id) for r in tiling.contained(df, bench, block_words=size).collect()}
        assert {g for g in got if g[0] != 5} == {(1, items[0].item_id), (2, items[0].item_id)} and (5, items[1].item_id) in got
    one = tiling.contained(df, bench).filter("doc_id = 1").first()
    assert re.sub(r"\W+", " ", docs[0][1].encode()[one.starts[0] : one.ends[-1]].decode()).split()[: len(words)] == re.sub(r"\W+", " ", items[0].text).split()
    assert tiling.contained(df.limit(0), bench).count() == 0 and tiling.contained(df, bench.limit(0)).count() == 0


def test_against_seeds_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in tiling.query(spark, "/root/testdata/sf0.01").collect()}
    split = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t))
    want = set()
    for i in items:
        w = split(i.text)
        grams = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
        for d in docs:
            if " ".join(w[:4])[:15] in d.text.lower() or " ".join(w[-4:])[:15] in d.text.lower():
                x = split(d.text)
                if len(grams & {tuple(x[j : j + 5]) for j in range(len(x) - 4)}) and greedy(w, x, 5) >= 0.5 * len(w):
                    want.add((d.doc_id, i.item_id))
    assert want <= got
