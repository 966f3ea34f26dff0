import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from llm import tandem


def by_hand(w, least, times):
    """Runs of every period, from all words; a stretch counts with its smallest one."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in out.items())


def repeating(rng, n, letters):
    w = [rng.randrange(letters) for _ in range(n)]
    if n and rng.random() < 0.5:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def test_runs_equal_those_by_hand(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(tandem, "LEAVES", 64)
    for _ in range(600):
        docs = [repeating(rng, rng.randint(0, 90), rng.choice([1, 2, 2, 3, 5])) for _ in range(rng.randint(1, 6))]
        least, times = rng.choice([(24, 3), (6, 2), (1, 2), (10, 3), (4, 3)])
        at = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        got = list(zip(*(x.tolist() for x in tandem.runs(np.asarray(sum(docs, []), np.int32), at, least, times))))
        assert got == [(a + int(at[i]), n, q) for i, d in enumerate(docs) for a, n, q in by_hand(d, least, times)]


def test_long_and_hostile_texts():
    unary = tandem.runs(np.zeros(200_000, np.int32), np.asarray([0, 200_000]))
    assert [x.tolist() for x in unary] == [[0], [200_000], [1]]
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    got = list(zip(*(x.tolist() for x in tandem.runs(np.asarray(b, np.int32), np.asarray([0, len(b)]), 24, 3))))
    assert got == by_hand(b, 24, 3)


def answer(doc_id, text):
    """What the query returns, from the definition."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = by_hand(w, 24, 3)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in sorted(found, key=lambda r: (r[0], r[2])))
    left = " ".join(x for i, x in enumerate(w) if i not in gone)
    milli = 1000 * best[1] // best[2] if found else None
    return doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest()


def test_query_equals_the_definition(spark, sf):
    got = {tuple(r) for r in tandem.query(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert got == {answer(r.doc_id, r.text) for r in docs}
    assert any(r[1] for r in got)


def test_odd_tables(spark, tmp_path):
    chosen = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("xyz") for _ in range(rng.randint(0, 70)))) for i in range(400)]
    docs += [(chosen[0], None), (chosen[1], ""), (chosen[2], " \t\n"), (chosen[3], "one"), (None, "a\x0bb " * 40), (7, "é\x1c à\x85 " * 30), (7, "é\x1c à\x85 " * 30), (500, None), (501, "word " * 50_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as runs", "'y' as words", "2 as g", "3 as a", "4 as p").repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, (tuple(r) for r in tandem.query(spark, str(tmp_path)).collect())))
    want = sorted(str(answer(i, t)) for i, t in docs if i != 501)
    assert [x for x in got if not x.startswith("(501,")] == want
    one = tandem.query(spark, str(tmp_path)).filter("doc_id = 501").first()
    assert (one.n_runs, one.start, one.length, one.period, one.exponent_milli) == (1, 0, 50_000, 1, 50_000_000)
    assert tandem.periodic(df.limit(0)).count() == 0
