import numpy as np

from llm import ann


def exact(rows, queries, k):
    x = np.array([v for _, v in rows])
    ids = np.array([i for i, _ in rows])
    out = {}
    for q, v in queries:
        score = x @ np.array(v)
        keep = ids != q
        order = np.lexsort((ids[keep], -score[keep]))[:k]
        out[q] = list(ids[keep][order])
    return out


def test_recall_on_the_table(spark, sf):
    found = {}
    for r in ann.query(spark, sf).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    truth = exact(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert set(found) == set(truth) and all(len(v) == 20 for v in found.values())
    assert np.mean([len(set(truth[q]) & set(found[q])) / 20 for q in truth]) >= 0.9


def test_copies_ties_and_bad_vectors(spark):
    base = [(i, [1.0, 0.0]) for i in range(50)] + [(60, [0.0, 1.0]), (61, None), (62, [0.0, 0.0]), (63, [float("nan"), 1.0]), (64, [1.0, None]), (65, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(base, "vec_id long, embedding array<double>").selectExpr("*", "1 as rank", "2 as ids")
    got = [tuple(r) for r in ann.nearest(df, df.filter("vec_id in (3, 60, 61)"), k=5, radius=4).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got] == [(3, 1, 0), (3, 2, 1), (3, 3, 2), (3, 4, 4), (3, 5, 5), *[(60, i + 1, i) for i in range(5)]]
    assert ann.nearest(df.limit(0), df, k=5).count() == 0
    assert ann.nearest(df, df.limit(0), k=5).count() == 0


def test_pigeonhole():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 256, (500, 8), dtype=np.uint8)
    for radius in (0, 3, 7, 20, 30, 64):
        block = ann.Block(codes, radius)
        far = np.bitwise_count(codes ^ codes[5]).sum(axis=1)
        assert set(block.within(codes[5])) == set(np.flatnonzero(far <= radius))


def test_recall_over_several_blocks(spark):
    """20,000 nearly uniform vectors in several blocks of index and queries."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(20_000, 64)).astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    old, ann.QUERY_BLOCK = ann.QUERY_BLOCK, 300
    try:
        found = {}
        for r in ann.nearest(df, df.filter("vec_id % 50 = 0"), block=6_000).orderBy("query_id", "rank").collect():
            found.setdefault(r.query_id, []).append(r.vec_id)
    finally:
        ann.QUERY_BLOCK = old
    truth = exact(rows, [r for r in rows if r[0] % 50 == 0], 20)
    assert set(found) == set(truth) and all(len(v) == 20 for v in found.values())
    assert np.mean([len(set(truth[q]) & set(found[q])) / 20 for q in truth]) >= 0.9


def test_repeated_ids_with_other_vectors(spark):
    rows = [(i % 10, [float(i), float(i * i % 7), 1.0]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.filter("vec_id = 3"), k=40, radius=64).collect():
        got.setdefault(r.query_id, []).append((round(r.score, 6), r.vec_id))
    assert set(got) == {3} and all(v != 3 for _, v in got[3])
    best = max(float(np.dot(v, w)) for i, v in rows for j, w in rows if i == 3 and j != 3)
    assert max(got[3])[0] == round(best, 6)
