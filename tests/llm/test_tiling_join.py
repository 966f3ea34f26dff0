"""Benchmarks that are sent to the tasks, and ones that are joined by their seeds, give the same rows."""

import random

from llm import tiling


def both(spark, docs, items):
    key = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    sent, joined = key(tiling.contained(docs, items)), key(tiling.contained(docs, items, block_words=1))
    assert sent == joined
    return sent


def test_the_given_tables(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    assert both(spark, docs, items)


def test_odd_tables(spark):
    rng = random.Random(8)
    word = lambda: rng.choice("a b c dd é 12 x".split())
    texts = [" ".join(word() for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 12, 40]))) for _ in range(60)]
    items = [(rng.choice([None, *range(20)]), rng.choice(texts)) for _ in range(40)] + [(50, None), (51, "dd dd"), (51, "dd dd"), (52, "A, b; C! dd. e")]
    docs = [(rng.choice([None, *range(30)]), rng.choice(texts) + " zz " + rng.choice(texts)) for _ in range(60)] + [(90, None), (91, ""), (92, "long text " * 20_000 + "a b c dd e"), (93, "dd dd"), (93, "dd dd")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as code", "3 as r").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as place", "3 as i").repartition(2)
    got = both(spark, d, i)
    assert sum("93, 51" in x for x in got) == 4 and any("92, 52" in x for x in got)
    for empty in ((d.limit(0), i), (d, i.limit(0))):
        assert not both(spark, *empty)
