"""Texts of unknown languages and junk of letters beside clean texts."""

import base64
import random

import corpus_pipeline as pipeline

FOREIGN = [
    "Сегодня утром в городе было холодно, и люди шли на работу пешком, потому что автобусы не ходили из-за снега. ",
    "今天早上城里很冷，人们步行去上班，因为路上有雪和冰，公共汽车停运了。学校也关门了，孩子们在家里看书。",
    "Σήμερα το πρωί έκανε κρύο στην πόλη και οι άνθρωποι πήγαιναν στη δουλειά με τα πόδια, γιατί είχε χιόνι. ",
]


def test_foreign_and_junk_texts_go(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*pipeline.COLUMNS)
    r, far = random.Random(7), []
    for n in (120, 400, 2000):
        far += [(f * 40)[:n] for f in FOREIGN] + ["".join(r.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n)), base64.b64encode(r.randbytes(n)).decode()[:n]]
    more = spark.createDataFrame([(1_000_000 + i, t, None, "s", len(t)) for i, t in enumerate(far)], docs.schema)
    clean = docs.filter(r"text rlike '\\p{L}'")
    got = {x.doc_id for x in pipeline.identify_language(spark, docs.union(more), sf).select("doc_id").collect()}
    assert not [far[i - 1_000_000][:40] for i in got if i >= 1_000_000]
    assert got == {x.doc_id for x in clean.select("doc_id").collect()}
