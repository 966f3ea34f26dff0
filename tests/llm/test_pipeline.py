"""The stages of the pipeline against brute force, and the whole of it."""

import re

import corpus_pipeline as pipeline
from llm import langid, packing
from tests.llm.test_minhash import brute as near_brute


def cut_brute(rows, length):
    from collections import Counter

    texts = [(i, t.encode()) for i, t in rows]
    seen = Counter(t[a : a + length] for _, t in texts for a in range(len(t) - length + 1))
    out = {}
    for i, t in texts:
        cover = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if seen[t[a : a + length]] > 1:
                cover[a : a + length] = b"\1" * length
        left = bytes(c for c, x in zip(t, cover) if not x)
        if not any(cover):
            out[i] = t.decode()
        elif re.search(rb"\S", left):
            out[i] = left.decode("utf-8", "ignore")
    return out


def test_stages_one_after_the_other(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = list(pipeline.COLUMNS)

    one = pipeline.identify_language(spark, docs, sf).cache()
    assert one.columns == columns
    known = {r.doc_id: r for r in langid.reject(langid.predict(docs, langid.fit(docs)), pipeline.MIN_SCORE).collect()}
    assert {r.doc_id: r.lang for r in one.collect()} == {i: r.lang_pred for i, r in known.items() if r.lang_pred != "und"}

    two = pipeline.drop_near_duplicates(spark, one, sf).cache()
    groups = near_brute([(r.doc_id, r.text) for r in one.collect()], 5, 80)
    assert two.columns == columns and {r.doc_id for r in two.collect()} == {i for i, (_, c) in groups.items() if i == c}

    three = pipeline.cut_repeated_passages(spark, two, sf).cache()
    want = cut_brute([(r.doc_id, r.text) for r in two.collect()], pipeline.REPEATED_BYTES)
    assert three.columns == columns and {r.doc_id: r.text for r in three.collect()} == want
    assert all(r.n_chars == len(r.text) for r in three.collect())

    four = pipeline.drop_test_leaks(spark, three, sf).cache()
    items = [re.findall(r"[a-z0-9\x80-\U0010ffff]+", r.text.lower()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", r.text.lower())) for r in three.collect()}
    whole = {i for i, t in texts.items() if any(" ".join(w) in t for w in items)}
    kept = {r.doc_id for r in four.collect()}
    assert four.columns == columns and not whole & kept
    # who went holds half of an item in runs of five words
    runs = lambda w: {" ".join(w[j : j + 5]) for j in range(len(w) - 4)}
    assert all(any(sum(x in texts[i] for x in runs(w)) >= len(runs(w)) / 4 for w in items) for i in texts.keys() - kept)

    five = pipeline.pack_sequences(spark, four, sf).collect()
    t = packing._tokenizer(packing.default_tokenizer())
    n = {r.doc_id: len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in four.collect()}
    total = {}
    for r in five:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == n and max(r.sequence_id for r in five) == (sum(n.values()) - 1) // 2048


def test_run_and_odd_rows(spark, sf, tmp_path):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "packing"]
    odd = [(None, "the text of no one", "en", "s", 1), (1, None, "en", None, None), (2, "", None, "s", 0), (3, "the same words in a row, the end", "en", "s", None), (3, "the same words in a row, the end", "en", "s", None), (4, "le chat et le chien de la maison", "fr", None, 5), (5, "12 34", None, None, 5)]
    spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as t", "2 as score").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, None), (None, "x")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {3, 4}
    empty = tmp_path / "empty"
    for name in ("documents", "benchmark"):
        spark.read.parquet(str(tmp_path / f"{name}.parquet")).limit(0).write.parquet(str(empty / f"{name}.parquet"))
    assert pipeline.run(spark, str(empty)).count() == 0
