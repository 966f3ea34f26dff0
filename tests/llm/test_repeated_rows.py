"""Rows that repeat an id, with texts long enough to count as repeated passages."""

import corpus_pipeline as pipeline


def test_one_row_of_a_repeated_id_stays(spark, tmp_path):
    text = " ".join(f"the word{i} of the number {i * 37}" for i in range(40))
    other = " ".join(f"and a quite different thing{i * 11} here" for i in range(40))
    assert len(text) > pipeline.REPEATED_BYTES
    rows = [(1, text, "en", "s", len(text))] * 3 + [(2, text, "en", "s", len(text)), (3, other, "en", "s", len(other)), (4, other[::-1], "en", "s", len(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    two = pipeline.drop_near_duplicates(spark, docs, "")
    assert two.columns == list(pipeline.COLUMNS)
    assert sorted((r.doc_id, r.text) for r in two.collect()) == [(1, text), (3, other), (4, other[::-1])]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "x y z of no one")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert {r.doc_id for r in pipeline.run(spark, str(tmp_path)).collect()} >= {1, 3}
