from pyspark.sql import functions as F

from llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.query(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 200 and sum(r.lang_pred == r.lang for r in got) / len(got) >= 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    train = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "fr"), (4, "x", None)], "doc_id long, text string, lang string")
    model = langid.fit(train)
    assert model.languages == ["en", "fr"]
    odd = spark.createDataFrame([(1, "the dog", 1.0), (1, "the dog", 1.0), (None, "le chat", 2.0), (2, None, 0.0), (3, "", 0.0), (4, "123 !?", 0.0), (5, "日本", 0.0)], "doc_id long, text string, score double")
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(odd, model).collect()}
    assert {(1, "en"), (None, "fr"), (2, "und"), (3, "und"), (4, "und")} <= got and (5, "und") not in got
    assert langid.predict(odd, model).count() == 7
    assert langid.fit(train.limit(0)) is None
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}
    assert langid.predict(odd.limit(0), model).count() == 0
    far = langid.reject(langid.predict(odd, model), 1.1)
    assert far.filter(F.col("lang_pred") != "und").count() == 0
