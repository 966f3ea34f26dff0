"""Copies of texts in tables with repeated ids, null ids and one text that most rows hold."""

import random

import duckdb

from llm import tokencounts


def test_copies_equal_the_sql(spark, tmp_path):
    rng = random.Random(6)
    rows = [(rng.choice([None, *range(40)]), rng.choice(["a b", "a b", "a b", "c", "", None, "x y. z"]), rng.choice(["s", "t", None]), rng.choice(["en", None])) for _ in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(tokencounts.ORACLE)
    got = tokencounts.query(spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want.fetchall())) and got


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert tokencounts.query(spark, str(tmp_path)).count() == 0
