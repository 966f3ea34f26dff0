"""Queries that SQL can express, and odd rows of the native operators."""

import duckdb
import pytest

from llm import licences, registry, tokencounts


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows(spark, sf, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    df, want = registry.QUERIES[name](spark, sf), con.sql(registry.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(str(tuple(dict(zip(want.columns, r))[c] for c in columns)) for r in want.fetchall())


def test_licences_of_odd_rows(spark):
    mit = licences.TEXTS["MIT"]
    rows = [
        (1, "Copyright (c) 2020 Someone\n" + mit.replace("\n", "\n  ").upper()), (2, "some words\nRELEASED under the MIT Licence!\nmore"), (2, "Released under the MIT License."),
        (3, None), (4, ""), (5, "released under the mit license but not only"), (None, mit), (6, "x\n\n" + licences.TEXTS["ISC"].split("\n\n")[0]), (7, "a" * 300_000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as license_id", "2 as digest", "3 as scope")
    got = {(r.doc_id, r.license_id, r.scope, r.n_units) for r in licences.scan(df).collect()}
    assert got == {(1, "MIT", "document", 1), (2, "MIT", "document", 1), (2, "MIT", "paragraph", 1), (2, "MIT", "line", 2)}
    assert licences.scan(df.limit(0)).count() == 0


def test_rollup_is_idempotent(spark, tmp_path):
    change = lambda *rows: spark.createDataFrame(list(rows), "source string, lang string, tokenizer string, sign int, n_tokens long, n_docs int")
    rollup = tokencounts.Rollup(spark, str(tmp_path / "r"))
    rollup.commit(1, change(("a", "en", "v", 1, 10, 0), ("a", "en", "v", 1, 5, 0), (None, None, "v", 1, 2, 0), ("b", "en", "v", 1, None, 0)))
    for _ in range(3):
        rollup.commit(2, change(("a", "en", "v", -1, 5, 0)))
    total = lambda: {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert total() == {("a", "en", "v"): (1, 10), (None, None, "v"): (1, 2), ("b", "en", "v"): (1, 0)}
    rollup.commit(3, change(("a", "en", "v", -1, 10, 0), ("a", "en", "v", 1, 12, 0)))
    rollup.commit(4, change(("b", "en", "v", -1, None, 0)).limit(0))
    assert total()[("a", "en", "v")] == (1, 12) and len(total()) == 3
