"""Cases of hostile and odd inputs, and searches against all pairs."""

import re
import time

import duckdb
import numpy as np
import pytest

from llm import langid, licences, packing, tiling, tokencounts, wrappers


def text_of(page):
    return wrappers.extract(page, None)


def test_words_mark_the_outside_only_where_they_stand_alone():
    assert text_of('<main><div class="post widget"><p>a text</p></div></main>') == "a text"
    assert text_of('<div id="search-results-study"><p>a text</p></div>') == "a text"
    assert text_of('<article><p class="related-work">one</p><p class="byline">two</p><div class="notice">three</div></article>') == "one\ntwo\nthree"
    assert text_of('<p>a <label>word</label> more</p><div class="site-footer"><p>x</p></div><div class="ad-slot">y</div><aside>z</aside>') == "a word more"
    assert text_of('<article><p>one</p><div class="comments"><p>x</p></div><div class="share">y</div></article>') == "one"
    assert text_of("<p>a<![CDATA[ x > y ]]>b</p>") == "ab"


@pytest.mark.parametrize("page", ["<a " * 60_000, "<div>" * 40_000, "<p>" * 40_000, "<!--" * 40_000, "<a \"'" * 40_000 + ">", "<li><ul>" * 20_000, "<![CDATA[" * 30_000, "</p>" * 40_000, "x" * 3_000_000])
def test_hostile_markup_is_read_in_time(page):
    began = time.perf_counter()
    wrappers.extract(page, None)
    assert time.perf_counter() - began < 10


def test_blocks_that_differ_in_the_middle_are_no_template(spark):
    middle = lambda i: "Begin of a block that is the same on each page, " + f"number {i:04d}" + ", and the end of it is the same as well, on each."
    rows = [(i, f"http://h/{i}", f"<body><div><p>{middle(i)}</p><p>{'own ' * 40}{i}</p></div></body>") for i in range(20)]
    got = wrappers.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text.split("\n")[0] == middle(r.page_id) for r in got)


def test_licences_that_are_wrapped_titled_and_embedded(spark):
    import textwrap

    isc = licences.TEXTS["ISC"]
    wrapped = "\n".join(textwrap.fill(p, 76) for p in isc.split("\n\n"))
    narrow = "\n\n".join(textwrap.fill(p, 60) for p in isc.split("\n\n"))
    mit = "MIT License\n\nCopyright (c) 2021 Some One\n\n" + licences.TEXTS["MIT"]
    rows = [(1, "Copyright 2020 X\n" + wrapped), (2, mit), (3, "A readme.\n\n" + mit + "\n\nMore."), (4, narrow), (5, "copyright notice and this permission notice appear")]
    got = {(r.doc_id, r.license_id, r.scope) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(1, "ISC", "document"), (2, "MIT", "document"), (3, "MIT", "passage"), (4, "ISC", "document")} <= got and not [g for g in got if g[0] == 5]


def test_licence_sql_knows_whole_texts_and_passages(spark, tmp_path):
    mit = licences.TEXTS["MIT"]
    rows = [(1, "MIT License\n\nCopyright (c) 2021 X\n\n" + mit), (2, "words\n\n" + mit + "\n\nmore\n" + mit), (3, (licences.FILES / "BSD-3-Clause.txt").read_text()), (4, "x\n" + (licences.FILES / "Unlicense.txt").read_text()), (5, "The GPLv3 License"), (6, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = {(r.doc_id, r.license_id, r.scope, r.n_units) for r in licences.query(spark, str(tmp_path)).collect()}
    assert got == set(con.sql(licences.oracle()).fetchall()) and {(1, "MIT", "document", 1), (2, "MIT", "passage", 2), (3, "BSD-3-Clause", "document", 1)} <= got


def test_tiling_finds_all_pairs_and_no_others(spark):
    """Every document against every item, without seeds."""
    d = "/root/testdata/sf0.001"
    split = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
    codes: dict[str, int] = {}
    number = lambda words: np.array([codes.setdefault(w, len(codes) * 7919 + 1) for w in words], np.uint64)
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    more = [(90_001, "zzz yes no zzz"), (90_002, "zzz Yes, NO!"), (90_003, "no yes"), (90_004, "word " * 30_000)]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    items = spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").unionByName(spark.createDataFrame([(9001, "yes no"), (9002, "..."), (9003, "word word word word")], "item_id long, text string"))
    want = set()
    texts = [(r.doc_id, number(split(r.text))) for r in docs.collect()]
    for item in items.collect():
        w = number(split(item.text))
        for doc_id, x in texts:
            if len(w) and len(x) and len(np.intersect1d(w, x)) >= 0.5 * len(set(w.tolist())) and sum(t[2] for t in tiling.tile(w, x, min(5, len(w)))) >= 0.5 * len(w):
                want.add((doc_id, item.item_id))
    for size in (tiling.BLOCK_WORDS, 500):
        assert {(r.doc_id, r.item_id) for r in tiling.contained(docs, items, block_words=size).collect()} == want
    assert {(90_001, 9001), (90_002, 9001), (90_004, 9003)} <= want


def test_commits_are_atomic_and_compacted(spark, tmp_path):
    change = lambda *rows: spark.createDataFrame(list(rows), "source string, lang string, tokenizer string, sign int, n_tokens long")
    path = str(tmp_path / "r")
    rollup = tokencounts.Rollup(spark, path)
    total = lambda: {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}
    assert total() == {}
    rollup.commit(1, change(("a", "en", "v", 1, 10), (None, None, "v", 1, 3)))
    rollup.commit(2, change(("a", "en", "v", 1, 7)))
    # an attempt that broke off: written, but not whole
    (tmp_path / "r" / "batch=2" / "attempt=2").mkdir()
    before = total()
    assert before == {("a", "en", "v"): (2, 17), (None, None, "v"): (1, 3)}
    rollup.compact(1)
    assert total() == before
    rollup.commit(2, change(("a", "en", "v", 1, 8)))
    assert total()[("a", "en", "v")] == (2, 18)
    rollup.compact(2)
    assert total()[("a", "en", "v")] == (2, 18)
    with pytest.raises(ValueError):
        rollup.commit(2, change(("a", "en", "v", 1, 1)))
    rollup.commit(3, change(("a", "en", "v", -1, 10)).limit(0))
    assert total()[("a", "en", "v")] == (2, 18)


def test_counts_of_a_vocabulary(spark):
    path = packing.default_tokenizer()
    rows = [(1, "Some words, and it's 12."), (2, None), (3, ""), (None, "é" * 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    t = packing._tokenizer(path)
    got = {(r.doc_id, r.bpe) for r in tokencounts.vocabulary_counts(df, "bpe", path).collect()}
    assert got == {(i, len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in rows}
    assert tokencounts.vocabulary_counts(df.limit(0), "bpe", path).count() == 0


def test_token_counts_of_odd_tables(spark, tmp_path):
    rows = [(None, "a b", "en", None), (1, "a b", "en", "s"), (2, "a b", "en", "s"), (3, None, None, "s")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.source, r.lang, r.n_docs, r.n_tokens) for r in tokencounts.query(spark, str(tmp_path)).collect()}
    assert got == {(None, "en", 1, 2), ("s", "en", 1, 2), ("s", None, 1, 0)}
    empty = tmp_path / "empty"
    spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0).write.parquet(str(empty / "documents.parquet"))
    assert tokencounts.query(spark, str(empty)).count() == 0


def test_language_by_plain_counting(spark, sf):
    """Counts, weights, cosines and the choice, text by text and n-gram by n-gram."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(docs.filter(~langid.held_out()))
    rows = [(r.doc_id, r.text) for r in docs.collect()][:60] + [(9001, "Das ist " * 20_000), (9002, "a"), (9003, "  --  "), (9004, "日本語")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    for i, text in rows:
        seen = "".join(chr(b) if b >= 128 else chr(b).lower() if chr(b).isalpha() else " " for b in (text or "").encode())
        seen = re.sub(" +", " ", seen)
        vector = np.zeros(langid.DIMENSIONS)
        for n in langid.GRAMS:
            for j in range(len(seen) - n + 1):
                code = 0
                for c in seen[j : j + n]:
                    code = (code << 8 | ord(c)) & 0xFFFFFFFF
                code = (code * 0x9E3779B1 + n * 0x85EBCA6B) & 0xFFFFFFFF
                vector[(code >> 16) % langid.DIMENSIONS] += 1
        x = np.log1p(vector) * model.idf
        cosine = (model.centroids @ (x / max(np.linalg.norm(x), 1e-12))).reshape(len(model.languages), -1).max(axis=1)
        if not any(c.isalpha() for c in text or ""):
            assert got[i] == ("und", 0.0)
        else:
            assert got[i][0] == model.languages[int(cosine.argmax())] and got[i][1] == pytest.approx(max(cosine.max(), 0), abs=1e-4)
