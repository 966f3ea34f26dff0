import re
from html import unescape

from llm import wrappers


def truth(page):
    """The generator's pages keep the article in one element; what its blocks hold, by another route."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
    return "\n".join(x for x in blocks if x)


def test_pages_of_the_table(spark, sf):
    want = {r.page_id: (r.url, truth(r.html)) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = wrappers.query(spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.url, r.text) == want[r.page_id] and r.n_chars == len(r.text)


def page(i, where="div"):
    return f"""<html><head><title>T {i}</title></head><body><div id=top>My Site</div><div><a href=/a>Home</a> <a href=/b>Shop {i}</a></div>
    <div class=x1><h2>Title {i}</h2><p>First text &amp; more {i} with <b>bold</b>\n words.<p>Second {i * 37} text is here too.<br>End</p>
    <p>Like what you read? Tell your friends.</p></div><ul><li>About<li>Terms</ul><div class="comments"><p>Reader says {i}</p></div><script>if (a<b) x("</p>")</script></body>"""


def test_template_without_semantic_elements(spark):
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(12)] + [(100, None, None), (101, "x", ""), (101, "x", "<p>only &#x41;&nbsp; one"), (None, "http://h.example/z", page(99))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as host").repartition(3)
    got = {(r.page_id, r.url): r.text for r in wrappers.extracted(df).collect()}
    for i in range(12):
        assert got[(i, f"http://h.example/{i}")] == f"Title {i}\nFirst text & more {i} with bold words.\nSecond {i * 37} text is here too. End"
    assert got[(100, None)] == ""
    assert wrappers.extracted(df).count() == 16 and wrappers.extracted(df.limit(0)).count() == 0
    old, wrappers.SENT_BYTES = wrappers.SENT_BYTES, 0
    try:
        assert {(r.page_id, r.url): r.text for r in wrappers.extracted(df).collect()} == got
    finally:
        wrappers.SENT_BYTES = old


def test_matching_is_the_best_common_tree():
    a = wrappers.as_slots(wrappers.parse("<div><h1>a</h1><p>x</p></div><div class=q><p>y</p></div>").items)
    b = wrappers.as_slots(wrappers.parse("<div class=q><p>z</p></div><div><p>x</p></div>").items)
    assert wrappers.matching(a, b)[0] == 3
    deep = wrappers.parse("<div>" * 5000 + "x<p>y")
    assert wrappers.extract("<div>" * 5000 + "x<p>y", None) == "x\ny" and deep.items
