"""A notice that stands on every page, or on some, of a host with long articles."""

from llm import wrappers


def page(i, paragraphs, notice):
    own = "".join(f"<p>Paragraph {k} of page {i} tells {i * 977 + k * 31}.</p>" for k in range(paragraphs))
    return f"<html><body><div class=a><h1>Title {i}</h1>{own}{'<p>Our standing notice to all readers.</p>' if notice else ''}</div></body></html>"


def test_notice_of_long_pages(spark):
    rows = [(h * 1000 + i, f"http://h{h}.example/{i}", page(i, 60, i % 20 < most)) for h, most in enumerate((20, 11, 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in wrappers.extracted(df).collect()}
    assert len(got) == 600 and all(f"Paragraph {k} of page" in t for t in got.values() for k in (0, 59))
    held = [sum("standing notice" in got[h * 1000 + i] for i in range(200)) for h in range(3)]
    assert held == [0, 0, 90]
