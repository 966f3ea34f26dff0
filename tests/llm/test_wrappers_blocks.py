"""What stands inside a line, what only looks like a menu, comments by any name, and constants inside articles."""

import html
import random

import pytest

from llm import wrappers


def text_of(page):
    return wrappers.extract(page, None)


def of_host(spark, pages):
    rows = [(i, f"http://h.example/{i}", p) for i, p in enumerate(pages)]
    got = {r.page_id: r.text for r in wrappers.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)).collect()}
    return [got[i] for i in range(len(pages))]


def test_lines_go_on_behind_what_stands_in_them():
    assert text_of("<p>before <svg><title>t</title><g><text>x</text></g></svg> after</p>") == "before after"
    assert text_of("<p>press <button>Buy <div>now</div></button> here</p><p>two</p>") == "press here\ntwo"
    assert text_of("<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='application/x-tex'>x=2</annotation></math> be</p>") == "let x=2 be"
    assert text_of("<p>before <math/> after 0</p>") == "before after 0"
    assert text_of("<p>one <select><option>a<option>b</select> two <video>x</video> three</p>") == "one two three"
    assert text_of("<p>one</p><aside>x</aside><p>two</p><p>a<nav>b</nav>c</p>") == "one\ntwo\na\nc"


@pytest.mark.parametrize("box", ['<ol class="commentlist">', '<div class="comment-thread">', '<section id="user-comments">', '<div id="comments">', '<div class="article-comments-area">', '<div id="disqus_thread">'])
def test_comments_by_any_name(box):
    end = box[1:].split()[0]
    assert text_of(f"<article><p>own</p>{box}<p>Reader says</p></{end}></article>") == "own"
    assert text_of(f"<div><p>own</p></div>{box}<p>Reader says</p></{end}>") == "own"


def test_articles_that_only_speak_of_comments():
    assert text_of('<body class="comments-open"><article class="post has-comments"><p class="comment-on-law">own</p></article></body>') == "own"
    assert text_of('<div class="no-comments"><p>own</p></div>') == "own"


def test_a_menu_is_links():
    assert text_of('<div class="menu"><p>Restaurant article about soup</p></div>') == "Restaurant article about soup"
    assert text_of('<div class="menu"><a href=/>Home</a> <a href=/x>Soup</a></div><p>own</p>') == "own"
    assert text_of('<div class="main-menu"><ul><li><a href=/>Home</a></ul></div><p>own</p>') == "own"


def test_constants_inside_articles(spark):
    def page(i):
        shared = "<p>We report results.</p>" if i % 10 < 6 else ""
        table = f"<table><tr><th>Kind</th><td>yes</td><td>{i}</td></tr></table>"
        return f"<html><body><div>Site</div><article><h1>Title {i}</h1><h2>Methods</h2>{shared}<p>Own text {i * 31} of this page, long enough.</p>{table}<p>before <math><mn>{i}</mn></math> after</p><p>Sign up for news.</p></article></body></html>"

    got = of_host(spark, [page(i) for i in range(20)])
    for i, t in enumerate(got):
        want = [f"Title {i}", "Methods", *["We report results."] * (i % 10 < 6), f"Own text {i * 31} of this page, long enough.", "Kind", "yes", str(i), f"before {i} after"]
        assert t.split("\n") == want  # what all pages have as a block of its own is a notice


def test_pages_without_semantic_elements(spark):
    """A generator whose pages are written from lists of blocks, which are the independent reading."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij&<éü") for _ in range(rng.randint(2, 9)))
    pages, want = [], []
    for i in range(24):
        blocks = [(rng.choice(["p", "p", "li", "blockquote"]), " ".join(word() for _ in range(rng.randint(5, 40)))) for _ in range(rng.randint(2, 9))]
        blocks.insert(0, ("h1", f"Story {i} {word()}"))
        body = "".join(f"<{t}>{html.escape(x)}</{t}>\n" for t, x in blocks)
        noise = '<div class="top"><a href=/>Home</a> | <a href=/n>News</a></div>'
        pages.append(f"<html><head><title>S</title></head><body>{noise}<div class=k{i % 2 and 'a' or 'a'}>{body}</div><div class=foot><p>Printed by us</p><a href=/t>Terms</a></div><div class='user-comments'><p>{word()} says {i}</p></div><script>x()</script></body></html>")
        want.append("\n".join(" ".join(x.split()) for _, x in blocks))
    assert of_host(spark, pages) == want
