import html
import re

import numpy as np
import pytest

from affinis.llm import extract as e
from affinis.llm.html_blocks import blocks
from affinis.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav class="top-menu"><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav><div class="cookie-notice">We use cookies</div>
<!-- <p>gone</p> --><article><h1>A title &amp; more</h1><p>First <b>bold</b>
 text &lt;x&gt; &eacute;&#8211;.<br>Next line.<p>Second paragraph with a <a href=x>link</a> inside it.
<aside class="related">Related: other</aside><ul><li>one item<li>two items</ul></article>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I liked this very much, thank you.</p></div></section>
<form><label>Email</label><button>Subscribe</button></form><footer>&copy; site</footer></body></html>"""
TEXT = "A title & more First bold text <x> é–. Next line. Second paragraph with a link inside it. one item two items"


def test_blocks():
    found = blocks("<div class='sideBar main-x'>a &amp; b<br>c <a href=1>link</a></div>x < y<p>1<p>2<table><tr><td>3<td>4</table><p id=end cl")
    assert [b.text for b in found] == ["a & b c link", "x < y", "1", "2", "3", "4"]
    assert found[0].path == ("div", ".side", ".bar", ".main", ".x") and found[0].linked == 4
    assert blocks(None) == [] and blocks("") == [] and blocks("<script>a</script><!-- x") == []
    assert [b.text for b in blocks("a<script>b")] == ["a"] and [b.text for b in blocks("</p>tail &am")] == ["tail &am"]
    assert len(blocks("<div>" * 3000 + "deep")) == 1


def test_gradient():
    model = e.BlockLabeller()
    r = np.random.default_rng(0)
    for name in model.p:
        model.p[name] = model.p[name].astype(np.float64)
    model.p["S"] = r.standard_normal(model.p["S"].shape) * 0.1
    x = r.standard_normal((3, 5, e.WIDTH)) * (r.random((3, 5, e.WIDTH)) < 0.1)
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], float)
    y = r.integers(0, 2, (3, 5)).astype(float)
    _, grad = model.gradient(x, mask, y)
    for name, p in model.p.items():
        at = np.unravel_index(int(np.abs(grad[name]).argmax()), p.shape)
        old, eps = p[at], 1e-4
        p[at] = old + eps
        up = model.gradient(x, mask, y)[0]
        p[at] = old - eps
        down = model.gradient(x, mask, y)[0]
        p[at] = old
        assert grad[name][at] == pytest.approx((up - down) / (2 * eps), rel=1e-3), name


def test_unseen_layouts():
    model = e.trained()
    pages = [e.labelled(s) for s in range(50_000, 50_200)]
    found = model.label([x for x, _ in pages])
    right = sum(int((f == (y > 0)).sum()) for f, (_, y) in zip(found, pages, strict=True))
    assert right >= 0.95 * sum(len(y) for _, y in pages)


def test_pages(spark):
    rows = [(1, "u", PAGE, "clash"), (None, None, None, None), (2, "u", "", "x"), (2, "u", "", "x"), (3, "u", PAGE.replace("link", "link " * 30_000), "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text, r.n_chars) for r in e.extract(df, ["page_id", "url"]).collect()]
    long = TEXT.replace("link", " ".join(["link"] * 30_000))
    assert got == [(1, TEXT, len(TEXT)), (None, "", 0), (2, "", 0), (2, "", 0), (3, long, len(long))]
    assert e.extract(df.limit(0), ["page_id"]).collect() == []


def test_query_gives_the_articles(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op5_main_text"](spark, sf_dir).collect():
        article = pages[r.page_id].partition("<article>")[2].partition("</article>")[0]
        assert r.text == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split()) and r.n_chars == len(r.text)


def test_pages_without_optional_tags_and_with_stray_quotes():
    from affinis.llm.html_blocks import blocks

    texts = lambda page: [b.text for b in blocks(page)]
    assert texts("<html><head><title>t</title><p>Hello there<p>second") == ["Hello there", "second"]
    assert texts("<p title=don't>one</p><p>two</p><p>it's three</p><p>four</p>") == ["one", "two", "it's three", "four"]
    assert texts("<head><title>t</title><style>p > a {}</style><body><p>a") == ["a"]
    assert texts("<p>a<svg><p>b<canvas>c") == ["a", "b", "c"] or texts("<p>a<svg><p>b<canvas>c") == ["a", "bc"]
    assert texts("""<p title="a > b" id='x>y'>in</p><p data-x = "1>2">on</p>""") == ["in", "on"]
    assert texts('<p title="never closed>lost</p><p>kept</p>') == ["lost", "kept"]
    assert texts("<script>if (a < b) '<p>'</script><p>a</p><script>open <p>b") == ["a"]
    assert texts("<p " + "a=" * 50_000) == []
