import re
from html import unescape

import pytest

from marquee.llm import html_text as h

TAIL = "Some sentence with words, commas, and a full stop that makes it long enough to count. "
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><div>x";</script></head><body class="page">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies, yes.</div>
<div class="wrap-12"><article id=a7><h1>Title &amp; more</h1><p>First   para&nbsp;one,
two.<p>Second <b>bold<br>text</b> %s</p><div class="ad">Buy, buy.</div><form><p>mail</p></form><!-- <p>no</p> -->
<ul><li>point one<li>point two</ul><section class="comments"><p>I, reader, say %s</p></section></article>
<aside>side, bar.</aside></div><footer>&copy; x</footer></body></html>""" % (TAIL, TAIL * 9)
TEXT = f"Title & more\nFirst para one, two.\nSecond bold text {TAIL.strip()}\npoint one\npoint two"


def test_main_text():
    found = h.blocks(PAGE)
    assert h.best_container(found)[0].endswith("article.a")
    assert h.extract(found, h.best_container(found)[0]) == TEXT


@pytest.mark.parametrize("page", ["", "plain text only, no tags.", "<p>unclosed <b>one", "<div", "a < b > c", "<script>x", "<div class='x'><p>t</p>" * 3000])
def test_odd_pages(page):
    h.best_container(h.blocks(page))


def main(page):
    found = h.blocks(page)
    best = h.best_container(found)
    return h.extract(found, best[0]) if best else ""


@pytest.mark.parametrize("open_, close", [
    ("<div class='layout has-sidebar'><article>", "</article></div>"), ("<div id='page' class='site no-comments'><article>", "</article></div>"),
    ("<div class='post-side'>", "</div>"), ("<div class='menu-page'><main>", "</main></div>"), ("<div class='notice'>", "</div>"),
    ("<section class='comments'>", "</section>"), ("<div class='outer'><div class='inner-sidebar'>", "</div></div>"),
])
def test_names_do_not_hide_the_article(open_, close):
    body = f"<p>{TAIL}</p><p>{TAIL}</p>"
    assert main(f"<html><body><nav>a, b.</nav>{open_}{body}{close}</body></html>") == f"{TAIL.strip()}\n{TAIL.strip()}"


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "cookie-notice", "comments", "post-comments", "left sidebar", "comment-list", "nav-menu"])
def test_names_hide_what_is_beside_the_text(name):
    page = f"<body><div class='story'><p>{TAIL}</p><div class='{name}'><p>{TAIL * 4}</p></div></div><p>x</p></body>"
    hidden = main(page.replace(TAIL * 4, TAIL[:40] + "."))
    assert hidden == TAIL.strip()
    # An article decides by itself, also when more text stands beside it.
    assert main(page.replace("div class='story'", "article").replace("</div></div>", "</div></article>")) == TAIL.strip()


def test_comments_as_articles_stay_hidden():
    page = f"<body><article><p>{TAIL}</p></article><ol class='comment-list'><li><article class='comment'><p>{TAIL * 5}</p></article></li></ol></body>"
    assert main(page) == TAIL.strip()


def test_math_and_noscript_stay():
    page = f"<article><p>{TAIL}<math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p><noscript><p>A picture of it.</p></noscript></article>"
    assert main(page) == f"{TAIL}x=2 holds.\nA picture of it."


def test_deep_nesting_takes_linear_memory():
    import tracemalloc
    sizes = []
    for depth in (10_000, 100_000):
        page = "<div class='x'><p>t.</p>" * depth + f"<p>{TAIL}</p>" + "</b2>" * 1000
        tracemalloc.start()
        found = h.blocks(page)
        best = h.best_container(found)
        assert best[0].count(">") == depth and TAIL.strip() in h.extract(found, best[0])
        sizes.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert sizes[1] < 15 * sizes[0] and sizes[1] < 300 << 20


def test_consensus_of_the_host(spark):
    body = "<html><body><div class='story'><p>%s</p></div><div class='teasers'><p>%s</p></div></body></html>"
    usual = body % (TAIL * 3, "short.")
    odd = body % ("Brief story.", TAIL * 5)  # by itself this page would choose its teasers
    rows = [(i, "http://a.org/x", usual, None) for i in range(5)] + [
        (5, "https://A.org:80/y?q", odd, 1), (6, "http://b.org/", odd, 1), (7, None, None, 1), (8, "bad url", "", 1), (9, None, PAGE, 1), (9, None, PAGE, 1),
        (None, "http://u@c.org", PAGE, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = h.main_text(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[5].text == "Brief story." and by[6].text.startswith("Some sentence")
    assert by[7].text == "" and by[8].text == "" and by[9].text == TEXT and by[None].text == TEXT
    assert all(r.n_chars == len(r.text) for r in got)
    assert h.main_text(pages.limit(0)).count() == 0


def test_given_pages_equal_a_plain_reading(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in h.main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?(b|i|em|a)\b[^>]*>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n".join(p for p in parts if p), r.page_id
