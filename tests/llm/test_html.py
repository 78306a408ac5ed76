import re

import pytest

from netbaseline.llm import html_text as H

TEXT = ["First line of the story with enough words in it.", "Second & last line, a < b, of the same story here."]


def page(body, head="<title>T</title><style>p{}</style><script>var x='</p><article>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


ARTICLE = f"<p>{TEXT[0]}</p>\n<p>Second &amp; last line,\n a &lt;  b, of <b>the</b> same <a href=x>story</a> here.</p>"


@pytest.mark.parametrize("body", [
    f"<nav><ul><li><a>Home</a></li></ul></nav><article>{ARTICLE}</article><footer>foot</footer>",
    f"<div class='menu'><a>m</a></div><div class='content post-12'>{ARTICLE}</div><div id='sidebar'><p>Other story text.</p></div>",
    f"<header><h1>Site</h1></header><main><div class=ad>Buy now, this is an advert.</div>{ARTICLE}"
    f"<section class='comments'><article class='comment'><p>{'I liked this very much. ' * 20}</p></article></section></main>",
    f"<form><div class='wrap'><article>{ARTICLE}<form><p>Mail address please</p><input></form></article></div></form>",
    f"<table><tr><td class='nav'>n</td><td>{ARTICLE}</td></tr></table><div class='cookie-notice'><p>We use cookies on it.</p></div>",
    f"<article><p>{TEXT[0]}<p>Second &amp; last line, a &lt; b, of the same story here.</article>",
    f"<article><p><b>{TEXT[0]}<br><p><i>Second &amp; last line, a &lt; b, of the same story here.",
    f"<div id=topNav><a>a</a></div><div>{ARTICLE.replace('the story', 'the<span class=ad-slot>Buy <b>now</b></span> story', 1)}<ins class='adsbygoogle'>"
    f"Advert text</ins><div class='share-buttons'>Share</div><ul class=commentList><li>{'I agree with it. ' * 9}</li></ul></div>",
    f"<aside>{'Some words aside. ' * 30}</aside><div><div>{ARTICLE}</div></div><!-- <p>comment</p> --><script>if(a<b){{}}",
])
def test_templates(body):
    assert H.Page(page(body)).text(None) == "\n".join(TEXT)


LONG = "A long paragraph of the body goes on and on with many words in it. " * 6


@pytest.mark.parametrize("body,lines", [
    (f"<article><h1>The heading</h1><div class=intro><p>{TEXT[0]}</p></div><div class=body><p>{LONG}</p></div></article>",
     ["The heading", TEXT[0], LONG.strip()]),
    (f"<section class=a><p>{LONG}</p></section><section class=b><p>{LONG} Second.</p></section>", [LONG.strip(), LONG + "Second."]),
    (f"<div class=menu2><a>Home page of it</a> <a>Other pages here</a></div><div class=post><h1>The heading</h1>"
     f"<div class=body><p>{LONG}</p></div></div>", ["The heading", LONG.strip()]),
    (f"<div class=x9><ul><li><a href=1>One link of a list</a></li><li><a href=2>Another link of it</a></li></ul>"
     f"<div class=body><p>{LONG}</p><blockquote class=alert>{TEXT[0]}</blockquote></div></div>", [LONG.strip(), TEXT[0]]),
    (f"<div class=search-results><p>{LONG}</p></div>", [LONG.strip()]),
    (f"<div class=post><h2 class=entry-header>The heading</h2><p>{LONG}</p><p>So <math><mi>a</mi>+<mi>b</mi></math> is it.</p></div>",
     ["The heading", LONG.strip(), "So a+b is it."]),
])
def test_whole_articles(body, lines):
    """Split articles stay whole; class words do not judge quotations, headings and results; formulas stay."""
    assert H.Page(page(body)).text(None).split("\n") == lines


def test_deep_pages_take_little():
    """Memory and time go with the size of a page, not with the square of its depth."""
    import time
    import tracemalloc
    source = "<div class=c>" * 50_000 + "<p>deep text is here and goes on</p>"
    tracemalloc.start()
    start = time.time()
    assert H.Page(source).text(None) == "deep text is here and goes on"
    assert tracemalloc.get_traced_memory()[1] < 200 << 20 and time.time() - start < 30
    tracemalloc.stop()


def test_odd_pages():
    for source in ("", "   ", "<", "<p", "<!--", "<script>", "</p></div>", "<div " * 50, "\x00<\x01>", "<p>" * 3000):
        H.Page(source).text(None)
    assert H.Page("plain words").text(None) == "plain words"
    assert H.Page("<p>&nbsp;a&#160;b&unknown; &#x41;</p>").text(None) == "a b&unknown; A"
    long = "<div>" * 2000 + "<p>deep text is here and goes on</p>"
    assert H.Page(long).text(None) == "deep text is here and goes on"


def test_consensus_wins_over_a_page_of_its_own(spark):
    """A page whose comments outweigh its text follows the path that its host's pages agree on."""
    normal = page(f"<div class='story-1'>{ARTICLE}</div><div class='talk'><p>short</p></div>")
    odd = page(f"<div class='story-77'><p>{TEXT[0]}</p></div><div class='talk'><p>{'Reader chatter goes on. ' * 40}</p></div>")
    rows = [(i, "http://h.example/1", normal) for i in range(5)] + [
        (10, "http://H.example/2", odd), (11, "http://other.example/", odd), (12, None, normal), (13, "http://h.example/3", None),
        (14, "http://h.example/4", ""), (14, "http://h.example/4", ""), (None, "x", page("<p>no host at all here</p>"))]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    for bound in (H.MAX_BROADCAST_HOSTS, 0):
        H.MAX_BROADCAST_HOSTS, saved = bound, H.MAX_BROADCAST_HOSTS
        try:
            out = H.extract_text(df).collect()
        finally:
            H.MAX_BROADCAST_HOSTS = saved
        assert len(out) == len(rows)
        by = {r["page_id"]: r for r in out}
        assert by[0]["text"] == "\n".join(TEXT) and by[0]["n_chars"] == len(by[0]["text"])
        assert by[10]["text"] == TEXT[0]
        assert by[11]["text"].startswith("Reader chatter")
        assert by[13]["text"] == by[14]["text"] == "" and by[None]["text"] == "no host at all here"
    assert H.extract_text(df.where("false")).collect() == []


def test_pages_give_back_their_documents(spark):
    """The test pages were made from documents: a heading, then the document's lines."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    out = H.extract_text(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()
    for r in out:
        number = int(re.search(r"://[^/]*/[a-z]+/(\d+)", r["url"])[1])
        lines = [" ".join(x.split()) for x in docs[number].split("\n") if x.split()]
        assert r["text"].split("\n")[1:] == lines
