"""Main text against a plain cut at the article's tags, and layouts the tables do not have."""

from __future__ import annotations

import html as entities
import re
import time

import pytest

from forespell.llm import page_text, queries

SF_DIR = "/root/testdata/sf0.01"


def plain(html):
    inside = re.split("</article>|<footer>", html.split("<article>", 1)[1])[0] if "<article>" in html else ""
    inside = re.sub(r"<[^>]*(>|$)", "", re.sub(r"</?(p|h1)>|<br>", " ", inside))
    return " ".join(entities.unescape(inside).split())


def test_query_against_the_article_tags(spark):
    want = {r["page_id"]: plain(r["html"]) for r in queries.table(spark, SF_DIR, "pages").collect()}
    got = queries.op3_page_text(spark, SF_DIR).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


@pytest.fixture(scope="module")
def model(spark):
    return page_text.train(queries.table(spark, SF_DIR, "pages"))


@pytest.mark.parametrize("opening", page_text.CONTAINERS)
def test_other_layouts(model, opening):
    closing = page_text._closing(opening)
    html = f"""<html><head><title>no</title><script>var a = "<p>no</p>"</script></head><body>
    <header><h2>Site name</h2></header><ul class="nav"><li><a href="/">Home</a></li><li><a href="/b">About us</a></li></ul>
    <div class="cookie banner"><p>We use cookies.</p></div>{opening}<h1>A title of the&nbsp;page</h1>
    <p>First words <b>in</b>side of a paragraph, with a&amp;b.</p><div class="ad">Buy this thing now</div>
    <p>Second   paragraph of the text, a bit longer than the first one was.</p>{closing}
    <section class="comments"><div class="comment"><p>I liked this text, said a reader.</p></div></section>
    <aside class="sidebar"><p>Read more</p></aside><form><label>Name</label><input><button>Send</button></form>
    <footer>&copy; Site &middot; all rights</footer></body></html>"""
    want = "A title of the page First words inside of a paragraph, with a&b. Second paragraph of the text, a bit longer than the first one was."
    assert model.main_text(html) == want


def test_odd_rows(spark, model):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>some words here in a row.</p>"), (3, "u", "<" * 1000), (4, "u", "plain words without tags"), (5, "u", "<article>" + "<p>long text here.</p>" * 50_000)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {r["page_id"]: r for r in page_text.extract(pages, model).collect()}
    assert got[1]["text"] == "" and got[2]["text"] == "" and got[2]["n_chars"] == 0 and len(got) == 6
    assert got[5]["text"] == " ".join(["long text here."] * 50_000)
    assert page_text.extract(pages.filter("false"), page_text.train(pages.filter("false"))).count() == 0


def test_learned_by_likelihood():
    pages = [([page_text.Block(t, page_text.Path.of((f"<{a}>",)), 0.0) for t, a in zip("abcd", tags, strict=True)], [int(a == "p") for a in tags]) for tags in (["nav", "p", "p", "div"], ["p", "p", "nav", "nav"])]
    model = page_text.fit(pages)
    assert [model.labels(p) for p, _ in pages] == [y for _, y in pages]


def test_deep_nesting_takes_its_own_length(model):
    """100,000 elements inside each other, each with text and names of its own, and as many stray closing tags."""
    depth = 100_000
    html = "<article><p>The text of the page, a full sentence.</p></article>" + "".join(f'<div class="n{"abcdefghij"[k % 10]} {"klmnopqrst"[k % 7]}x">x ' for k in range(depth)) + "</em></section>" * depth
    start = time.perf_counter()
    page = page_text.blocks(html)
    assert len(page) == depth + 1 and len(list(page[-1].around)) == 3 * depth
    model.labels(page)
    assert time.perf_counter() - start < 60
    assert sum(len(b.around.fresh) for b in page) < 200


def test_paths_name_what_is_above():
    page = page_text.blocks('<div class="aa bb"><p>one</p><div id="bb cc"><p>two</p></div></div><p>three</p><div class="aa bb"><p>four</p></div>')
    assert [b.text for b in page] == ["one", "two", "three", "four"]
    assert [tuple(b.around) for b in page[:3]] == [("<div>", "aa", "bb", "<p>"), ("<div>", "aa", "bb", "<div>", "bb", "cc", "<p>"), ("<p>",)]
    assert page[1].around.parent.fresh == ("cc",)
    assert page[0].around is page[3].around and page[0].around is not page[1].around
