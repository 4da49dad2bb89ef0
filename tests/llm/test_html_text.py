import itertools
import random
import time

import pytest

from racestream.llm.html_text import DEFAULT_ODDS, Page, extract_text, learn_odds, minimum_cut

from .fixtures import with_clashes


def total(costs, edges, side):
    return (sum(max(c, 0) if not on else max(-c, 0) for c, on in zip(costs, side))
            + sum(w for i, j, w in edges if side[i] != side[j]))


def test_minimum_cut_against_all_labellings():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 9)
        costs = [rng.randint(-6, 6) for _ in range(n)]
        edges = [(i, j, rng.randint(0, 4)) for i in range(n) for j in range(i + 1, n) if rng.random() < .5]
        sides = list(itertools.product([False, True], repeat=n))
        least = min(total(costs, edges, s) for s in sides)
        got = minimum_cut(costs, edges)
        assert tuple(got) == max((s for s in sides if total(costs, edges, s) == least), key=sum)


SITE = """<!DOCTYPE html><html><body class="has-sidebar"><header><h1>Site</h1><p>Welcome to the best site of all.</p></header>
<nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies to give you the best experience on our website.</p></div>
<div id=wrapper class="content-with-sidebar">{article}
<aside>Related things are here, in a whole sentence.</aside></div><footer>&copy; 2020 the makers of the site.</footer>"""
ARTICLE = """<article><header><h1>Title &amp; more</h1></header><p>First long paragraph of the text, with many words in it. Yes.</p>
<div class="ad">Buy now! It is a very long advertisement text with a sentence.</div><p>Be.</p>
<p>Second <b>para</b><i>graph</i>, line<br>break &lt;tag&gt; &nbsp; x &am &quot;</p><ul><li>one<li>two</ul>
<script>var t = "</p>";</script><!-- <p>no</p> --><form><label>mail</label><input></form>
<section class="comments"><h2>Comments</h2><article><p>I liked this very much, thank you all for that.</p></article></section>
</article>"""
TEXT = ("Title & more\nFirst long paragraph of the text, with many words in it. Yes.\nBe.\n"
        "Second paragraph, line break <tag> x &am \"\none\ntwo")


@pytest.mark.parametrize("article", [ARTICLE, ARTICLE.replace("article", "main"),
                                     ARTICLE.replace("<article>", '<div role="main">', 1)[:-len("</article>")] + "</div>"])
def test_article_without_the_rest(article):
    assert Page(SITE.format(article=article)).text(DEFAULT_ODDS) == TEXT


def test_page_without_semantic_markup():
    long = "<p>This is a paragraph of the text, long enough to be told from a menu, I hope.</p>"
    html = ("<div><a href=1>Home</a></div><div><a href=2>News</a></div><div><a href=3>About us</a></div>"
            f"<div><h1>A heading</h1>{long}{long}<p>Short.</p>{long}</div><div><a href=4>Imprint</a></div>")
    lines = Page(html).text(DEFAULT_ODDS).split("\n")
    assert lines[0] == "A heading" and "Short." in lines and len(lines) == 5


@pytest.mark.parametrize("html,text", [
    ("", ""), ("<article><p>a b.", "a b."), ("<article>x<p class='y", "x"), ("<article>x<!-- y", "x"),
    ("<article><script>x</p>", ""), ("<article>1 < 2 & 3 <> 4</article>", "1 < 2 & 3 <> 4"),
    ("<article><p title='a>b'>t</p></article>", "t"), ("<article><p>a</b></p></i>b</article>", "a\nb"),
    ("<article>a\n\t b</article>", "a b"), ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    ("<article hidden>x</article>", ""), ("</article></p>", ""), ("<article><p style='display: none'>x</p>y</article>", "y")])
def test_odd_markup(html, text):
    assert Page(html).text(DEFAULT_ODDS) == text


def test_hostile_pages_take_linear_time():
    start = time.time()
    for html in ("<div>" * 50_000 + "x" + "</i>" * 50_000, '<a href="' * 50_000, "<script>" * 50_000, "<!--" * 50_000,
                 "<i><div>" + "<b>" * 30_000 + "</i>" * 30_000, "<p a='" * 30_000, "&amp" * 50_000):
        Page(html).text(DEFAULT_ODDS)
    paragraphs = "<p>word and more words.</p><div class=ad>x</div>" * 10_000
    assert Page(f"<article>{paragraphs}</article>").text(DEFAULT_ODDS).count("\n") == 9_999
    assert time.time() - start < 30


PAGES = "page_id long, url string, html string"


def test_learning(spark):
    body = SITE.format(article="<article>" + "<p>ein satz ohne ende</p>" * 5 + "</article>")
    odds = learn_odds(spark.createDataFrame([(i, "u", body) for i in range(60)], PAGES))
    assert odds["end0"] > DEFAULT_ODDS["end0"] and all(abs(v) <= 1 for v in odds.values())
    assert set(DEFAULT_ODDS) <= set(odds)
    assert learn_odds(spark.createDataFrame([], PAGES)) == DEFAULT_ODDS


def test_rows(spark):
    page = SITE.format(article=ARTICLE)
    rows = [(1, "u", None), (2, None, ""), (3, "u", page), (3, "u", page), (None, "u", "no markup"), (4, "u", "<p>" * 10)]
    df = with_clashes(spark.createDataFrame(rows, PAGES)).withColumnRenamed("text_b", "main_text")
    got = extract_text(df, df.columns, DEFAULT_ODDS).select("row.page_id", "main_text").collect()
    assert sorted((r[0] or 0, r[1]) for r in got if r[0]) == [(1, ""), (2, ""), (3, TEXT), (3, TEXT), (4, "")]
    assert len(got) == 6
    assert extract_text(df.limit(0), ["page_id"], DEFAULT_ODDS).collect() == []
    broken = spark.createDataFrame([(b"<article>a \xff b.</article>",)], "html binary")
    assert extract_text(broken, [], DEFAULT_ODDS).first().main_text == "a � b."
