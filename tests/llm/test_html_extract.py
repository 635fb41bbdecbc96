import html
import re

import pytest
from llm_helpers import SF_SMALL

from matchlog.llm import html_extract, queries
from matchlog.llm.html_extract import main_text

WORDS = "Plain sentences of an article that go on for a good while, so that a block holds many characters and few tags."


def page(article, before="", after="", head=""):
    return f"<!DOCTYPE html><html><head><title>Title</title>{head}</head><body>{before}{article}{after}</body></html>"


def brute(h):
    """The given pages have one article of headings, paragraphs, bold and br."""
    inside = re.search(r"<article>(.*)</article>", h, re.S).group(1)
    blocks = [re.sub("</?b>", "", b.replace("<br>", " ")) for b in re.split("</?(?:h1|p)>", inside)]
    return "\n".join(" ".join(html.unescape(b).split()) for b in blocks if " ".join(html.unescape(b).split()))


def test_query_against_plain_extraction(spark):
    rows = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = queries.op13_html_extract(spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == brute(rows[r["page_id"]]) and r["n_chars"] == len(r["text"])


MENU = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
BOILERPLATE = [
    MENU,
    "<header><a href='/'>Site</a><h1>Site name</h1><p>A long slogan of the site that is a whole sentence of text.</p></header>",
    f"<footer><p>{WORDS}</p>&copy; 2020</footer>",
    f'<div class="ad"><p>{WORDS}</p></div>',
    f'<div id="cookie-banner" role="dialog"><p>{WORDS}</p><button>Accept</button></div>',
    f"<aside><p>{WORDS}</p></aside>",
    f'<div class="mainSidebar">{WORDS}</div>',
    f'<section class="comments"><h2>Comments</h2><article class="comment"><p>{WORDS}</p></article></section>',
    f"<form action='/s'><label>Search</label><input name=q value='x'><textarea>{WORDS}</textarea><select><option>One</select></form>",
    f"<script>var x = '<p>{WORDS}</p>';</script><style>p {{ margin: 0 }}</style><noscript><p>{WORDS}</p></noscript>",
    f"<!-- <p>{WORDS}</p> -->",
    f'<div role="navigation">{WORDS}</div>',
    f"<p hidden>{WORDS}</p><p style='display: none'>{WORDS}</p>",
    f'<div class="notice">{WORDS}</div>',
]
ARTICLE = f"<h1>A  title</h1><p>{WORDS}</p><p>Short.</p><ul><li>One</li><li>Two <a href='/x'>linked</a></li></ul><p>{WORDS}<br>after</p><p>End.</p>"
TEXT = f"A title\n{WORDS}\nShort.\nOne\nTwo linked\n{WORDS} after\nEnd."


@pytest.mark.parametrize("part", BOILERPLATE)
@pytest.mark.parametrize("wrap", ["article", "main", 'div class="content"', 'div id="mainContent"', 'div role="main"'])
def test_boilerplate_of_a_kind_is_left_out(part, wrap):
    article = f"<{wrap}>{ARTICLE}</{wrap.split()[0]}>"
    assert main_text(page(article, before=part)) == TEXT
    assert main_text(page(article, before=MENU, after=part)) == TEXT
    within = f"<{wrap}>{ARTICLE[: -len('<p>End.</p>')]}{part}<p>End.</p></{wrap.split()[0]}>"
    if "<header>" not in part:
        assert main_text(page(within, before=MENU)) == TEXT


def test_page_without_a_marked_article():
    body = f"<div><a href=1>One</a> <a href=2>Two</a></div><div><h1>A title</h1><p>{WORDS}</p><p>Short.</p><p>{WORDS}</p><p>End.</p></div><div><a href=3>More</a></div>"
    assert main_text(page(body)) == f"A title\n{WORDS}\nShort.\n{WORDS}\nEnd."


def test_header_of_the_article_keeps_its_title():
    assert main_text(page(f"<article><header><h1>Title</h1><p>By someone</p></header><p>{WORDS}</p></article>")) == f"Title\n{WORDS}"


def test_wrapper_with_a_misleading_class():
    wrapped = f'<div class="menu-open sidebar"><article class="has-ads">{ARTICLE}</article></div>'
    assert main_text(page(wrapped)) == TEXT
    assert main_text(page(f"<form id=aspnet><main>{ARTICLE}</main></form>")) == TEXT


def test_class_names_about_a_topic_exclude_nothing():
    named = f'<article class="post type-post category-advertising tag-cookies status-publish">{ARTICLE}</article>'
    assert main_text(page(named, before=MENU)) == TEXT
    assert main_text(page(f"{named}<div class='adslot top'>{WORDS}</div><div class='tag-list'><a href=1>x</a></div>", before=MENU)) == TEXT


def test_small_article_inside_the_main_part():
    inner = f"<main><h1>Title</h1><p>{WORDS}</p><p>{WORDS}</p><p>{WORDS}</p><article><p>{WORDS}</p></article></main>"
    assert main_text(page(inner, before=MENU)) == "\n".join(["Title", WORDS, WORDS, WORDS, WORDS])
    posts = "".join(f"<article><h2>Post {i}</h2><p>{WORDS}</p></article>" for i in range(3))
    assert main_text(page(posts, before=MENU)) == "\n".join(f"Post {i}\n{WORDS}" for i in range(3))


def test_references_white_space_and_unclosed_tags():
    text = "a &amp; b &lt;c&gt; &eacute;&#233;&#xe9; &nbsp; x\n\t y &amp z &am &unknown; 1 < 2"
    assert main_text(page(f"<article><p>{text}<p><b>bold<br><p>next</article>")) == "a & b <c> ééé x y & z &am &unknown; 1 < 2\nbold\nnext"
    assert main_text(page(f"<article><p>{WORDS}</p><p>last", before=MENU).split("</body>")[0]) == f"{WORDS}\nlast"
    assert main_text(f"<article><p>{WORDS}</p><p>kept</p><a href='x") == f"{WORDS}\nkept"
    assert main_text(f"<article><p>{WORDS}</p><!-- never ends <p>x</p>") == WORDS
    assert main_text(f"</p></div><article></span><p>{WORDS}</b></p></article></article>") == WORDS
    assert main_text(f"<article><table><tr><td>a<td>b<tr><td>{WORDS}</table></article>") == f"a\nb\n{WORDS}"
    assert main_text(f"<ARTICLE><P>{WORDS}<SCRIPT>if (a</b) x('</p>')</SCRIPT></ARTICLE>") == WORDS


def test_short_article_beside_longer_boilerplate():
    assert main_text(page("<article><h1>Hi.</h1></article>", before=MENU, after=f"<footer>{WORDS}</footer>")) == "Hi."
    assert main_text(page("<article><p><a href=1>Only a link</a></p></article>", before=MENU)) == "Only a link"
    assert main_text(page("", before=MENU, after=f"<footer>{WORDS}</footer>")) == ""


def test_awkward_rows(spark):
    long = "".join(f"<p>{WORDS} {i}</p>" for i in range(20_000))
    deep = "<div>" * 20_000 + WORDS + "</span>" * 20_000
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain text"), (3, "u", page(f"<article>{ARTICLE}</article>")), (3, "u", page(f"<article>{ARTICLE}</article>"))]
    rows += [(4, "u", f"<article>{long}</article>"), (5, "u", deep), (6, "u", "<!--" * 50_000), (7, "u", "<" * 50_000), (8, "u", " \n ")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = html_extract.extract(df).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[2]["text"] == by[8]["text"] == by[6]["text"] == "" and by[None]["text"] == "plain text"
    assert by[3]["text"] == TEXT and by[5]["text"] == WORDS and by[4]["text"].count("\n") == 19_999
    assert html_extract.extract(df.limit(0)).count() == 0
