import html
import re

import pytest

from feedlake.llm import lineblocks
from tests.conftest import SF

PARAGRAPHS = [f"Paragraph {k} of the article tells something new in quite a few words." for k in range(5)]
ARTICLE = "<article><h1>Title</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS) + "</article>"
TEXT = "\n".join(["Title", *PARAGRAPHS])
LONG = "This is not the article, although it is a long and rather wordy piece of text as well, longer than each paragraph."


def page(before="", after="", article=ARTICLE):
    return f"<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{{}}</style></head><body class='has-sidebar'>{before}{article}{after}</body></html>"


OTHERS = [
    f"<nav><ul><li><a href='/x'>{LONG}</a></li></ul></nav>",
    f"<header><p>{LONG}</p></header>",
    f"<footer>{LONG}</footer>",
    f"<aside><p>{LONG}</p></aside>",
    f"<div class='sidebar'><p>{LONG}</p></div>",
    f"<div id=cookie-notice>{LONG}</div>",
    f"<div class=\"ad\">{LONG}</div>",
    f"<form action='/'><p>{LONG}</p><input value='a'></form>",
    f"<script>var t = '</p>{LONG}';</script>",
    f"<style>{LONG}</style>",
    f"<!-- {LONG} <p> -->",
    f"<section class='comments'><div><p>{LONG}</p><p>{LONG}</p></div></section>",
    f"<div id='comments'><h2>Comments</h2><div class='comment'><p>{LONG}</p></div></div>",
    f"<p class='advert'>{LONG}</p>",
    f"<article class='comment'><p>{LONG}</p></article>",
    f"<ul class='site-menu'><li>{LONG}</li></ul>",
    f"<div hidden>{LONG}</div><div style='display: none'><p>{LONG}</p></div>",
]


@pytest.mark.parametrize("other", OTHERS)
def test_other_parts_go(other):
    assert lineblocks.main_text(page(before=other)) == TEXT
    assert lineblocks.main_text(page(after=other)) == TEXT
    inside = ARTICLE.replace("</h1>", "</h1>" + other)
    assert lineblocks.main_text(page(article=inside)) == TEXT


@pytest.mark.parametrize("holder", ["main", "div", "section", "td"])
def test_without_an_article_element(holder):
    body = f"<{holder}>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS) + f"</{holder}>"
    assert lineblocks.main_text(page("<div class=menu><a href=a>Home</a> <a href=b>News</a></div>", article=body)) == "\n".join(PARAGRAPHS)


@pytest.mark.parametrize("around", ["<div>{}</div>", "<div class=page><div><div>{}</div></div></div>", "{}"])
def test_sections_that_end_in_short_blocks(around):
    section = "<div><section><h2>Head {0}</h2><p>{1} {0}</p><p>{1}</p><ul><li>a{0}</li><li>b{0}</li><li>c{0}</li><li>d{0}</li></ul></section></div>"
    body = around.format("".join(section.format(k, LONG) for k in range(4)))
    lines = [line for k in range(4) for line in (f"Head {k}", f"{LONG} {k}", LONG, f"a{k}", f"b{k}", f"c{k}", f"d{k}")]
    menu = "<div><ul>" + "".join(f"<li><a href='/{k}'>{LONG}</a></li>" for k in range(6)) + "</ul></div>"
    assert lineblocks.main_text(page(menu, menu, body)) == "\n".join(lines)


def test_text_between_surge_and_dive_without_any_holder():
    links = "".join(f"<p><a href='/{k}'>Link {k}</a></p>" for k in range(8))
    body = links + "".join(f"<p>{p}</p>" for p in PARAGRAPHS) + links
    assert lineblocks.main_text(page(article=body)) == "\n".join(PARAGRAPHS)


def test_paragraphs_of_very_different_length():
    parts = ["a" * 20_000, "short one", *PARAGRAPHS]
    body = "<div class='with-sidebar'>" + "".join(f"<div>{p}</div>" for p in parts) + "</div>"
    assert lineblocks.main_text(page(OTHERS[0], article=body)) == "\n".join(parts)


@pytest.mark.parametrize("part", [
    "<video-js id=v></video-js>", "<audio-player>", "<svg-icon></svg-icon>", "<title-card>", "<button-group>", "<select-box/>",
    "<svg viewBox='0 0 1 1'/>", "<math/>", "<div><button>Share</div>", "<div><div><object><p>old</div></div>", "<p><button>Menu</p>",
    "<svg><svg><path/></svg>old</svg>", "<noscript><p>old</p></noscript>", "<video><source src=a><p>old</p></video >", "<iframe src='a>b'></iframe>",
])
def test_embedded_elements_do_not_swallow_the_page(part):
    inside = ARTICLE.replace("</h1>", "</h1>" + part)
    assert lineblocks.main_text(page(part, article=inside)) == TEXT


def test_embedded_elements_break_no_line():
    article = "<article><p>one <video><p>old</p></video>two <select><option>a<option>b</select>three <svg><div>x</div></svg>four</p><p><button>go</p><p>five</p></article>"
    assert lineblocks.main_text(page(article=article)) == "one two three four\nfive"
    for name in ("script", "style", "textarea", "title"):
        assert lineblocks.main_text(page(article=f"{ARTICLE}<{name}><p>{LONG}")) == TEXT


def test_stretches():
    found = lineblocks.stretches([0, 0, 0, 0, 90, 80, 90, 0, 0, 0, 0])
    assert found == [(3, 8)]
    assert lineblocks.stretches([]) == [] and lineblocks.stretches([0, 0]) == []


def test_short_blocks_entities_and_blanks():
    article = "<article><h1>A &lt; B</h1><p>x</p><p>one&nbsp;two\n\t three<br>four &#233;&eacute;</p><p> </p><p>in<b>side</b> <i>w</i>ord</p></article>"
    assert lineblocks.main_text(page(article=article)) == "A < B\nx\none two three four éé\ninside word"


def test_broken_markup():
    cut = page("<div class='ad'>Short ad.</div>", "<footer>foot</footer>", "<article><h1>T</h1><p><b>Bold text that is not closed.<br><p>Next one.</article>")
    assert lineblocks.main_text(cut.removesuffix("</body></html>")) == "T\nBold text that is not closed.\nNext one."
    for bad in ("", "<", "<p", "</p></div>", "a < b > c", "<!--", "<script>", "<p class='x>text"):
        assert isinstance(lineblocks.main_text(bad), str)
    assert lineblocks.main_text("just text") == "just text"
    assert lineblocks.main_text(page(article="<article></article>")) == ""


def test_given_pages(spark):
    """The article element of the given pages, read by another way."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r["page_id"]: r for r in lineblocks.extracted(pages).collect()}
    for row in pages.collect():
        inside = re.search("<article>(.*?)</article>", row["html"], re.S).group(1)
        parts = re.split("</?(?:p|h1)>", re.sub("</?b>", "", inside).replace("<br>", " "))
        text = "\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)
        assert found[row["page_id"]]["text"] == text
        assert (found[row["page_id"]]["url"], found[row["page_id"]]["n_chars"]) == (row["url"], len(text))


def test_odd_rows(spark):
    rows = [(1, "u", None, "a"), (2, None, "", "b"), (None, None, ARTICLE, "c"), (3, "v", ARTICLE, "d"), (3, "v", ARTICLE, "d"), (4, "w", "<p>" * 5000 + LONG, None), (5, "x", "<div>" * 3000 + LONG * 300, "e")]
    found = lineblocks.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(((r["page_id"] or 0, r["text"]) for r in found)) == sorted([(1, ""), (2, ""), (0, TEXT), (3, TEXT), (3, TEXT), (4, LONG), (5, LONG * 300)])
    assert lineblocks.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
