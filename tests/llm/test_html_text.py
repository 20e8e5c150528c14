"""Main texts: pages made around known articles, broken pages, and the given pages by a plain rule."""

from __future__ import annotations

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from fillscope.llm.html_text import extract, main_text
from fillscope.llm.queries import QUERIES

PROSE = [
    "The river, which had been low all summer, rose within a day and took the lower bridge with it.",
    "Nobody in the village was surprised; the older people, at least, had seen it before.",
    "Short one.",
    "5 < 6 & 7 > 3, said the \"teacher\", and that was that for the rest of the lesson, more or less.",
    "Äpfel, Birnen und Nüsse – alles wurde teurer, sagte die Händlerin, und zuckte mit den Schultern.",
]
TITLE = "A flood & its bridge"
MENU = "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
JUNK = [
    MENU,
    "<header><h2>The Daily Paper</h2><p>Monday, late edition, all the news, every day, for everyone</p></header>",
    "<div class='menu'><a href=/x>One</a> <a href=/y>Two</a></div>",
    "<aside><p>Also of interest, dear reader, are these stories, which we picked, by hand, for you.</p></aside>",
    "<div id='sidebar-left'><p>Weather, traffic, and all you need, every hour, around the clock, for free.</p></div>",
    "<div class='cookie-notice'>We use cookies, and others do, too. <button>Accept all</button></div>",
    "<div class=ad>Buy now, pay later, no questions asked, ever, by anyone.</div>",
    "<form action='/s'><label>Search</label><input name=q><select><option>All<option>New</select></form>",
    "<script>document.write('<p>no, no, no</p>')</script><style>p > a {color: red}</style>",
    "<section id=comments><h3>2 comments</h3><article class='comment'><p>First, of course, as always, I win!</p></article>"
    "<div class='comment-body'><p>I disagree, strongly, with each and every word, of this piece.</p></div></section>",
    "<footer><p>&copy; 2020 The Daily Paper, all rights reserved, worldwide</p></footer>",
    "<div class='share-buttons'><a href=#>Tweet</a></div><!-- <p>not this</p> -->",
    "<div style='display: none'>hidden, hidden, hidden</div><div hidden>gone, too</div><noscript>Please, enable it</noscript>",
    "<div role=navigation>You are here</div><iframe src=x>old browser</iframe><textarea>write here</textarea>",
]
WRAPS = [
    "<article><h1>{title}</h1>{body}</article>",
    "<main><article class='post ad-free'><header><h1>{title}</h1><p>By A. Writer</p></header><div class='entry-content'>{body}</div></article></main>",
    "<div class='page has-sidebar'><main id=main><h1>{title}</h1><div><div>{body}</div></div></main></div>",
    "<div id='content'><h1>{title}</h1>{body}</div>",
    "<div class='wrap'><h1>{title}</h1><div class='article-body'>{body}</div></div>",
]


def paragraphs(texts, draw):
    out = []
    for i, text in enumerate(texts):
        text = html.escape(text)
        kind = draw.randrange(6)
        words = text.split(" ")
        if kind == 0 and len(words) > 3:
            words[1] = f"<a href='/w{i}'>{words[1]}</a>"
        if kind == 1:
            words[0] = f"<b>{words[0]}</b>"
        spaced = draw.choice([" ", "\n   ", "&nbsp;", "\t"]).join(words) if kind != 2 else "<br/>".join(words)
        out.append(f"<p class=x>{spaced}" + draw.choice(["</p>", "", "\n</p>\n"]))
    return "".join(out)


@pytest.mark.parametrize("seed", range(40))
def test_article_without_the_rest(seed):
    draw = random.Random(seed)
    texts = [draw.choice(PROSE) for _ in range(draw.randrange(2, 9))] + [PROSE[0]]
    before, after = draw.sample(JUNK, 4), draw.sample(JUNK, 5)
    wrap = WRAPS[seed % len(WRAPS)]
    article = wrap.format(title=html.escape(TITLE), body=paragraphs(texts, draw))
    page = f"<!DOCTYPE html><html><head><title>x, y, z</title></head><body class='has-sidebar no-ads'>{''.join(before)}{article}{''.join(after)}"
    page += draw.choice(["</body></html>", "", "<p", "</bo", "<!-- cut", "<div class='ad"])
    assert main_text(page) == "\n".join([TITLE, *texts])


def test_blocks_inside_the_article():
    body = (
        "<article><h1>T</h1>lead, not in a paragraph<p>one</p><ul><li>a, b<ul><li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><th>3</table>"
        "<pre>x\n  y</pre><blockquote>q<p>r</blockquote><figure><img alt=z><figcaption>cap</figcaption></figure><dl><dt>k<dd>v</dl>"
        "<aside>no</aside><div class=related><p>no, no, no</p></div><ul><li><a>l1</a><li><a>l2</a><li><a>l3</a></ul><footer>no</footer></article>"
    )
    expected = ["T", "lead, not in a paragraph", "one", "a, b", "c", "d", "1", "2", "3", "x y", "q", "r", "cap", "k", "v"]
    assert main_text(body).split("\n") == expected


def test_references_and_broken_html():
    assert main_text("<article><p>&lt;b&gt; &amp;amp; &#65;&#x42; &eacute; &nosuch; &am</article>") == "<b> &amp; AB é &nosuch; &am"
    assert main_text("<article><p>a &am") == "a &am"
    assert main_text("<article><p>1 < 2 <3</p></b></i></article>") == "1 < 2 <3"
    assert main_text("<article><p title='it>s' lang=it's>x</p><a href=\"u>v\">w</a><br>z</article>") == "x\nw z"
    assert main_text("<p>a<b>b<p>c</b>d</p>e") == "ab\ncd\ne"
    assert main_text("plain text, no tags") == "plain text, no tags"
    for nothing in (None, "", "   ", "<", "</", "<!--", "<p", "<script>x", "<html><body></body></html>"):
        assert main_text(nothing) in ("", "<", "</")
    assert main_text("<div class=ad>only, an, advert</div><article><h1></h1><p> </p></article>") == ""


def test_long_and_deep_pages():
    deep = "<div>" * 20000 + "<p>core, of it all, at last</p>" + "</div>" * 20000
    assert main_text(deep) == "core, of it all, at last"
    words = "word, " * 200_000
    assert main_text(f"<nav>menu</nav><article><p>{words}</p><p>{words}</p></article>") == f"{words.strip()}\n{words.strip()}"
    assert main_text("<p>" + "<b>x</i>" * 20000) == "x" * 20000
    assert main_text("<a href='" * 20000) == ""


def test_extra_columns_null_and_repeated_rows(spark):
    rows = [(1, "u", "<p>a, b</p>", "old", 7), (1, "u", "<p>a, b</p>", "old", 7), (None, None, None, "old", 8), (2, "v", "", None, 9)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = extract(frame).select("page_id", "url", "text", "n_chars").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, "u", "a, b", 7), (1, "u", "a, b", 7), (None, None, "", 8), (2, "v", "", 9)], key=repr)
    assert extract(frame.limit(0)).count() == 0


def test_given_pages(spark, folder):
    """The given pages have one article between fixed marks: blocks are what lies between their block tags."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op12_html_text"](spark, folder)
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.count() == len(pages)
    assert found.where(F.col("n_chars") != F.char_length("text")).count() == 0
    for row in found.collect():
        page = pages[row.page_id]
        inside = re.split("</article>", re.split("<article>", page.html or "")[1])[0] if "<article>" in (page.html or "") else ""
        inside = re.sub(r"<[^>]*$", "", inside)
        blocks = [html.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", b))) for b in re.split("</?(?:p|h1)>", inside)]
        expected = [" ".join(re.split(r"\s+", b)).strip() for b in blocks]
        assert row.url == page.url and row.text == "\n".join(b for b in expected if b)
