"""op1: pages with known main text, broken markup, odd rows."""

import html
import re

import pytest

from quarry.llm import html_extract as H

from ..conftest import SF01

PARAGRAPHS = ["First paragraph with enough words to be the text of an article, truly.",
              "Second &amp; last paragraph, <em>with</em> some <a href='/x'>linked words</a> inside it, and an end."]
TEXT = "A Title First paragraph with enough words to be the text of an article, truly. " \
       "Second & last paragraph, with some linked words inside it, and an end."
BODY = "<h1>A Title</h1><p>" + "</p><p>".join(PARAGRAPHS) + "</p>"
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(8)) + "</ul>"

PAGES = {
    "plain article": f"<body><nav>{MENU}</nav><article>{BODY}</article><footer>(c) someone, all rights</footer></body>",
    "nested blocks": f"<body><div class='site-header'>Site name</div><div id=main><div class='post-content'>{BODY}</div>"
                     f"<div class='sidebar'>{MENU}</div></div><div id='footer'>about us</div></body>",
    "header in article": "<header>Site</header><main><article><header><h1>A Title</h1></header>"
                         + BODY.removeprefix("<h1>A Title</h1>") + "</article></main>",
    "clutter inside": "<body><article>" + BODY.replace("</p><p>", "</p><aside>Read also: other things</aside><div class='ad-box'>"
                      "Buy now</div><form><label>Mail</label><input><button>Send</button></form><script>var a='<p>no</p>';</script>"
                      "<style>p{}</style><!-- <p>note</p> --><div role='complementary'>x</div><p>") + "</article></body>",
    "reader comments": f"<body><article>{BODY}<section id='comments'><ol class='comment-list'><li>A long comment of a reader, who "
                       "writes far more words than the whole article has, on and on, with no link and no end, as readers "
                       "do, in several sentences. And more. And more of it.</li></ol></section></article></body>",
    "cookie notice": f"<div class='cookie-notice'>We use cookies, many of them, and ask you to agree to it.</div>{MENU}"
                     f"<article>{BODY}</article>",
    "unclosed": "<html><body><nav>" + MENU + "</nav><article><h1>A Title</h1><p><b>" + "<br><p>".join(PARAGRAPHS),
    "upper case": f"<BODY><NAV>{MENU}</NAV><ARTICLE>{BODY}</ARTICLE><FOOTER>end</FOOTER></BODY>",
    "hidden": f"<article>{BODY}<div hidden>secret</div><p style='display: none'>gone</p></article>",
    "no body tag": f"<article>\n{BODY}\n</article>",
    "cut tag": f"<article>{BODY}<p",
    "stray closing tags": f"</div></p><article>{BODY}</span></article></article>",
}


@pytest.mark.parametrize("name", PAGES)
def test_known_pages(name):
    assert H.extract(PAGES[name]) == TEXT


WRAPPED = [f"<body><div class='{c}'>{BODY}<div class='related'>{MENU}</div></div><div id='footer'>about us</div></body>"
           for c in ("wy-grid-for-nav", "no-sidebar", "has-sidebar", "page-with-sidebar", "content-with-sidebar", "post popular",
                     "popular", "widget")] + [
    f"<body><form action='/x'><div class='search'>find <input></div><div>{BODY}</div><select><option>no</select></form></body>",
    f"<body><div class='widget'><form><div class='popular'><article>{BODY}</article></div></form></div><div>one more line</div></body>",
    f"<body><main><h1>A Title</h1><div class='popular'>{BODY.removeprefix('<h1>A Title</h1>')}</div></main></body>",
    f"<body><div class='post popular'>{BODY}</div><div id='comments'><p>{'Far more words of a reader. ' * 30}</p></div></body>"]


@pytest.mark.parametrize("page", WRAPPED)
def test_wrappers_named_like_boilerplate(page):
    assert H.extract(page) == TEXT


def test_several_doubted_parts_and_many_levels():
    parts = "".join(f"<div class='popular'><p>Part {i} has some words of its own.</p></div>" for i in range(3))
    assert H.extract(f"<body>{parts}</body>").count("words") == 3
    assert H.extract("<div class='popular'>" * 20_000 + "some text here") == "some text here"


def test_blocks_and_white_space():
    page = "<article><h1> A\n\tB </h1>x<br>y<p>c&nbsp;d&#x27;e</p>tail <b>bold</b>er</article>"
    assert H.extract(page) == "A B x y c d'e tail bolder"


@pytest.mark.parametrize("page", [None, "", "   ", "<html></html>", "<body><nav>only a menu</nav></body>", "<!-- x", "<", "<p"])
def test_pages_without_text(page):
    assert H.extract(page) in ("", "<")


def test_deep_and_long_pages():
    assert H.extract("<div>" * 30_000 + "some text here") == "some text here"
    assert H.extract("<article>" + "<p>word word</p>" * 30_000 + "</article>").count("word") == 60_000
    assert H.extract("<article><p>x" + "<" * 50_000).startswith("x")
    assert H.extract("<p " + "a='" * 20_000) is not None


def test_query_on_given_pages(spark):
    """The tables' articles, read by a plain pattern that knows their template."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    for r in H.op1_html(spark, SF01).collect():
        inner = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(</article>|<footer>|\Z)", pages[r.page_id], re.S)[1])
        blocks = (html.unescape(re.sub(r"<[^>]+>", " ", re.sub("</?b>", "", b))) for b in re.split("</?(?:h1|p)>", inner))
        assert r.text == " ".join(x for b in blocks if (x := " ".join(b.split())))
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    data = [(1, None, None), (1, None, None), (None, "u", "<p>some words</p>"), (3, "u", "")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as _a0")
    got = H.main_text(df)
    assert got.columns == ["page_id", "url", "html", "_a0", "text"]
    assert sorted(r.text for r in got.collect()) == ["", "", "", "some words"]
    assert H.main_text(df.limit(0)).collect() == []


P = "A paragraph of some length that says a thing or two about what happened, and then goes on."


def paragraphs(n):
    return f"<p>{P}</p>" * n


PARTED = {  # articles in several parts, and how many paragraphs they have
    "two divs": (f"<body><div>{paragraphs(3)}</div><div>{paragraphs(2)}</div></body>", 5),
    "links between": (f"<body><div><div>{paragraphs(3)}</div><div><a href=x>more</a> <a href=y>less</a></div>"
                      f"<div>{paragraphs(2)}</div></div></body>", 5),
    "uneven sections": (f"<body><section>{paragraphs(1)}</section><section>{paragraphs(4)}</section>"
                        "<section><p>A paragraph of half.</p></section></body>", 6),
    "lead": (f"<body><div>A paragraph as short lead.</div><div>{paragraphs(4)}</div></body>", 5),
    "last paragraph": (f"<body><div>{paragraphs(4)}</div><p>A paragraph at last.</p></body>", 5),
    "sibling articles": (f"<body><article>{paragraphs(4)}</article><article>{paragraphs(2)}</article></body>", 6),
    "unnamed frame": (f"<body><div>Site name</div><div><a href=/>Home</a> | <a href=/a>About</a></div><div>{paragraphs(3)}</div>"
                      "<div>Copyright 2020 more of us</div></body>", 3),
}


@pytest.mark.parametrize("name", PARTED)
def test_all_parts_of_an_article_stay(name):
    page, n = PARTED[name]
    text = H.extract(page)
    assert text.count("A paragraph") == n
    assert not any(w in text for w in ("more", "Site", "Home", "|"))


READER = "<p>I like readers' words a lot, and I write many of them here, more than the article has. Truly. And more of it.</p>"
COMMENTS = {
    "article": f"<article class='comment'>{READER}</article>",
    "commentlist": f"<div class='commentlist'>{READER}</div>",
    "reviews": f"<div class='user-reviews'>{READER}</div>",
    "discussion": f"<div id='discussion'>{READER}</div>",
    "signed parts": "<div>" + f"<div><span class='author'>Ann</span> <time>today</time>{READER}</div>" * 3 + "</div>",
    "signed list": "<section><h3>What you say</h3><ol>" + f"<li><b class='user'>Ann</b>{READER}</li>" * 2 + "</ol></section>",
}


@pytest.mark.parametrize("name", COMMENTS)
def test_readers_stay_out(name):
    for page in (f"<body><main><h1>Title</h1>{paragraphs(5)}{COMMENTS[name]}</main></body>",
                 f"<body><article>{paragraphs(5)}</article>{COMMENTS[name]}</body>",
                 f"<body><div><div>{paragraphs(5)}</div>{COMMENTS[name]}</div></body>",
                 f"<body><article>{paragraphs(5)}{COMMENTS[name]}</article></body>"):
        text = H.extract(page)
        assert "readers" not in text and text.count("A paragraph") == 5


def test_an_articles_own_discussion_stays():
    page = (f"<article><h1>T</h1><section id='methods'><h2>Methods</h2>{paragraphs(2)}</section>"
            f"<section id='discussion'><h2>Discussion</h2>{paragraphs(2)}</section></article>")
    assert H.extract(page).count("A paragraph") == 4


def test_given_pages_without_article_tags(spark):
    for r in spark.read.parquet(f"{SF01}/pages.parquet").collect():
        assert H.extract(re.sub(r"(</?)article\b", r"\1div", r.html)) == H.extract(r.html)


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</b>" * 100_000, "<b>" * 50_000 + "<p>x</p>" * 50_000,
                                  "<li><ul>" + "<b>" * 30_000 + "<li>x</li>" * 30_000,
                                  "<div>" * 8_000 + "<p>Some words of text.</p>" * 8_000, "<p>x" * 100_000])
def test_time_is_linear(page):
    import time

    start = time.process_time()
    H.extract(page)
    assert time.process_time() - start < 6  # a walk over the depth for each tag takes minutes
