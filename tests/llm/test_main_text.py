"""Main texts of pages: layouts with a known article, the given pages, odd markup."""

import html
import re
import time

import pytest

from vitrina.llm import main_text
from vitrina.llm.registry import LLM_QUERIES

SF = "/root/testdata/sf0.001"

A="The river rose over night and the lower streets were closed. People moved their cars to the hill."
B="By noon the water had gone down again, and the mayor thanked all who had helped."
C="Ok."
PAGES=[
# blog without article, comments, sidebar
(f'''<html><head><title>T</title></head><body><div id="header"><h1><a href="/">My Blog</a></h1><p>Just another blog about things and more things to read</p></div>
<ul class="menu"><li><a href=1>Home</a><li><a href=2>About</a></ul>
<div id="wrapper"><div id="content"><h2>Flood</h2><p>{A}</p><div class="advert">Buy our boots today, they are the very best boots of all the boots in the world and cheap too, you know, come and see</div><p>{B}</p><p>{C}</p></div>
<div class="sidebar"><h3>Recent</h3><ul><li><a>Post one</a></li><li><a>Post two</a></li></ul><p>About me: I write about things that I like and that you may like too.</p></div></div>
<div class="comments"><h3>Comments</h3><div class="comment"><p>Great post, I really liked it a lot, thanks for writing it. I was there too and saw everything that you say.</p></div></div>
<div id="footer">Copyright 2020 by me, all rights reserved to me</div></body></html>''',["Flood",A,B,C]),
# main with article, header, aside inside
(f'''<body><header><nav><a>x</a></nav></header><main><article><header><h1>Flood</h1></header><p>{A}<aside>Read also: <a>other story about cats</a></aside><p>{B}<section id="comments"><article class="comment"><p>I was there and I saw all of that with my own eyes, really.</p></article></section></article></main><footer>c</footer>''',["Flood",A,B]),
# plain body paragraphs only
(f"<p>{A}<p>{B}",[A,B]),
(f"{A}",[A]),
("<nav><a>one</a></nav><footer>x y z</footer>",[]),
# table layout
(f'''<table><tr><td><ul><li><a>Home</a></li><li><a>News</a></li></ul></td><td><h1>Flood</h1><p>{A}</p><p>{B}</p></td></tr></table>''',["Flood",A,B]),
# unknown classes, cookie notice and newsletter form
(f'''<div class="css-1x2y"><div class="cookie-banner"><p>We use cookies to make this site better for all. Do you accept them all or not?</p><button>Accept</button></div><div class="css-99"><h1>Flood</h1><p>{A}</p><form action=x><p>Sign up for our weekly letter with the best of the week</p><input><button>Go</button></form><p>{B}</p></div></div><div class="css-foot"><ul><li><a>Terms</a></li><li><a>Privacy</a></li></ul></div>''',["Flood",A,B]),
# inline markup, entities, lists
(f'''<ARTICLE CLASS=post><H1>Fl&ouml;od &amp; more</H1><P>One <b>t</b>wo<br>three&nbsp;four <a href="x">five</a>.</P><UL><LI>first item<LI>second item</UL><blockquote>{A}</blockquote><script>x</script></ARTICLE><div class=share><a>Share</a></div>''',["Flöod & more","One two three four five.","first item","second item",A]),
# div text with role and ids
(f'''<div role="navigation"><a>a</a> <a>b</a></div><div role="main"><h1>Flood</h1><div class="text"><div>{A}</div><div>{B}</div></div></div><div role="complementary"><p>{A}</p></div>''',["Flood",A,B]),
(f'''<div class="page"><div class="post"><h1>Flood</h1><div class="entry-content"><p>{A}</p><div class="ad-slot"><p>Buy boots now</p></div><p>{B}</p><ul><li><a href=1>A source</a> for this story</li></ul></div></div><div id="respond"><form><p>Leave a reply to this</p></form></div><ol class="commentlist"><li><p>I do not think so, this is all very wrong and I can prove it.</p></li></ol></div>''',["Flood",A,B,"A source for this story"]),

(f"""<nav><a>x</a></nav><article><h1>T</h1><p>{A}</p><p>{B}</p><ul class="related">"""+"<li><a>w w</a></li>"*60+f"""</ul><p>{C}</p></article><p class=legal>l</p>""",["T",A,B,C]),
(f"""<div id=main><p>{A}</p><div hidden><p>{B}</p></div><div style="display: none">{B}</div><p class="post tag-search category-legal">{B}</p></div>""",[A,B]),
]


@pytest.fixture(scope="module")
def model():
    return main_text.default_model()


@pytest.mark.parametrize("number", range(len(PAGES)))
def test_layouts(model, number):
    source, blocks = PAGES[number]
    assert main_text.extract_text(source, model) == "\n\n".join(blocks)


def plain_article(source):
    """The given pages keep their text in one article of headings and paragraphs."""
    inside = re.search(r"<article>(.*)</article>", source, re.S)[1].replace("<br>", " ")
    blocks = (re.sub(r"<[^>]*>", "", block) for block in re.split(r"</?(?:p|h1)>", inside))
    texts = (" ".join(html.unescape(block).split()) for block in blocks)
    return "\n\n".join(text for text in texts if text)


def test_query_on_all_given_pages(spark):
    pages = {row.page_id: row for row in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = LLM_QUERIES["op13_main_text"](spark, SF).collect()
    assert len(found) == len(pages)
    for row in found:
        assert row.text == plain_article(pages[row.page_id].html)
        assert (row.url, row.n_chars) == (pages[row.page_id].url, len(row.text))


ODD = [
    (1, None, ""), (2, "", ""), (3, " \n ", ""), (4, "just words", "just words"),
    (5, "<p>one two three<p>four five six", "one two three\n\nfour five six"),
    (6, "<p>a &lt;b&gt; &amp;amp; &nosuch; &#233; c</p>", "a <b> &amp; &nosuch; \u00e9 c"),
    (7, "<p>kept words here</p><script>if (a<b) { lost", "kept words here"),
    (8, "<p>kept words here</p><!-- lost <p>lost</p>", "kept words here"),
    (9, "<p>1 < 2 and a<b are true words</p>", "1 < 2 and a<b are true words"),
    (10, "<P CLASS='x>y'>Upper case &NBSP; tags</P>", "Upper case &NBSP; tags"),
    (4, "just words", "just words"), (None, "<h1>no id at all</h1>", "no id at all"),
]


def test_odd_pages(spark):
    frame = spark.createDataFrame([row[:2] for row in ODD], "page_id long, html string")
    frame = frame.selectExpr("*", "'r' AS row", "'s' AS source", "'t' AS text")
    found = main_text.extract(frame).selectExpr("row.page_id", "row.html", "text", "row.text AS own").collect()
    assert sorted(((row.page_id, row.html, row.text) for row in found), key=str) == sorted(ODD, key=str)
    assert {row.own for row in found} == {"t"}
    assert main_text.extract(frame.limit(0)).collect() == []


@pytest.mark.parametrize(
    "source",
    ["<a <a " * 100_000, '<a ="' * 100_000, "<div>" * 50_000 + "x", "<!--" * 100_000, "<p><b>x" * 30_000,
     "&amp" * 100_000, "<ul><li>" * 30_000, "</x>" * 100_000],
)
def test_time_grows_with_length_only(model, source):
    began = time.time()
    main_text.extract_text(source, model)
    assert time.time() - began < 20


def test_best_run():
    assert main_text.best_run([-1, 2, -1, 3, -5, 4]) == (1, 4)
    assert main_text.best_run([1, -1, 1]) == (0, 1)
    assert main_text.best_run([-1, -2]) == (0, 0)
    assert main_text.best_run([]) == (0, 0)


def test_scores_of_words_and_tags(model):
    assert all(score < 0 for score in model.tags.values())
    page = main_text.Page("<p>w w</p><nav><a>w</a></nav>", model.weights, model.frames)
    inside, outside = page.block_scores(model.bias)
    assert inside > 0.5 and outside == 0


def test_learns_from_other_labelled_pages():
    parts = [("<div id=x>w w w</div>", 1), ("<div id=y>w w w</div>", 0)] * 4
    model = main_text.train(parts, steps=300)
    assert main_text.extract_text("<div id=y>no no</div><div id=x>yes yes yes</div>", model) == "yes yes yes"
