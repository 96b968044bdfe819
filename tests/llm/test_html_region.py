"""Page extraction on pages with known main text."""

import html
import re

from pyspark.sql import functions as F

from tablemill.llm.html_region import best_region, events, fit_weights, labelled_pages, main_text, main_texts
from tablemill.llm.queries import table

WEIGHTS = fit_weights(labelled_pages())


def test_best_region():
    assert best_region([]) == (0, 0)
    assert best_region([-1, -2]) == (0, 0)
    assert best_region([1, -2, 3, -1, 3, -9, 4]) == (2, 5)


def test_labelled_pages_are_recovered():
    for page in labelled_pages():
        kept = re.search(r"<!--keep-->(.*)<!--/keep-->", page, re.S)[1]
        words = html.unescape(re.sub(r"<[^>]+>", " ", kept)).split()
        assert main_text(page, WEIGHTS).split() == words


def test_parts_that_are_no_main_text():
    page = """<html><head><title>no</title></head><body class="has-sidebar"><header>Site <b>name</b></header><div class="topMenu">a b c</div>
    <main><h1>Head &amp; tail</h1><p>First&nbsp;line<br>goes <i>o</i>n &lt;here&gt;</p><div class="advert">buy</div><script>var x = "<p>no</p>";</script>
    <form><p>name</p></form><p>Second.</p><style>p{}</style><ul><li>one<li>two</ul></main>
    <section id="comments"><article class="comment"><p>I like it a lot, it is very good indeed.</p></article></section>
    <div style="display: none">hidden</div><aside>side</aside><footer>foot</footer></body></html>"""
    assert main_text(page, WEIGHTS) == "Head & tail\n\nFirst line goes on <here>\n\nSecond.\n\none\n\ntwo"


def test_comments_alone_do_not_make_an_article():
    page = """<div><h1>Title</h1><p>The text of the page stands in a plain block.</p></div>
    <div id="comments"><article class="comment"><p>Nice.</p></article></div>"""
    assert main_text(page, WEIGHTS) == "Title\n\nThe text of the page stands in a plain block."


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "no tags at all"), (3, None, "no tags at all"), (4, "u", "<p>open <b>and never"),
            (5, "u", "<nav>only</nav>"), (None, "u", "1 < 2 and <unclosed"), (6, "u", "<p>" + "word " * 100_000), (7, "u", "<a '" * 2_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = main_texts(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == texts[2] == texts[5] == "" and texts[3] == "no tags at all" and texts[4] == "open and never"
    assert texts[None] == "1 < 2 and" and len(texts[6]) == 499_999
    assert main_texts(df.limit(0)).count() == 0


def test_pages_of_the_table(spark):
    for row in main_texts(table(spark, "/root/testdata/sf0.001", "pages")).join(
        table(spark, "/root/testdata/sf0.001", "pages").select("page_id", "html"), "page_id"
    ).collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", row.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", block)).split()) for block in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n\n".join(block for block in blocks if block)


def test_wrappers_named_after_other_parts():
    text = "The text of the page stands here and is long enough to be told from the rest of it."
    for name in ("has-sidebar", "no-comments", "with-banner", "post share-enabled", "related-posts-off", "sidebar layout"):
        page = f'<body><div id="page" class="{name}"><article><h1>Title</h1><p>{text}</p></article><div class="sidebar">no</div></div></body>'
        assert main_text(page, WEIGHTS) == f"Title\n\n{text}", name
    teasers = '<div class="related"><article><p>One more.</p></article><article><p>Another.</p></article></div>'
    assert main_text(f"<div><h1>Title</h1><p>{text}</p></div>{teasers}", WEIGHTS) == f"Title\n\n{text}"
    assert main_text(f"<main><h1>Title</h1><p>{text}</p></main>{teasers}", WEIGHTS) == f"Title\n\n{text}"


LONG = "The text of the page stands here and is long enough to be told from the rest of it."


def test_forms_around_the_page():
    page = f'<body><form id="all"><div><h1>Title</h1><p>{LONG}</p><p>Second one here.</p></div></form><form><p>name</p></form></body>'
    assert main_text(page, WEIGHTS) == f"Title\n\n{LONG}\n\nSecond one here."
    assert main_text(f"<form><p>Name and address.</p></form><p>{LONG}</p>", WEIGHTS) == LONG
    assert main_text(f"<form><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></form>", WEIGHTS) == "\n\n".join([LONG] * 3)


def test_hidden_is_an_attribute():
    assert main_text(f'<article><p title="the hidden gem of Rome">{LONG}</p></article>', WEIGHTS) == LONG
    for said in ("hidden", "HIDDEN=''", "aria-hidden='true'", 'style="color: red; display : none"'):
        assert main_text(f"<article><p>{LONG}</p><p {said}>not this</p></article>", WEIGHTS) == LONG, said


def test_names_of_content_that_hold_a_listed_word():
    for said in ("social-science", "related-work", "comment-on-method", "notice-of-birth", "search-theory"):
        assert main_text(f'<article><h1>T</h1><div class="{said}"><p>{LONG}</p></div></article>', WEIGHTS) == f"T\n\n{LONG}", said
    for said in ("related-posts", "social-share", "comment-list", "ad-slot", "js-newsletter", "nav-primary", "shareButtons", "discussion"):
        assert main_text(f'<article><p>{LONG}</p><div class="{said}"><p>Not this one.</p></div></article>', WEIGHTS) == LONG, said


def test_pages_without_article_and_without_telling_names():
    page = f"""<body><div class="a1">Home page of somebody</div><div class="a2"><a href="/">Index</a> and <a href="/b">more</a></div>
    <div class="a3"><h1>Title</h1><p>{LONG}</p><h2>Next</h2><ul><li>one<li>two</ul><p>{LONG}</p></div>
    <div class="a4">Most read</div><div id="left-rail"><p>Other things.</p></div><div class="a5">Copyright 2020</div></body>"""
    assert main_text(page, WEIGHTS) == f"Title\n\n{LONG}\n\nNext\n\none\n\ntwo\n\n{LONG}"


def test_scan_against_all_regions():
    page = f"""<body><div>Up <b>here</b></div><a href="x">go there</a><h1>One</h1><p>{LONG}</p><div>Some words</div>
    <p>{LONG}</p><ul><li><a href="y">follow</a></ul><div>The end</div></body>"""
    found = [event for event in events(page) if event[0] != "note"]
    scores = [
        WEIGHTS.get((kind, value), -0.001) if kind in ("tag", "other") else WEIGHTS.get((kind, ""), 0.0) * len(value.split())
        for kind, value in found
    ]
    start, end = best_region(scores)
    most = max(sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1))
    assert abs(sum(scores[start:end]) - most) < 1e-9
    assert min(scores) < -1 and {kind for kind, _ in found} >= {"short", "link", "head", "plain"}
