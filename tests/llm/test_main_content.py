from __future__ import annotations

import html
import re
import time

from tables import TINY

from rankscope.llm import main_content
from rankscope.llm.queries import main_text


def brute(page: str | None) -> str:
    found = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", found[1]) if found else []
    texts = (" ".join(html.unescape(re.sub("</?b>", "", p.replace("<br>", " "))).split()) for p in parts)
    return "\n\n".join(t for t in texts if t)


def test_query_equals_the_marked_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{TINY}/pages.parquet").collect()}
    rows = main_text(spark, TINY).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == brute(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


PAGE = """<html><head><title>no</title><script>var a = "<p>no</p>";</script><style>p{}</style></head>
<body><header><h2>Site name</h2></header><nav><ul><li><a href="/">Home</a><li><a href="/x">More</a></ul></nav>
<div class="cookie-notice">We use cookies on this site, as everybody does.</div>
<div id="content"><h1>A title &amp; more</h1><p>First paragraph with <em>some</em> words in&nbsp;it
and a line end.<p>Second one, with a <a href="/l">link</a> inside it. It is unclosed
<div class="ad">Buy this now, it is cheap and good.</div><p>Third &lt;paragraph&gt; of the text.</p></div>
<div class="comments"><p>Great article, thank you so much for it!</p></div>
<form><p>Send us your mail address now please</p></form><footer>Copyright of us</footer></body></html>"""


def test_a_page_without_marks(spark):
    assert main_content.extract_text(PAGE, {}) == (
        "A title & more\n\nFirst paragraph with some words in it and a line end.\n\n"
        "Second one, with a link inside it. It is unclosed\n\nThird <paragraph> of the text."
    )


def test_odd_rows(spark):
    rows = [(1, None, None, 1), (2, "u", "", 1), (2, "u", "", 1), (3, "u", "<", 1), (4, "u", "no tags at all", 1),
            (None, "u", "<p>" * 20_000 + "deep", 1), (5, "u", "<script>x", 1), (6, "u", "<article></article>", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = main_content.extract(pages, main_content.learn(pages)).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == len(rows)
    assert texts == {1: "", 2: "", 3: "<", 4: "no tags at all", None: "deep", 5: "", 6: ""}
    assert main_content.learn(pages.limit(0)) == {}
    assert main_content.extract(pages.limit(0), {}).count() == 0


def test_best_stretch_is_the_maximum():
    weights = {"p": 2.0, "div.x": -3.0}
    page = "<div class=x>a b</div><p>one two three</p><div class=x>c</div><p>four</p><div class=x>d e f</div><p>g</p>"
    assert main_content.extract_text(page, weights) == "one two three"


ARTICLE = "<h1>A title</h1><p>The first paragraph of the text has some words.</p><p>So has the second one here.</p>"
TEXT = "A title\n\nThe first paragraph of the text has some words.\n\nSo has the second one here."


def test_names_do_not_hide_a_whole_page():
    for page in (
        f'<body class="post no-sidebar">{ARTICLE}</body>',
        f'<html class="has-sidebar"><body id="popular">{ARTICLE}</body></html>',
        f'<body><article class="post comments-open">{ARTICLE}</article></body>',
        f'<body><main class="widget">{ARTICLE}</main></body>',
        f'<body><div class="related"><article>{ARTICLE}</article></div></body>',
        f'<body><div class="popular">{ARTICLE}</div></body>',
    ):
        assert main_content.extract_text(page, {}) == TEXT, page


def test_names_still_speak_against_a_block():
    for name in ("ad", "comments", "comments-area", "sidebar left", "cookie-notice", "site-header", "related_box"):
        page = f'<body>{ARTICLE}<div class="{name}"><p>Buy this now as it is cheap.</p></div></body>'
        assert main_content.extract_text(page, {}) == TEXT, name
    for name in ("no-sidebar", "comments-open", "side-effects-explained"):
        page = f'<body>{ARTICLE}<div class="{name}"><p>Third one.</p></div></body>'
        assert main_content.extract_text(page, {}) == f"{TEXT}\n\nThird one.", name


def test_learned_weights_outvote_names():
    page = f'<body>{ARTICLE}<div class="popular"><p>Third one.</p></div></body>'
    assert main_content.extract_text(page, {"-p": 3.0}) == f"{TEXT}\n\nThird one."
    assert main_content.extract_text(f'<body><div class="comments">{ARTICLE}</div></body>', {"-p": -3.0, "-h1": -3.0}) == ""


def test_a_form_around_the_page_does_not_empty_it():
    nav, foot = '<nav><a href="/">Home</a></nav>', "<footer>Copyright of us</footer>"
    comments = '<div class="comments"><p>Great article, thank you!</p></div>'
    for form in ('<form id="aspnetForm" action="/x">{}</form>', '<div role="form">{}</div>'):
        page = "<body>" + form.format(nav + ARTICLE + comments + foot) + "</body>"
        assert main_content.extract_text(page, {}) == TEXT, page
    page = f"<body>{ARTICLE}<form><p>Send us your mail address now please</p></form></body>"
    assert main_content.extract_text(page, {}) == TEXT


def test_a_box_inside_an_article_does_not_part_it():
    more = "<p>" + "The second half of this article goes on for a while. " * 4 + "</p>"
    page = f'<body>{ARTICLE}<div class="sidebar"><p>{"Other news of the day. " * 60}</p></div>{more}</body>'
    assert main_content.extract_text(page, {}) == TEXT + "\n\n" + " ".join(main_content.extract_text(more, {}).split())
    assert main_content.extract_text(page, {}).endswith("goes on for a while.")
    # a short line behind a long one is not worth it
    page = f'<body>{ARTICLE}<div class="comments"><p>{"I liked it. " * 20}</p></div><div>Made by us.</div></body>'
    assert main_content.extract_text(page, {}) == TEXT


def test_links_in_paragraphs_are_text():
    links = "".join(f'<a href="/{i}">name {i} of a page</a>, ' for i in range(20))
    listed = " ".join(f"name {i} of a page," for i in range(20))
    page = f"<body>{ARTICLE}<p>{links}</p>{ARTICLE}</body>"
    assert main_content.extract_text(page, {}) == f"{TEXT}\n\n{listed}\n\n{TEXT}"
    # blocks are whole where the stretch starts or ends beside a link
    page = '<body><nav>Home</nav><p><a href="/a">The first link</a> is here and the last is <a href="/b">at its end</a></p></body>'
    assert main_content.extract_text(page, {}) == "The first link is here and the last is at its end"


def test_long_and_broken_pages_take_linear_time():
    n = 150_000
    pages = {
        "<p " * n: "", '<p "' * n: None, "</ " * n: "", "<!" * n: "", "<script " * n: "", "<!-- " * n: "",
        "<div>" * n + "text here" + "</p>" * n: "text here", "<header>" * n: "", "<b hidden>" * n + "</i>" * n: "",
        "<p>a few words</p>" * n: "\n\n".join(["a few words"] * n),
    }
    start = time.perf_counter()
    for page, text in pages.items():
        got = main_content.extract_text(page, {})
        assert text is None or got == text, page[:20]
    assert time.perf_counter() - start < 60
    assert main_content.extract_text('<p title="5" tall">one two three</p> <p>four', {}) == "one two three\n\nfour"


def test_weights_count_equal_pages_once_and_shuffle_no_page(spark):
    pages = spark.read.parquet(f"{TINY}/pages.parquet")
    hot = pages.unionByName(pages.limit(1).crossJoin(spark.range(200)).drop("id")).repartition(5)
    assert main_content.learn(hot) == main_content.learn(pages)
    few = main_content.learn(hot, most_pages=3)
    assert few and few == main_content.learn(pages, most_pages=3)


def test_clashing_columns(spark):
    rows = [(1, "u", ARTICLE, "x", 5, 6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int, hash int")
    assert [tuple(r) for r in main_content.extract(pages, main_content.learn(pages)).collect()] == [(1, "u", TEXT, len(TEXT))]
