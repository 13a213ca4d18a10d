import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from applens.llm import html_extract as he

SCHEMA = "page_id long, url string, html string, text string, host string, token string"

CASES = [
    ("<p>a<b>b</b> c<br>d<p>e", "ab c d\ne"),
    ('<div class="ad">x</div><p>y</p>', "y"),
    ("<nav><ul><li>m<article><p>t</article>", "t"),
    ('<body class="has-sidebar"><main><header><h1>T</h1></header><aside>s</aside><p>p &lt;q&gt; &nbsp; z &#233;</p>'
     '<section class="comments"><article class="comment"><p>c</p></article></section><form>f<input>g</form></main><footer>f',
     "T\np <q> z é"),
    ('<script>var t="</p>";a<b</script>x', "x"),
    ("a < b & c", "a < b & c"),
    ('<p title="a>b">q</p><p class=\'x>t</p>', "q\nt"),
    ('<article>keep <span class="share">drop</span> on<script>x</script>!</article>', "keep on!"),
    ("<article><!-- c --><p>x<!-- <p> -->y</p><style>p{}</style></article><p>outside", "xy"),
    ("", ""),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ('<div id="cookie-notice">we use</div><div><h1>H</h1><p>T</p></div>', "H\nT"),
    ("<!DOCTYPE html><html><head><title>no</title></head><body><header>no</header><div role=navigation>no</div><p>yes", "yes"),
    ("<ARTICLE><P>Up &AMP; down</P></ARTICLE>", "Up & down"),
    ("<article><p>cut off <b", "cut off"),
]


@pytest.mark.parametrize("html,want", CASES)
def test_one_page(html, want):
    assert he.remaining_text(he.parse(html), set()) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<nav>", "</nav>", "<a href='", "\"", ">", "<", "text", " & ", "&amp", "<!--", "-->",
                                 "<script>", "</script>", "<br/>", "</", "<!x", "é"]), max_size=30).map("".join))
def test_any_markup_is_read_to_its_end(html):
    he.remaining_text(he.parse(html), set())


def plain_page(i, rng):
    """A page without telling elements: only the template shows what is not the article."""
    body = "".join(f"<div><span>own {i} {rng.random()}</span></div>" for _ in range(rng.randint(1, 4)))
    return f"<html><body><div>Site name</div><div>Our slogan here</div>{body}<div>All rights kept</div></body></html>"


def test_template_text_goes_and_copies_do_not_make_a_template(spark):
    rng = random.Random(1)
    rows = [(i, "http://h.example/x", plain_page(i, rng)) for i in range(20)]
    copy = "<html><body><div>Just</div><div>one text</div></body></html>"
    rows += [(100 + i, "http://copies.example/", copy) for i in range(20)]
    rows += [(200, "http://two.example/", plain_page(1, rng)), (201, "http://two.example/", plain_page(2, rng))]
    rows += [(300, None, None), (301, "", ""), (302, "http://h.example/", "<p>" + "long " * 200_000 + "</p>"), (303, None, "<article>null url</article>")]
    rows += [(303, None, "<article>null url</article>")]
    df = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)
    got = {r["page_id"]: r for r in he.main_texts(df).collect()}
    for i in range(20):
        lines = got[i]["text"].split("\n")
        assert all(x.startswith(f"own {i} ") for x in lines) and len(lines) == rows[i][2].count("<span>")
    assert all(got[100 + i]["text"] == "Just\none text" for i in range(20))
    assert got[200]["text"].startswith("Site name\nOur slogan here\nown 1")       # too few pages for a template
    assert (got[300]["text"], got[300]["n_chars"], got[301]["text"]) == ("", 0, "")
    assert got[302]["n_chars"] == 5 * 200_000 - 1
    assert got[303]["text"] == "null url"
    assert he.main_texts(df).count() == len(rows)
    salted = {r["page_id"]: r["text"] for r in he.main_texts(df, broadcast_tokens=0).collect()}
    assert salted == {i: r["text"] for i, r in got.items()}
    assert he.main_texts(df.limit(0)).count() == 0


def test_text_out_of_its_order_or_slot_is_no_template(spark):
    """A class whose tokens change their order is not valid: what may be the author's stays."""
    rows = []
    for i in range(12):
        own = [f"<p>own {i}</p>", "<p>wandering line</p>"]
        blocks = ["<div>top</div>", "<h2>middle</h2>", "<h5>bottom</h5>"]
        blocks.insert(1 + i % 3, "".join(own))
        rows.append((i, "http://w.example/", "<body>" + "".join(blocks) + "</body>", "", "", ""))
    texts = {r["page_id"]: r["text"] for r in he.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all("own" in t and "wandering line" in t for t in texts.values())


def test_articles_are_never_cut_by_the_template(spark):
    rows = [(i, "http://a.example/", f"<div>Menu text</div><article><p>Same first line</p><p>own {i}</p></article>", "", "", "") for i in range(9)]
    got = {r["page_id"]: r["text"] for r in he.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"Same first line\nown {i}" for i in range(9)}


def test_the_template_decides_on_text_inside_articles(spark):
    """Same text in a place of its own is the template's, in an article or not; an article that is all template is not the article."""
    def page(i):
        return (f"<body><main><h1>Daily paper</h1><article class='note'><p>About this site</p></article><article><h2>Title {i}</h2>"
                f"<p>Same first line</p><p>own {i}</p><div class='more'>Read all of it</div></article></main></body>")

    rows = [(i, "http://d.example/", page(i), "", "", "") for i in range(9)]
    rows += [(20 + i, "http://e.example/", f"<article><p>Only a frame</p></article><div>own {i}</div>", "", "", "") for i in range(9)]
    rows += [(40 + i, "http://few.example/", page(i), "", "", "") for i in range(2)]
    got = {r["page_id"]: r["text"] for r in he.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == f"Title {i}\nSame first line\nown {i}" for i in range(9))
    assert all(got[20 + i] == f"own {i}" for i in range(9))
    assert all(got[40 + i] == f"Daily paper\nAbout this site\nTitle {i}\nSame first line\nown {i}\nRead all of it" for i in range(2))


def test_every_text_block_is_a_token():
    page = he.parse("<nav>menu</nav><article><p>text</p></article><footer>end</footer>")
    assert sum(is_text for _, is_text in page.tokens) == len(page.blocks) == 3


WRAPPED = [
    ("<div class='layout has-sidebar'><article><p>t</p></article></div>", "t"),
    ("<div id='search-page'><main><h1>T</h1><p>t</p></main></div>", "T\nt"),
    ("<app-root class='search-page'><article>t</article></app-root>", "t"),
    ("<div class='header-fixed'><article>t</article></div>", "t"),
    ("<main><h1>T</h1><div class='layout has-sidebar'><article><p>t</p></article><div class='sidebar'>s</div></div></main>", "T\nt"),
    ("<div class='sidebar-layout'><article><p>t</p><div class='share'>s</div></article></div>", "t"),
    ("<div class='no-ads'><div class='with-menu'><article>t</article><div class='related'><article>r</article></div></div></div>", "t"),
    ("<article>t</article><div class='related'><article>r</article></div>", "t"),
    ("<main><p>t</p><div class='sidebar'><article>s</article></div></main>", "t"),
    ("<article>t<section class='comments'><article>c</article></section></article>", "t"),
    ("<div class='related'><article class='card'>r</article></div><p>t</p>", "t"),
    ("<div class='has-sidebar'><aside><article>s</article></aside></div><p>t</p>", "t"),
    ("<div class='has-sidebar'><nav><main>s</main></nav></div>", "s"),
]


@pytest.mark.parametrize("html,want", WRAPPED)
def test_a_class_around_an_article_does_not_lose_it(html, want):
    assert he.remaining_text(he.parse(html), set()) == want


@pytest.mark.parametrize("left_open,then", [("<span>", "</b>"), ("<span>", "<div></div>x"), ("<li><ul>" + "<i>" * 9, "<li></li>y"), ("<p><b>", "z<hr>")])
def test_tags_left_open_cost_linear_time(left_open, then):
    """Ten times the markup takes about ten times as long, not a hundred."""
    import time

    def took(n):
        html, began = left_open * n + then * n, time.process_time()
        he.parse(html)
        return time.process_time() - began
    took(1000)
    assert min(took(20_000) for _ in range(2)) < 40 * max(0.005, min(took(2000) for _ in range(3)))


WITHIN = [("discussion-guide", True), ("related-work", True), ("search-algorithm", True), ("menuPlanning", True), ("has-comments", True),
          ("related-work ad", False), ("ad", False), ("ad-box", False), ("comment-list", False), ("relatedPosts", False),
          ("sponsored-content wide", False), ("share-buttons", False), ("newsletter_signup", False), ("widget-12", False), ("disqus_thread", False)]


@pytest.mark.parametrize("name,kept", WITHIN)
@pytest.mark.parametrize("attr", ["class", "id"])
def test_a_listed_word_within_an_article_skips_only_a_box(name, kept, attr):
    html = f"<article><p>a</p><div {attr}='{name}'><p>b</p></div><p>c</p></article>"
    assert he.remaining_text(he.parse(html), set()) == ("a\nb\nc" if kept else "a\nc")
