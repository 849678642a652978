"""HTML extraction: wrappers, exact texts of hand-written pages, and the supplied pages."""

from __future__ import annotations

import html
import re

import pytest

from tidepool.llm import html_wrappers as hw

FOLDER = "/root/testdata/sf0.01"


def text_of(page, wrapper=None):
    return hw.main_text(hw.read_page(page), wrapper)


def wrapper_of(*pages):
    total = None
    for page in pages:
        one = hw.as_wrapper(hw.read_page(page))
        total = one if total is None else hw.join(total, one)
    return total


def test_union_free_expression():
    one = "<div><h1>A</h1><p>x</p><p>y</p></div>"
    two = "<div><h1>B</h1><img><p>z</p><ul><li>1<li>2</ul></div>"
    assert wrapper_of(one).expression() == "<><div><h1>#SAME</>(<p>#TEXT</>)+</></>"
    assert wrapper_of(one, two).expression() == "<><div><h1>#TEXT</>(<p>#TEXT</>)+(<ul>(<li>#TEXT</>)+</>)?</></>"


def test_repeated_groups():
    page = "<dl>" + "".join(f"<h2>t{i}</h2><p>a{i}</p>" for i in range(5)) + "</dl>"
    assert wrapper_of(page).expression() == "<><dl>(<h2>#TEXT</><p>#TEXT</>)+</></>"


def test_dump_round_trip():
    wrapper = wrapper_of("<div class='a b1'><p>x<p>y</div>", "<div class='a b2'>z</div>")
    assert hw.Node.load(wrapper.dump()).dump() == wrapper.dump()


def test_furniture_goes():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><body><header>Site</header>
    <ul class="menu"><li><a href=1>Home</a><li><a>News</a></ul><div id=content><h2>Title &eacute;&nbsp;x</h2>
    <p>One <b>t</b>wo<p>Three<br>four<div class="user-comments"><p>Nice!</div><form><input>Name</form>
    <script>var a = "</p><p>no";</script></div><aside>Also</aside><div class="cookie-notice">We use</div>
    <!-- hidden > --><noscript>no</noscript><footer>(c)</footer>"""
    assert text_of(page) == text_of(page, wrapper_of(page)) == "Title é x One two Three four"


def test_article_text_stays_whatever_its_names():
    page = """<body><article><h1>T</h1><section class="related-work"><p>One.</p></section><p class="legal">Two.</p>
    <div class="comment-analysis">Three.</div><p>End.</p><div class="comments"><p>Nice!</p></div></article>"""
    assert text_of(page) == text_of(page, wrapper_of(page)) == "T One. Two. Three. End."
    page = """<main><h1>T</h1><div class="ad-hoc">One.</div><table class="widget-sizes"><tr><td>Two.</table><p>End.</p>
    <div class="ad">Buy</div></main>"""
    assert text_of(page) == text_of(page, wrapper_of(page)) == "T One. Two. End."


def test_the_wrapper_decides_on_suspected_names():
    """The same kind of name is furniture where its text never changes, and text where it does."""
    same = [f"<article><h1>T{i}</h1><p>Text {i}</p><div class='share-box'>Tell your friends</div></article>" for i in range(5)]
    assert text_of(same[0]) == "T0 Text 0 Tell your friends"
    assert text_of(same[0], wrapper_of(*same)) == "T0 Text 0"
    other = [f"<article><h1>T{i}</h1><p>Text {i}</p><div class='share-box'>A share of {i}</div></article>" for i in range(5)]
    assert text_of(other[0], wrapper_of(*other)) == "T0 Text 0 A share of 0"
    links = "<article><p>Text</p><div class='related-links'><a>More of this</a> <a>and this</a></div></article>"
    assert text_of(links) == "Text"


def test_a_form_around_the_page_is_its_body():
    page = """<body><form action=x><div id=top><nav>Home</nav><article><h1>T</h1><p>Some longer text of the page.</p></article></div>
    <input>Search</form></body>"""
    assert text_of(page) == "T Some longer text of the page."
    plain = "<body><form><h1>T</h1><p>Text in a form.</p></form><footer>(c)</footer></body>"
    assert text_of(plain) == text_of(plain, wrapper_of(plain)) == "T Text in a form."
    assert text_of("<body><p>Before the form all text</p><form><p>Your name</p></form></body>") == "Before the form all text"
    assert text_of("<body><form><label>Name</label><input></form></body>") == ""


def test_article_wins_over_the_rest():
    page = "<body><div>Top line of the site</div><article><header><h1>H</h1></header><p>a &lt;b&gt; c</p><nav>n</nav></article><div>More</div></body>"
    assert text_of(page) == "H a <b> c"


def test_same_text_on_all_pages_of_a_host_is_template():
    pages = [f"<body><div class=x{i}><p>Welcome to us</p><div><p>Story {i} {'abc' * i}</p></div></div></body>" for i in range(5)]
    wrapper = wrapper_of(*pages)
    assert [text_of(p, wrapper) for p in pages] == [f"Story {i} {'abc' * i}".strip() for i in range(5)]


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p", "<p"), ("<title>x<p>y", "y"), ("<div>" * 3000 + "x", "x"),
    ("<p>cut &am", "cut &am"), ("<article><p>no end", "no end"), ("a < b", "a < b"), ("<p>a</P><P>b</p>", "a b"),
])
def test_odd_pages(page, want):
    assert text_of(page) == want


def test_wrappers_stay_bounded(monkeypatch):
    monkeypatch.setattr(hw, "MAX_NODES", 50)
    total = None
    for i in range(30):
        one = hw.as_wrapper(hw.read_page("".join(f"<x{i}-{j}><p>{i}</p></x{i}-{j}>" for j in range(9))))
        total = hw.shrink(one if total is None else hw.join(total, one))
        assert len(str(total.dump())) < 60_000
    assert text_of("<x1-1><p>kept</p></x1-1>", total) == "kept"


def test_deep_closed_nesting():
    """End tags pair with their own start tags at any depth, and furniture is known there too."""
    def page(i):
        deep = "<div>" * 150 + f"deep {i}<nav>menu</nav><table><tr><td>cell</table>" + "</div>" * 150
        return f"<html><body><div class=wrap><article><p>first {i}</p>{deep}<p>last {i}</p></article><p>outside</p></div></body></html>"

    wrapper = wrapper_of(*map(page, range(4)))
    assert text_of(page(1)) == text_of(page(1), wrapper) == "first 1 deep 1 cell last 1"
    assert hw.Node.load(wrapper.dump()).dump() == wrapper.dump()
    assert text_of("<div>" * 50_000 + "x" + "</div>" * 50_000 + "y") == "x y"


def test_equal_paragraphs_of_a_page_are_no_template():
    page = "<body><div><p>so</p><p>so</p><p>so</p><h2>x</h2></div></body>"
    assert text_of(page, wrapper_of(page)) == "so so so x"


def test_copies_of_one_page_are_no_template():
    page = "<body><div><h2>One</h2><p>Two</p></div></body>"
    assert text_of(page, wrapper_of(*[page] * 5)) == "One Two"
    others = [f"<body><div><h2>One</h2><p>Two {i}</p></div></body>" for i in "abc"]
    assert text_of(others[0], wrapper_of(page, page, others[0])) == "One Two a"
    pages = [f"<body><div><p>Head</p><h2>Story {i}</h2></div></body>" for i in "abc"]
    assert text_of(pages[0], wrapper_of(*pages)) == "Story a"


def test_cut_wrappers_know_articles(monkeypatch):
    pages = [f"<body><div>Top {i}</div><div class=a><div class=b><article><p>Text {i}</p></article></div></div></body>" for i in range(5)]
    wrapper = wrapper_of(*pages)
    monkeypatch.setattr(hw, "MAX_NODES", 5)
    assert [text_of(p, hw.shrink(wrapper)) for p in pages] == [f"Text {i}" for i in range(5)]


def test_large_hosts_keep_their_rules(spark):
    """A long page of sections cuts the wrapper of its host: templates and link blocks go all the same."""
    def page(i, sections):
        body = "".join(f"<h2>t{i} {j}</h2><p>a{i} {j}</p><ul><li>b{i} {j}</li></ul><p>c{i} {j}</p>" for j in range(sections))
        links = "<section><p><a href=1>Go there or there</a> x</p><h3>more</h3></section>"
        return f"<body><div><div><h1>Welcome</h1>{links}<div>{body}</div></div></div></body>"

    def want(i, sections):
        return " ".join(f"t{i} {j} a{i} {j} b{i} {j} c{i} {j}" for j in range(sections))

    sizes = [1000, 2, 1, 3]
    rows = [(i, f"http://{host}/{i}", page(i, n if host == "big" else min(n, 3))) for i, n in enumerate(sizes) for host in ("big", "small")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    wrappers = {r.host: r.cut for r in hw.infer_wrappers(pages.select(hw.host_of("url").alias("host"), "html")).collect()}
    assert wrappers == {"big": True, "small": False}
    got = {r.url: r.text for r in hw.extract_text(pages).collect()}
    assert got == {f"http://{host}/{i}": want(i, n if host == "big" else min(n, 3)) for i, n in enumerate(sizes) for host in ("big", "small")}


@pytest.mark.parametrize("page, want", [
    ("<p>\u0130</p><SCRIPT>no</SCRIPT><p>y</p>", "\u0130 y"), ("<p>x</p><Style>no</sTYLE>y", "x y"),
    ("<div>x <svg class=a/> y</div>z", "x y z"), ("<div><math/>y <svg><path/></svg> z</div>", "y z"),
    ("<script src=a/>no</script>x", "x"), ('<script src="a" /><p>x</p><script>no</script>', "x"), ("<svg/>x<svg>no</svg>y", "x y"),
])
def test_raw_elements_end(page, want):
    assert text_of(page) == want


def plain(page):
    inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    return " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|br|h1)>", " ", inside))).split())


def test_supplied_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    want = {r.page_id: (r.url, plain(r.html)) for r in pages.collect()}
    got = hw.extract_text(pages).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_page_rows(spark, monkeypatch):
    rows = [(1, "http://a.b/1", "<p>x</p>", 1), (1, "http://a.b/1", "<p>x</p>", 1), (None, None, None, 2), (3, "no url", "", 3),
            (4, "HTTP://A.B/2", "<p>" + "long " * 50_000 + "</p>", 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    for limit in (hw.BROADCAST_BYTES, 0):
        monkeypatch.setattr(hw, "BROADCAST_BYTES", limit)
        got = sorted((r.page_id or 0, r.text, r.n_chars) for r in hw.extract_text(pages).collect())
        assert got == [(0, "", 0), (1, "x", 1), (1, "x", 1), (3, "", 0), (4, ("long " * 50_000).strip(), 249_999)]
    assert hw.extract_text(pages.limit(0)).collect() == []
