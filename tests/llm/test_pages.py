import re
from html import unescape

import pytest

from tickloom.llm import html, url_filter

PAGES = "page_id long, url string, html string"


def test_articles_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in html.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", article))
        assert got[r.page_id].text == "\n".join(b for b in blocks if b)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


ARTICLE = "<h1>Title &amp; more</h1><p>First  one\n here.<p>Short.</p><p>Last&nbsp;one with <b>bold</b>face.</p>"
EXPECTED = "Title & more\nFirst one here.\nShort.\nLast one with boldface."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><nav><a href=x>Menu</a></nav><article>{ARTICLE}</article><footer>Foot</footer></body>", EXPECTED),
        (f"<header><p>Site</p></header><main>{ARTICLE}</main><aside><p>Side bar text</p></aside>", EXPECTED),
        (f"<div id='cookie-notice'>We use cookies</div><div class=content>{ARTICLE}</div><div class='comments'><p>Great text, I liked it a lot and more</p></div>", EXPECTED),
        (f"<article>{ARTICLE.replace('<p>Short.', '<div class=ad>Buy</div><form><p>Mail?</p></form><div class=ad>Now</div><aside>x</aside><p>Short.')}</article>", EXPECTED),
        (f"<article>{ARTICLE}<section class='reader comments'><article><p>Long reader comment here</p></article></section></article>", EXPECTED),
        (f"<script>var a = '<p>no</p>'</script><style>p {{}}</style><!-- <p>no</p> --><body>{ARTICLE}</body>", EXPECTED),
        (f"<ul><li><a href=a>One</a><li><a href=b>Two</a></ul><nav></nav>{ARTICLE}<nav></nav><p>Small print</p>", EXPECTED),
        (f"<article>{ARTICLE}", EXPECTED),
        ("<p>a &lt;b&gt; 1 < 2 &eacute;&#233;</p>", "a <b> 1 < 2 éé"),
        ("plain text", "plain text"),
        ("", ""),
        ("<nav>only a menu</nav>", ""),
        ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
        ("<title>t</title><p>x<br>y</p>", "x y"),
        ("<p>x<script>if (a < b) {}</script>y</p>", "xy"),
    ],
)
def test_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>Out</p><main><h1>Title</h1><p>Lead</p><article><p>The article itself</p></article><p>Note</p></main>", "Title\nLead\nThe article itself\nNote"),
        ("<main><article><p>First one</p></article><article><p>Second</p></article></main><p>Out</p>", "First one\nSecond"),
        ("<div><article><p>First one</p></article><p>x</p><article><p>Second</p></article></div>", "First one\nSecond"),
        ("<article><p>Before</p><article><p>A quoted article</p></article><p>After</p></article>", "Before\nA quoted article\nAfter"),
        ("<article><p>Before</p><nav><a href=a>Menu</a></nav><header><p>H</p></header><p>After</p></article>", "Before\nAfter"),
        ("<div class=content><p>Before the menu</p><nav><a href=a>Menu</a></nav><p>After</p></div><footer>Foot</footer><p>Out</p>", "Before the menu\nAfter"),
        ("<div class=content><div>Before</div><header>x</header><div>After it all</div></div>", "Before\nAfter it all"),
        ("<div><p>Before the links</p><ul><li><a href=a>a</a><li><a href=b>b</a><li><a href=c>c</a></ul><p>After</p></div>", "Before the links\nAfter"),
        ("<p>Before the links</p><ul><li><a href=a>a</a><li><a href=b>b</a><li><a href=c>c</a><li><a href=d>d</a></ul><p>After</p>", "Before the links\nAfter"),
        (f"<article><p>Card</p></article><div><p>Lead</p><article>x</article>{ARTICLE}</div>", f"Lead\nx\n{EXPECTED}"),
    ],
)
def test_pages_with_nested_articles_and_menus_inside(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article class='post comments-open'>{ARTICLE}</article><p>Out</p>", EXPECTED),
        (f"<div id='content' class='has-sidebar'>{ARTICLE}</div>", EXPECTED),
        (f"<div id='content' class='post comments-open'>{ARTICLE}</div>", EXPECTED),
        (f"<article class='related-post'>{ARTICLE}</article>", EXPECTED),
        (f"<div class='sidebar-right'><article>{ARTICLE}</article></div>", EXPECTED),
        (f"<form class=search><main>{ARTICLE}</main></form>", EXPECTED),
        (f"<article>{ARTICLE}</article><div class=related><article><p>Another one</p></article></div>", EXPECTED),
        (f"<div>{ARTICLE}</div><div class='comments-area'><article><p>Great text, I liked it a lot and much more than that</p></article></div>", EXPECTED),
        (f"<div>{ARTICLE}</div><div class='site-footer'>Foot</div><div class='cookie-notice'>We use cookies</div>", EXPECTED),
    ],
)
def test_class_names_tell_only_as_a_whole_or_by_their_head(page, text):
    assert html.main_text(page) == text


def test_odd_pages(spark):
    long = "<article>" + "<p>word word</p>" * 50_000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (2, "u", ""), (None, "u", "<p>x</p>"), (3, "u", long), (4, "u", "<" * 2000 + "<a <b"), (5, "u", "<div>" * 3000 + "deep")]
    got = html.extract(spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", text string")).collect()
    assert sorted(str(r.page_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert {r.page_id: r.n_chars for r in got}[3] == 50_000 * 10 - 1
    assert html.extract(spark.createDataFrame([], PAGES)).count() == 0


URLS = {
    "http://Ex.Example.NET/en/5": ("ex.example.net", "/en/5", "example.net/en/", "allow"),
    "http://example.net/de/5?x=/en/": ("example.net", "/de/5", "net/", "block"),
    "https://www.example.com/de/x#y": ("www.example.com", "/de/x", "example.com/de/", "block"),
    "https://badexample.com/de/x": ("badexample.com", "/de/x", None, "allow"),
    "ftp://a.org/fr/": ("a.org", "/fr/", "org/fr/", "allow"),
    "http://a.org/fr": ("a.org", "/fr", None, "allow"),
    "http://a.net": ("a.net", "", None, "allow"),
    "http://a.net?x://b.org/fr/": ("a.net", "", None, "allow"),
    "no scheme/en": ("", "", None, "allow"),
    "http://É.ORG/x\ny": ("É.org", "/x\ny", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, "http://a.org/fr/", "x", "y")] * 2
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, template string, host string")).collect()
    assert len(got) == len(rows)
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert all(by[i] == expected for i, expected in enumerate(URLS.values()))
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_templates(spark):
    rules = (("h.org/bad/", "block"), ("h.org/good/", "allow"), ("h.org/bads/", "block"))
    urls = [f"http://h.org/bad/{i}" for i in range(60)] + [f"http://h.org/good/{i}.html" for i in range(60)] + [f"http://h.org/u/{n}/posts" for n in "abcdefghijklmnopqrstuvwxyz"] + ["http://h.org/x/y"]
    got = {r.path: r for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert got["/bad/7"].template == "/bad/*" and got["/bad/7"].purity > 0.9
    assert got["/good/7.html"].template == "/good/*.html" and got["/good/7.html"].purity < 0.1
    assert got["/u/a/posts"].template == "/u/*/posts" and got["/u/a/posts"].verdict == "allow"
    assert got["/x/y"].rule is None and got["/x/y"].verdict == "allow"


def test_a_template_without_rules_of_its_own_can_be_rejected(spark):
    """Users' folders become one wildcard; those that a rule blocks speak for the others."""
    rules = tuple((f"h.org/u{c}/", "block") for c in "abcdefghijklmnopqrstuvwx")
    urls = [f"http://h.org/u{c}/{i}" for c in "abcdefghijklmnopqrstuvwxyz" for i in range(3)]
    got = {r.path: r for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert got["/uz/1"].rule is None and got["/uz/1"].template == "/*/*" and got["/uz/1"].verdict == "block"


def test_a_template_without_labels_is_allowed_whatever_the_others_are(spark):
    """Nearly all labelled urls are blocked; that says nothing about templates without a labelled url."""
    rules = (("bad.net/", "block"), ("bad.net/en/", "allow"))
    clean = ["http://clean.org/x/y", "http://clean.com/a", "http://clean.com", "no scheme", None]
    urls = [f"http://bad.net/de/{i}" for i in range(60)] + ["http://bad.net/en/1"] + clean
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert {got[i].verdict for i in range(60)} == {"block"} and got[60].verdict == "allow"
    assert [(got[i].rule, got[i].verdict) for i in range(61, 66)] == [(None, "allow")] * 5


def test_deep_paths(spark):
    urls = ["http://h.org/" + "/".join("abcdefghijkl") + f"/{i}" for i in range(3)]
    got = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()
    assert {r.template for r in got} == {"/a/b/c/d/e/f/g/h/**"}
