"""Elements that are kept and dropped, and hosts of odd URLs."""

from __future__ import annotations

import pytest

from hazemill.llm import html


@pytest.mark.parametrize("opening", [
    "<article class='post has-comments'>", "<article class='post tag-search hentry'>", "<main class='content with-sidebar'>",
    "<div class='article-body has-share'>", "<body class='search has-alert hidden'><article>", "<article class='hidden'>",
    "<article id='comments'>", "<body class='sidebar'><main>",
])
def test_state_classes_drop_no_article(opening):
    page = f"<nav>menu</nav>{opening}<h2 id='related-work'>Related</h2><section id='search'><p class='has-share'>Text</p></section>"
    assert html.Page(page).extract(html.Template()) == "Related\n\nText"


def test_kinds_of_element_that_stay():
    page = (
        "<article><figure><figcaption>Caption</figcaption></figure><p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b"
        "<object>o</object></p><noscript><p>plain</p></noscript><dialog>said</dialog></article>"
    )
    assert html.Page(page).extract(html.Template()) == "Caption\n\na x=2 bo\n\nplain\n\nsaid"


@pytest.mark.parametrize("name", [
    "comments", "cookie-notice", "site-header", "sidebar widget", "post-comments", "social_share", "related-posts", "nav-main", "side-bar",
    "newsletter-form", "breadcrumbs", "ads", "ad-1", "commentlist", "user-comment", "comment-body", "ad-slot", "adsbygoogle",
    "related-articles", "comment-thread",
])
def test_whole_classes_drop(name):
    assert html.Page(f"<article><p>in</p><div class='{name}'>junk</div></article>").extract(html.Template()) == "in"
    assert html.Page(f"<body><p>in</p><div id='{name.split()[0]}'>junk</div></body>").extract(html.Template()) == "in"


def test_odd_urls_have_one_host_on_both_paths(spark, monkeypatch):
    urls = [
        "http://my_site.example.com/{}", "http://a.example.com/x {}", "http://b.example.com/x|{}", "http://c.example.com/{{{}}}",
        "HTTP://www.D.example.com:80/{}", "http://[bad/{}", "no url {}",
    ]
    rows = [
        (100 * k + i, url.format(i), f"<div><div>Menu of {k}</div><p>Own text {k} {i}</p><div>Bottom of {k}</div></div>")
        for k, url in enumerate(urls[:5]) for i in range(10)
    ]
    rows += [(1000 + k, url.format(k), "<p>x</p>") for k, url in enumerate(urls[5:])] + [(2000, None, "<p>y</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: f"Own text {i // 100} {i % 100}" for i, _, _ in rows if i < 1000} | {1000: "x", 1001: "x", 2000: "y"}
    assert {r.page_id: r.text for r in html.main_text(df).collect()} == want
    monkeypatch.setattr(html, "BROADCAST_TOKENS", 0)
    assert {r.page_id: r.text for r in html.main_text(df).collect()} == want


def site(n, body, first=0, host="h.org"):
    return [(first + i, f"http://{host}/{first + i}", f"<html><body>{body(i)}</body></html>") for i in range(n)]


def texts_of(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html.main_text(df).collect()}


def test_template_inside_the_article_goes_and_repeated_content_stays(spark):
    def body(i):
        license = "<p>Some rights reserved.</p>" if i % 3 == 0 else ""
        rows = "".join(f"<li><b>Item {i}.{k}</b></li>" for k in range(i % 4))
        return f"<article><h1>Title {i}</h1><div class='x1'>Tell your friends</div><p>Own {i}</p>{license}<ul>{rows}</ul><p>Back to top</p></article>"

    def want(i):
        items = [f"Item {i}.{k}" for k in range(i % 4)]
        return "\n\n".join([f"Title {i}", f"Own {i}", *["Some rights reserved."] * (i % 3 == 0), *items])

    rows = site(12, body)
    got = texts_of(spark, rows)
    assert got == {i: want(i) for i in range(12)}
    # What the template decides: without it these texts stay.
    assert "Tell your friends" in html.Page(rows[1][2]).extract(html.Template())


def test_each_layout_and_small_hosts_have_templates(spark):
    def layout(name):
        return lambda i: f"<div>Menu {name}</div><p>Own {name} {i}</p><div>Bottom {name}</div>"

    rows = site(8, layout("a")) + site(5, layout("b"), 100) + site(3, layout("c"), 200, "small.org") + site(2, layout("d"), 300, "two.org")
    got = texts_of(spark, rows)
    assert all(got[i] == f"Own a {i}" for i in range(8))
    assert all(got[100 + i] == f"Own b {i}" for i in range(5))
    assert all(got[200 + i] == f"Own c {i}" for i in range(3))
    assert got[300] == "Menu d\n\nOwn d 0\n\nBottom d"  # too few pages to tell


def test_copies_and_passages_are_no_template(spark):
    rows = site(6, lambda i: "<article><h1>Same</h1><p>One</p><p>Two</p></article>")
    rows += site(40, lambda i: f"<p>Own {i}</p>" + "<p>First shared</p><p>Second shared</p>" * (i < 15), 100, "p.org")
    got = texts_of(spark, rows)
    assert all(got[i] == "Same\n\nOne\n\nTwo" for i in range(6))
    assert all(got[100 + i] == f"Own {i}" + "\n\nFirst shared\n\nSecond shared" * (i < 15) for i in range(40))


def test_classes_equal_brute_force(spark):
    rows = site(9, lambda i: "<div>Top</div>" + "<section><h2>Part</h2>" * (i % 3) + f"<p>t{i}</p>" + "<div>End</div>" * (i != 4) + "<hr>" * i)
    rows += site(6, lambda i: ("<b>x</b><p>A</p><p>B</p>" if i % 2 else "<p>B</p><b>y</b><p>A</p>") + f"<div>{i}</div>", 50, "q.org")
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {}
    for r in html.templates(df).collect():
        got.setdefault((r.host, r.class_id), set()).add(r.token)
    want = set()
    for host in ("h.org", "q.org"):
        pages = [html.Page(h).tokens for _, url, h in rows if f"/{host}/" in url]
        vectors = {}
        for token in {t for page in pages for t in page}:
            vectors.setdefault(tuple(page.count(token) for page in pages), set()).add(token)
        for vector, members in vectors.items():
            on = [page for page in pages if members & set(page)]
            orders = {tuple(dict.fromkeys(t for t in page if t in members)) for page in on}
            again = all([t for t in page if t in members] == list(dict.fromkeys(t for t in page if t in members)) * max(vector[i], 1)
                        for i, page in enumerate(pages))
            between = {tuple(page[min(map(page.index, members)) : len(page) - min(map(page[::-1].index, members))]) for page in on}
            shared = any(t & 1 for t in members) or len(on) >= html.LEAST_SHARE * len(pages)
            if len(members) > 1 and len(on) >= html.LEAST_PAGES and len(orders) == 1 and again and len(between) > 1 and shared:
                want.add((host, frozenset(members)))
            if len(set(vector) - {0}) > 1 or max(vector) > 1:
                want.discard((host, frozenset(members)))  # the place of what repeats is tested below
    assert {(host, frozenset(tokens)) for (host, _), tokens in got.items()} == want and len(want) >= 2


def test_classes_that_cross_or_repeat():
    a, b, c, d = 2, 4, 6, 8
    template = html.Template([(a, 1, 0, 9, True), (b, 1, 0, 9, True), (c, 2, 0, 5, True), (d, 2, 0, 5, True)])
    page = html.Page("")

    def forms(*tokens):
        page.tokens = list(tokens)
        return {name: (regular, parent, gap if gap < 9 else "woven") for name, regular, _, parent, gap, _ in page.forms(template)}

    assert forms(a, c, d, c, d, b) == {1: (True, 0, 0), 2: (True, 1, 0)}
    assert forms(a, c, b, d) == {1: (True, 0, 0), 2: (True, 1, "woven")}
    assert forms(c, a, d, b) == {1: (True, 0, 0), 2: (True, 1, "woven")}
    assert forms(c, d, a, c, b, d) == {1: (True, 0, 0), 2: (False, 0, 0)}
    assert forms(a, b, b, a, c, d) == {1: (False, 0, 0), 2: (True, 0, 0)}
    assert forms(a, c, d, b, c, d) == {1: (True, 0, 0), 2: (False, 0, 0)}
