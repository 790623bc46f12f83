"""Page parsing on literal pages, importances against a direct calculation, broadcast and joined removal alike."""

import math
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import html_extract as H

SCHEMA = "page_id long, url string, html string"

CASES = [
    ("<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href='/x'>menu</a></li></ul></nav>"
     "<div class=\"ad\">buy</div><article><h1>Head</h1><p><b>One &amp; two.<br><p>Three\n  four &copy;</article><footer>end</footer></body></html>", "Head\nOne & two.\nThree four ©"),
    ("<article>a<script>if (x < y) '</article>'</script>b<!-- no <p>comment</p> -->c</article>", "abc"),
    ("<article><header><h1>Title</h1></header><p>x</p><footer>f</footer><aside>s</aside><form>q<input></form></article><header>page</header>", "Title\nx"),
    ("<article><p>x</p></article><section id='comments'><article class=comment><p>me too</p></article></section>", "x"),
    ("<main><p>main text</p><div class='cookie-notice'>ok?</div></main><p>outside</p>", "main text"),
    ("<article><p>cut &am", "cut &am"), ("<article><p>cut &amp", "cut &"), ("<article><p>text <b cl", "text"), ("<article><p>a<p>b<ul><li>c<li>d</ul>e", "a\nb\nc\nd\ne"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n2\n3"), ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
    ("<article><p>one</p></div></span></p><p>two</p></article>", "one\ntwo"), ("<article><p>&lt;p&gt; &#233;&#x41;&nbsp;end</p></article>", "<p> éA end"),
    ("<article><pre>a\n  b</pre><p>x<br/>y</p></article>", "a b\nx y"), ("plain text", "plain text"), ("", ""), ("<", "<"), ("a < b", "a < b"), ("<article>1<2</article>", "1<2"),
    ("<article><p title='a > b'>q</p></article>", "q"), ("<article><textarea><p>no</p></textarea><p>yes</p></article>", "yes"), ("<script>open", ""), ("<!-- open", ""),
    ("<article><p>a</p><div class='related-posts'><p>r</p></div><div class='adventure'>kept</div></article>", "a\nkept"),
    # inside an article a hint word in a title's id or among other words is no hint
    ("<article><h2 id=\"related-work\">Related work</h2><p>x</p></article>", "Related work\nx"),
    ("<article><div class=\"search-algorithm\"><p>x</p></div><section id=\"social-history\"><p>y</p></section></article>", "x\ny"),
    ("<article id=\"menu-of-the-day\"><p>soup</p></article>", "soup"), ("<article><div id=\"reply-to-critics\"><p>no</p></div></article>", "no"),
    ("<article><p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p></article>", "let x=1 be"),
    ("<article><p>a</p><div class='ad-slot'>buy</div><div class='share-buttons'>s</div><div class='newsletter-signup'>n</div><div id='comments'>c</div>"
     "<ul class='content social'><li>t</li></ul><p>b</p></article>", "a\nb"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_pages(html, text):
    assert H.Page(html).text() == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<article>", "</article>", "<b>", "</b>", "<!--", "-->", "<div class='ad'>", "</div>", "<li>", "</ul>", "<script>", "</script>", "x", " ", "&amp;", "&", "<", ">", "'", '"', "<td"]), max_size=30).map("".join))
def test_any_markup_is_read(html):
    page = H.Page(html)
    assert "  " not in page.text() and all(t.strip() == t and t for t in page.text().split("\n") if page.text())


@given(st.lists(st.text(alphabet="ab c<&>'\"é", min_size=1, max_size=20), max_size=5))
def test_round_trip_of_paragraphs(paragraphs):
    import html
    raw = "<nav>n</nav><article>" + "".join(f"<p>{html.escape(p)}</p>" for p in paragraphs) + "</article>"
    assert H.Page(raw).text() == "\n".join(t for t in (" ".join(p.split()) for p in paragraphs) if t)


def site():
    """Pages without an article element: body text varies, a template frames it, one link list."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    rows, want = [], {}
    for k in range(60):
        body = [" ".join(rng.choices(words, k=12)) for _ in range(rng.randint(1, 6))]
        links = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in rng.choices(words, k=5))
        html = (f"<div class='top'><p>Welcome to our site</p></div><div class='text{k}'>" + "".join(f"<p>{p}</p>" for p in body)
                + f"</div><div class='links'><ul>{links}</ul></div><div class='legal'>All rights held by us</div>")
        rows.append((k, f"https://User@Site.example:80/p{k}?x", html))
        want[k] = "\n".join(body)
    rows += [(100, "http://one.example/", "<div><p>Welcome to our site</p></div>"), (101, None, None), (102, "odd", ""), (103, "//b.example/x", "<article>a</article>"),
             (None, "http://site.example/q", rows[0][2]), (104, "http://c.example", "<article><p>same</p></article>"), (105, "http://c.example", "<article><p>same</p></article>"),
             (105, "http://c.example", "<article><p>same</p></article>"), (106, "http://long.example", "<article>" + "<p>t</p>" * 20_000 + "</article>")]
    want |= {100: "Welcome to our site", 101: "", 102: "", 103: "a", None: want[0], 104: "same", 105: "same", 106: "\n".join(["t"] * 20_000)}
    return rows, want


def test_site_tree(spark):
    rows, want = site()
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("extra") for c in ("host", "text", "branch", "row", "remove", "kind")}).repartition(4)
    for options in ({}, {"broadcast_bytes": -1}):
        got = H.extract(df, **options).collect()
        assert len(got) == len(rows)
        assert {r["page_id"]: r["text"] for r in got} == want
    assert H.extract(df.limit(0)).count() == 0


def test_importances(spark):
    rows, _ = site()
    got = {(r["host"], r["branch"]): r for r in H.importances(H.observe(spark.createDataFrame(rows, SCHEMA))).collect()}
    look, say, size = defaultdict(Counter), defaultdict(Counter), defaultdict(lambda: [0, 0])
    for _, url, html in rows:
        host = {"https": "site.example", "http:": None}.get((url or "")[:5]) or ((url or "").split("//")[1].split("/")[0].lower() if "//" in (url or "") else "")
        page = H.Page(html)
        for path, children in page.presentations:
            if children:
                look[host, path][children] += 1
        for path, t, linked, part in page.blocks:
            if not part:
                say[host, path][t] += 1
                size[host, path][0] += len(t)
                size[host, path][1] += linked

    def spread(c):
        m = sum(c.values())
        return 0.0 if not m else 1.0 if m == 1 else 1 - sum(n * math.log(n) for n in c.values()) / (m * math.log(m))

    assert set(got) == set(look) | set(say)
    for k, r in got.items():
        n, linked = size[k]
        free = 1 - min(1, linked / n) if n else 1
        assert r["presentation"] == pytest.approx(spread(look[k])) and r["content"] == pytest.approx(spread(say[k]))
        assert r["importance"] == pytest.approx(max(spread(look[k]), spread(say[k])) * free)


WRAPPED = [
    ("<div class='layout has-sidebar'><article><p>text</p></article><div class=sidebar>s</div></div>", "text"),
    ("<form id='aspnetForm'><div>menu</div><article><p>one</p></article><article><p>two</p></article></form>", "one\ntwo"),
    ("<form><main><p>main text</p><div class=ad>buy</div></main></form>", "main text"),
    ("<main><p>a long text of the page</p><article><p>teaser</p></article></main>", "a long text of the page\nteaser"),
    ("<main><div>tools</div><article><p>a long text of the article</p></article></main>", "a long text of the article"),
    ("<main><div class='layout has-sidebar'><article><p>text</p></article></div></main>", "text"),
    ("<article><p>a long text of the article</p></article><div class='related'><article><p>teaser</p></article></div>", "a long text of the article"),
    ("<article><p>a long text</p><div class='related'><article><p>a still longer text of another article</p></article></div></article>", "a long text"),
    ("<section id='comments'><article>me too</article></section><p>a text without any name</p>", "a text without any name"),
    ("<div class='post comments-open'><article><p>a long text of the article</p></article></div><p>end</p>", "a long text of the article"),
    ("<div class='has-sidebar'><article>a<form>q</form><div class=share>s</div><p>b</p></article></div>", "a\nb"),
]


@pytest.mark.parametrize("html, text", WRAPPED)
def test_wrappers_take_no_article_away(html, text):
    assert H.Page(html).text() == text


def noticed():
    """Articles with a site-wide notice under a neutral class, a shared title on some, and copies of one article."""
    rows, want = [], {}
    for k in range(12):
        title = "Weather" if k < 4 else f"Title {k}"
        rows.append((k, "http://news.example/a", f"<article><h1>{title}</h1><p>text {k}</p><p>more {k}</p><div class='box'><p>Read this site on paper</p></div></article><div>foot</div>"))
        want[k] = f"{title}\ntext {k}\nmore {k}"
    rows.append((20, "http://news.example/b", "<article><div class='box'><p>Read this site on paper</p></div></article>"))  # nothing else: stays
    rows.append((21, "http://news.example/b", "<article><h1>T</h1><div class='box'><p>a text of its own</p></div></article>"))
    want |= {20: "Read this site on paper", 21: "T\na text of its own"}
    for k in range(30, 42):  # copies say nothing about a site
        rows.append((k, "http://copies.example/", "<article><h1>One</h1><p>same text</p></article>"))
        want[k] = "One\nsame text"
    for k in range(50, 53):  # too few different articles
        rows.append((k, "http://few.example/", f"<article><h1>Same</h1><p>text {k}</p></article>"))
        want[k] = f"Same\ntext {k}"
    return rows, want


def test_site_tree_decides_inside_articles(spark):
    rows, want = noticed()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for options in ({}, {"broadcast_bytes": -1}):
        assert {r["page_id"]: r["text"] for r in H.extract(df, **options).collect()} == want
    twice = H.extract(df.union(df)).collect()  # repeated rows are no more articles
    assert len(twice) == 2 * len(rows) and {r["page_id"]: r["text"] for r in twice} == want
    found = {(r["host"], r["branch"]) for r in H.removals(H.observe(df)).collect()}
    assert ("news.example", "article:/article/div.box/p") in found and ("news.example", "/div") in found
