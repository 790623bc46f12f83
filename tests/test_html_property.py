"""Property: Spark's HTML-to-text equals the standard library HTML parser's text nodes.

Reference: ``html.parser`` delivers text nodes with entities decoded; text
inside script/style is skipped, every node is stripped and non-empty nodes
are joined by one space.
"""

from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.functions.text import html_to_text


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.skip and data.strip():
            self.out.append(data.strip())


def reference_text(html: str) -> str:
    p = _Text()
    p.feed(html)
    p.close()
    return " ".join(p.out)


ITEMS = ["Hello", "big  world", "x\ny", " ", "\n  ", "&amp;", "&quot;q&quot;", "&lt;b&gt;", "&copy; 2024",
         "a&middot;b", "&nbsp;pad&nbsp;", "it&#39;s", "é", "<p>", "</p>", "<div class=\"c\">", "</div>",
         "<b>", "</b>", "<br>", "<a href=\"/x\">", "</a>", "<!-- note <p> -->",
         "<script>var t=\"</p>\";</script>", "<style>p{margin:0}</style>", "<span id='s'>", "</span>",
         "<a title=\"a>b\" href='/q'>", "<img alt='x > y <b>' src=/i.png>", "<p class=it's>", "<td a = \"1 > 0\">", "<!DOCTYPE html>", "3 < 4"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ITEMS), min_size=1, max_size=25).map("".join),
                min_size=1, max_size=30))
def test_html_text_matches_stdlib_parser(spark, pages):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, h string")
    got = {r.i: r.t for r in df.select("i", html_to_text("h").alias("t")).collect()}
    for i, h in enumerate(pages):
        assert got[i] == reference_text(h), (h, got[i], reference_text(h))


class _Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style")
        first = next((v for k, v in attrs if k == "href"), None)
        if tag == "a" and first is not None and not self.skip:
            self.out.append(first)

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style")


LINK_ITEMS = ITEMS + ["<a href=/bare/x>", "<A  HREF = \"/u?a=1&amp;b=2\" >", "<a data-href='/no' href='/yes'>", "<a title='x href=\"/no\"' href=\"/yes2\" href='/late'>",
                      "<a name=\"href\">", "<img alt=\"<a href='/quoted'>\">", "<abbr href='/abbr'>", "<a\nhref='/line'\n>", "<a disabled href=''>"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(LINK_ITEMS), min_size=1, max_size=20).map("".join), min_size=1, max_size=30))
def test_links_match_stdlib_parser(spark, pages):
    from courtside.functions.urls import anchor_hrefs
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, h string")
    got = {r.i: r.a for r in df.select("i", anchor_hrefs("h").alias("a")).collect()}
    for i, h in enumerate(pages):
        p = _Links()
        p.feed(h)
        p.close()
        assert got[i] == p.out, (h, got[i], p.out)


class _Raw(_Text):
    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def reference_raw_text(html: str) -> str:
    p = _Raw()
    p.feed(html)
    p.close()
    return "".join(p.out)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ITEMS), min_size=1, max_size=25).map("".join),
                min_size=1, max_size=30))
def test_raw_text_matches_stdlib_parser(spark, pages):
    from courtside.functions.text import html_raw_text
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, h string")
    got = {r.i: r.t for r in df.select("i", html_raw_text("h").alias("t")).collect()}
    for i, h in enumerate(pages):
        assert got[i] == reference_raw_text(h), (h, got[i], reference_raw_text(h))
