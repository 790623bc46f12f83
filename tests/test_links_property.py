"""Property: anchor hrefs equal those the standard library HTML parser reports."""

from html.parser import HTMLParser

from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.functions.urls import anchor_hrefs


class _Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            for k, v in attrs:
                if k == "href":
                    self.out.append(v or "")
                    break


def reference_hrefs(html: str) -> list[str]:
    p = _Links()
    p.feed(html)
    p.close()
    return p.out


ITEMS = ["<a href=\"/player/1/\">", "<A HREF='//cdn.x.org/p'>", "<a class=k href=rel/page>",
         "<a data-href=\"no\" href=\"/yes\">", "<a name=\"n\">", "<a\nhref=\"/nl\">",
         "<a href=\"/q?a=1&amp;b=2\">", "</a>", "text", " ", "<abbr title=\"t\">", "<p>", "</p>"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ITEMS), min_size=1, max_size=20).map("".join),
                min_size=1, max_size=30))
def test_hrefs_match_stdlib_parser(spark, pages):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, h string")
    got = {r.i: list(r.hrefs) for r in df.select("i", anchor_hrefs("h").alias("hrefs")).collect()}
    for i, h in enumerate(pages):
        assert got[i] == reference_hrefs(h), (h, got[i])
