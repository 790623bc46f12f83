"""The tag grammar that both texts and the links share: quoted values, unclosed blocks, unclosed quotes."""

import random
import time

import pytest
from pyspark.sql import functions as F

from courtside.functions import text
from courtside.functions.text import html_raw_text, html_to_text
from courtside.functions.urls import anchor_hrefs

CASES = [
    ('<a title="a>b" href="c">d</a>', "d", "d", ["c"]),
    ("<a title='a>b' href='c'>d</a> e", "d e", "d e", ["c"]),
    ("<a href=x>1</a><a href = \"y\">2</a>", "1 2", "12", ["x", "y"]),
    ("a<script>var x = '<a href=\"no\">';", "a", "a", []),
    ("a<style>b{c:d}", "a", "a", []),
    ("a<!-- b <a href='no'>", "a", "a", []),
    ("a<!-- b --> c<script>x</script>d", "a c d", "a cd", []),
    ("<script data-x=\"a>b\">no</script>yes", "yes", "yes", []),
    # a quote that is never closed: the tag ends at its first ">"
    ('<p title="open>text</p> more', "text more", "text more", []),
    ("<p class=it's>text</p>", "text", "text", []),
    ("2 < 3 and 4 > 1 <b>x</b>", "2 < 3 and 4 > 1 x", "2 < 3 and 4 > 1 x", []),
    ('<img alt="<a href=\'no\'>in</a>">out', "out", "out", []),
    ("<a b=c==\"d\" href=e>f</a>", "f", "f", ["e"]),
    ("<a href=''>none</a>", "none", "none", [""]),
    ("", "", "", []),
    (None, "", "", []),
]


def test_literals(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, h string")
    got = {r.i: (r.t, r.w, r.a) for r in df.select("i", html_to_text("h").alias("t"), html_raw_text("h").alias("w"), anchor_hrefs("h").alias("a")).collect()}
    for i, (html, text, raw, links) in enumerate(CASES):
        assert got[i] == (text, raw, links), (html, got[i])


@pytest.mark.parametrize("html", ['<a b="c" ' * 4000, "<a " + 'b="c" ' * 3000, "<a " + "b=c " * 3000 + ">x", '<p x="' + "y" * 200_000, "<" * 50_000, "<a href=" * 5000, "=\"" * 20_000 + "<a>"])
def test_no_input_takes_long(spark, html):
    """Long unclosed markup neither overflows the matcher's stack nor makes it try all splits."""
    began = time.time()
    spark.createDataFrame([(html,)], "h string").select(html_to_text("h"), html_raw_text("h"), anchor_hrefs("h")).collect()
    assert time.time() - began < 20


def test_the_matchers_form_of_the_patterns_finds_the_same(spark):
    """The patterns with their "<" ahead and the ones that the SQL uses take the same from odd markup."""
    parts = ["<", ">", "a", "/", "!--", "-->", "=", '"', "'", " ", "script", "SCRIPT", "style", "template", "</script>", "<Style>", "</template", "<!", "<p b='>'>", "\n", "&amp;", "<?", "scripts"]
    r = random.Random(5)
    df = spark.createDataFrame([("".join(r.choices(parts, k=r.randint(0, 30))),) for _ in range(3000)], "h string")
    pairs = ((text.RE_HIDDEN_BLOCKS, text.JVM_HIDDEN_BLOCKS), (text.RE_COMMENTS_AND_TAGS, text.JVM_COMMENTS_AND_TAGS))
    for one, other in pairs:
        assert df.where(F.regexp_replace("h", one, "#") != F.regexp_replace("h", other, "#")).collect() == []
        assert df.where(F.regexp_replace("h", one, "#") != F.col("h")).count() > 100
