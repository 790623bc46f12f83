"""HTML text, tokenizer and link rules on literal fixtures."""

from pyspark.sql import functions as F

from courtside.functions import urls as U
from courtside.functions.text import (html_raw_text, html_to_text, is_alnum,
                                      whitespace_tokens, word_tokens)
from courtside.operators.index import term_filter


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("out")).first().out


def test_html_to_text_drops_scripts_comments_and_decodes(spark):
    html = ('<html><head><title>T&amp;C</title><script>var t="</p>";</script>'
            '<style>p{margin:0}</style></head><body><!-- ad --><p>Hello <b>big</b>\n world'
            '</p><p>&quot;x&quot; &copy; 2024</p></body></html>')
    assert one(spark, html_to_text(F.col("v")), html) == 'T&C Hello big world "x" © 2024'


def test_raw_text_has_no_separator(spark):
    assert one(spark, html_raw_text(F.col("v")), "<tr><td>a</td><td>b</td></tr>") == "ab"


def test_empty_page_gives_empty_text(spark):
    assert one(spark, html_to_text(F.col("v")), None) == ""


def test_tokenizer_treebank_rules(spark):
    text = "Don't miss LeBron's 3-point night: 1,000 games … U.S. and/or a:b"
    toks = one(spark, word_tokens(F.col("v")), text)
    assert [t for t in toks if t.isalnum()] == ["do", "miss", "lebron", "night", "games", "a", "b"]
    kept = (spark.createDataFrame([(text,)], "v string")
                 .select(F.explode(word_tokens("v")).alias("t")).where(is_alnum("t"))
                 .collect())
    assert [r.t for r in kept] == ["do", "miss", "lebron", "night", "games", "a", "b"]


def test_filter_profiles(spark):
    df = spark.createDataFrame([(t,) for t in ["the", "x", "7", "mp3", "game", "été", "l'"]], "t string")
    v2 = {r.t for r in df.where(term_filter("t", "v2")).collect()}
    v1 = {r.t for r in df.where(term_filter("t", "v1")).collect()}
    assert v2 == {"game", "été"}
    assert v1 == {"game", "été", "mp3"}


def test_whitespace_split_keeps_punctuation_and_splits_nbsp(spark):
    toks = one(spark, whitespace_tokens(F.col("v")), "Games, games last  points")
    assert toks == ["Games,", "games", "last", "points"]


def test_anchor_forms_and_url_rules(spark):
    html = ('<a href="/player/2544/x/">a</a><A class=k HREF=\'//cdn.site.org/p\'>b</A>'
            '<a href=rel/page>c</a><a name="n">d</a>')
    df = spark.createDataFrame([("https://www.site.org/news/1", html)], "url string, html string")
    rows = (df.select("url", F.explode(U.anchor_hrefs("html")).alias("href"))
              .select("href", U.strip_trailing_slash(U.absolutize("href", "url")).alias("abs"),
                      U.last_segment(U.absolutize("href", "url")).alias("node"),
                      U.player_id(U.absolutize("href", "url")).alias("pid"))
              .collect())
    assert [r.href for r in rows] == ["/player/2544/x/", "//cdn.site.org/p", "rel/page"]
    assert [r.abs for r in rows] == ["https://www.site.org/player/2544/x",
                                     "https://cdn.site.org/p", "rel/page"]
    assert [r.node for r in rows] == ["x", "p", "page"]
    assert [r.pid for r in rows] == ["2544", "", ""]


def test_seed_join_and_prefix(spark):
    from courtside.sources.params import seed_frame
    seed = {"https://site.org/": {1: "player/1/a"}, "https://site.org/team/news/": {2: "post-1"}}
    rows = seed_frame(spark, seed).select("doc_id", U.join_url("base_url", "path").alias("u")) \
        .orderBy("doc_id").collect()
    assert [r.u for r in rows] == ["https://site.org/player/1/a", "https://site.org/team/news/post-1"]
    assert one(spark, U.prefix_if_relative(F.col("v"), "https://site.org"), "/p/1") == "https://site.org/p/1"


def test_text_nodes_are_stripped_not_collapsed(spark):
    html = "<div>\n  <p>Hello   big\n world</p>\n\n<p>&nbsp;x&nbsp;</p><p> </p><span>a&amp;b</span></div>"
    assert one(spark, html_to_text(F.col("v")), html) == "Hello   big\n world x a&b"


def test_contractions_split(spark):
    toks = one(spark, word_tokens(F.col("v")), "I cannot go, gonna win 'Tis canopy")
    assert toks == ["i", "can", "not", "go", "gon", "na", "win", "t", "is", "canopy"]


def test_seed_pages_keep_missing_documents(spark):
    from courtside.sources.params import seed_frame
    from courtside.sources.tables import seed_pages
    seed = seed_frame(spark, {"https://site.org/": {1: "player/1/a", 2: "player/2/b"}})
    landed = spark.createDataFrame([("https://site.org/player/1/a", "<p>Games</p>")], "url string, html string")
    rows = {r.doc_id: (r.url, r.html) for r in seed_pages(seed, landed).collect()}
    assert rows == {1: ("https://site.org/player/1/a", "<p>Games</p>"), 2: ("https://site.org/player/2/b", "")}


def test_of_several_landed_bodies_the_latest_counts(spark):
    from courtside.sources.params import seed_frame
    from courtside.sources.tables import seed_pages
    seed = seed_frame(spark, {"http://h/": {1: "a"}})
    landed = spark.createDataFrame([("http://h/a", "old", 1), ("http://h/a", "new", 2), ("http://h/a", "mid", 1)], "url string, html string, t int")
    for n in (1, 3):
        assert [r.html for r in seed_pages(seed, landed.repartition(n), order_col="t").collect()] == ["new"]


def test_literal_pages_to_text_and_links(spark):
    """Literal input and expected output, independent of the rule constants."""
    from courtside.functions.text import html_raw_text, html_to_text
    from courtside.functions.urls import anchor_hrefs
    cases = [
        ('<script>var x="</style>"; evil()</script>seen', "seen", "seen", []),
        ("<style>a{}</script>b</style>c<template><p>t</p></template>d", "c d", "cd", []),
        ("<p>caf&eacute; &#8217;s &#x41;&#X42; &mdash; &bogus; &#0;</p>", "café ’s AB — &bogus; &#0;", "café ’s AB — &bogus; &#0;", []),
        ("a &amp;quot; b &amp;amp; c", "a &quot; b &amp; c", "a &quot; b &amp; c", []),
        ("x &lt;b&gt; &AMP &amp y", "x <b> &AMP &amp y", "x <b> &AMP &amp y", []),
        ('<a href="x">1</a><!-- <a href="c">2</a> --><script>"<a href=\'s\'>"</script><A data-href=q HREF=\'y&amp;z\'>3</a><a href=bare>4</a>', "1 3 4", "134", ["x", "y&z", "bare"]),
        (None, "", "", []),
    ]
    df = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "k int, h string")
    got = {r.k: (r.t, r.raw, r.links) for r in df.select("k", html_to_text("h").alias("t"), html_raw_text("h").alias("raw"), anchor_hrefs("h").alias("links")).collect()}
    assert got == {k: c[1:] for k, c in enumerate(cases)}
