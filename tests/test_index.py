"""Index operators on literal documents."""

import random

import pytest
from pyspark.sql import functions as F

from courtside.functions import text as T
from courtside.functions.cells import strict_int
from courtside.operators import index as IX


def _docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_top_terms_ties_by_first_encounter(spark):
    docs = _docs(spark, [(1, "zebra apple mango"), (2, "mango apple zebra kiwi"), (10, "kiwi kiwi")])
    top = IX.top_terms(IX.term_postings(docs), 3).orderBy("rank").collect()
    # kiwi 3; zebra/apple/mango 2 each: zebra is met first (doc 1, position 0)
    assert [(r.rank, r.term, r.n) for r in top] == [(1, "kiwi", 3), (2, "zebra", 2), (3, "apple", 2)]


def test_posting_strings_sort_numerically_and_block(spark):
    docs = _docs(spark, [(i, "game") for i in (2, 10, 1, 7, 12)])
    post = IX.term_postings(docs)
    idx = IX.inverted_index(post, 1).collect()
    assert [(r.word, r.document_ids, r.n_docs) for r in idx] == [("game", "1, 2, 7, 10, 12", 5)]
    blocks = IX.posting_strings(post, block=5).orderBy("block").collect()
    assert [(r.block, r.document_ids) for r in blocks] == [(0, "1, 2"), (1, "7"), (2, "10, 12")]


def test_stop_words_digits_and_stems(spark):
    docs = _docs(spark, [(1, "The players played 3 games; the league's fantasy stats."), (2, "Leagues and games")])
    post = IX.term_postings(docs, stemmed=True)
    terms = {r.term for r in post.collect()}
    assert terms == {"player", "play", "game", "leagu", "fantasi", "stat"}


def test_strict_cast_fails_the_query(spark):
    df = spark.createDataFrame([("12",), ("x",)], "v string")
    with pytest.raises(Exception):
        df.select(strict_int("v")).collect()
    assert spark.createDataFrame([("12",)], "v string").select(strict_int("v").alias("x")).first().x == 12


def test_an_index_tokenizes_once_whatever_is_kept_of_it(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # shared shuffles are marked in the plan then
    try:
        idx = IX.inverted_index(IX.term_postings(_docs(spark, [(1, "a game of games")])), 3)
        for kept in (idx, idx.select("word", "block", "document_ids")):
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Generate posexplode") == 1 and "ReusedExchange" in plan, plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_term_frequency_sorts_no_postings(spark):
    docs = _docs(spark, [(3, "pear"), (1, "fig kiwi pear"), (2, "pear fig")])
    freq = IX.term_frequency(IX.term_postings(docs))
    assert "SortAggregate" not in freq._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.term, r.n, r.n_docs, tuple(r["first"])) for r in freq.collect()) == [("fig", 2, 2, (1, 0)), ("kiwi", 1, 1, (1, 1)), ("pear", 3, 3, (1, 2))]


def test_rules_skipped_on_texts_without_their_signs_change_nothing(spark):
    r = random.Random(2)
    bits = ["cannot", "Gonna", "gotta", "gimme", "lemme", "wanna", "cann", "ot", "'tis", "’twas", "'t", "’t", "is", "was", "don't", "it's", "'", "’", "‘", "''", ".", " ", " ", "\n", "word", "1,000", "a:b", "Été"]
    rows = [(k, "".join(r.choices(bits, k=r.randint(0, 8)))) for k in range(600)] + [(600, None)]
    c = F.lower(F.coalesce("text", F.lit("")))
    for rule, to in ((T.RE_TOK_CONTRACTIONS, T.TOK_CONTRACTIONS_REPL), (T.RE_TOK_TIS, "$1 $2"), (T.RE_TOK_SPACED, " "), (T.RE_TOK_COLON_COMMA, " $1"), (T.RE_TOK_TRAILING, "$1"), (T.RE_TOK_LEADING, "$1")):
        c = F.regexp_replace(c, rule, to)
    plain = F.array_remove(F.split(F.trim(c), T.RE_TOK_SPLIT), "")
    got = _docs(spark, rows).select(T.word_tokens("text").alias("a"), plain.alias("b")).collect()
    assert [x.a for x in got] == [x.b for x in got]
