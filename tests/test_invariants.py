"""Invariants on the driver tables (sf0.001): the properties SURVEY §5 lists."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_CHECK, SF_SMALL


def q(spark, name):
    return E.queries()[name](spark, SF_SMALL)


def test_pagerank_and_hits_sum_to_one(spark):
    for name, cols in (("pagerank_trade", ["rank"]), ("hits_trade", ["hub", "authority"])):
        row = q(spark, name).select(*[F.sum(c).alias(c) for c in cols]).first()
        for c in cols:
            assert abs(row[c] - 1.0) < 1e-4, (name, c, row[c])


def test_posting_size_equals_document_frequency(spark):
    top = {r.term: r.n_docs for r in q(spark, "top15_terms").collect()}
    idx = q(spark, "inverted_index_top15").groupBy("word").agg(F.sum("n_docs").alias("n")).collect()
    assert {r.word: r.n for r in idx} == top
    for r in q(spark, "inverted_index_top15").collect():
        assert len(r.document_ids.split(", ")) == r.n_docs


def test_tfidf_non_negative_and_idf_bounds(spark):
    t = q(spark, "tfidf")
    assert t.where("tfidf < 0 OR tf < 0").count() == 0
    n_pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()
    for r in q(spark, "document_frequency").collect():
        assert 0 <= r.df <= n_pages


def test_zip_not_longer_than_the_shorter_side(spark):
    h = q(spark, "head_to_head_recent5").collect()
    assert len(h) <= 5
    assert [r.rank for r in sorted(h, key=lambda r: r.rank)] == list(range(1, len(h) + 1))
    seasons = [(r.season, r.pos) for r in sorted(h, key=lambda r: r.rank)]
    assert seasons == sorted(seasons, key=lambda x: (-x[0], x[1]))


def test_ranking_is_a_permutation_and_topk_is_its_head(spark):
    ranked = q(spark, "ranked_avg_last_n")
    n = ranked.count()
    assert sorted(r.rank for r in ranked.select("rank").collect()) == list(range(1, n + 1))
    top = {r.rank: r.c_custkey for r in q(spark, "topk_avg_last_n").collect()}
    head = {r.rank: r.c_custkey for r in ranked.where("rank <= 5").collect()}
    assert top == head


def test_summary_rows_cover_every_customer(spark):
    s = q(spark, "last10_avg_with_summary")
    n_cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert s.where("game = 'Averages'").count() == n_cust
    assert s.where("game <> 'Averages'").groupBy("c_custkey").count().where("count > 10").count() == 0


def test_every_request_status_occurs(spark):
    got = {r.status: r.n for r in q(spark, "matchup_validation").groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert set(got) == {"ok", "same_team", "unknown_team"}


def test_the_page_graph_has_edges_and_rows_are_cut_short(spark):
    assert E.queries()["link_graph_in_set"](spark, SF_CHECK).count() > 0
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert q(spark, "cells_guarded_cast").agg(F.sum("n_rows")).first()[0] < events
