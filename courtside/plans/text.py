"""Web-text and index questions over the driver tables.

``pages`` (raw HTML) feeds text extraction, links and the query-term counts
behind TF-IDF; ``documents`` feeds the inverted index; ``labels`` holds the
relevance judgements.  Every function takes ``(spark, sf_dir)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions import urls as U
from courtside.functions.text import html_raw_text, html_to_text
from courtside.operators import index as IX
from courtside.operators import tfidf as TF
from courtside.operators.evaluate import precision_recall_by_query
from courtside.sources.tables import pages, table, text_table

# Parameters of the term-count / TF-IDF report on ``pages``: six terms with
# spread-out document frequencies in this corpus, reported as written.
PAGE_TERMS = ["The", "Of", "De", "Der", "Und", "Et"]
TOP_K_TERMS = 15
SEARCH_K = 10
PREFIX = "https://www.example.com"


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of each page, one space between text nodes."""
    return pages(spark, sf_dir).select("page_id", html_to_text("html").alias("text"))


def page_raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text nodes glued without separator."""
    return pages(spark, sf_dir).select("page_id", html_raw_text("html").alias("raw_text"))


def _hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select(
        "page_id", "url", F.explode(U.anchor_hrefs("html")).alias("href"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct anchor hrefs per page."""
    return _hrefs(spark, sf_dir).select("page_id", "href").distinct()


def page_links_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hrefs resolved against the page URL, trailing slashes removed."""
    h = _hrefs(spark, sf_dir)
    return h.select("page_id", U.strip_trailing_slash(U.absolutize("href", "url")).alias("link")).distinct()


def link_last_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node id of each resolved link: its last path segment (C14)."""
    links = page_links_absolute(spark, sf_dir)
    return links.select("page_id", "link", U.last_segment("link").alias("node"))


def page_url_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL rules on every page's URL.

    ``seed_url``: the page's last path segment joined to its own base;
    ``player_id``: the number after the language, read as a player page;
    ``prefixed``: the path, or for every third page the whole URL, given a base.
    """
    pg = table(spark, sf_dir, "pages", "page_id", "url")
    base = F.regexp_extract("url", r"^(.*/)[^/]*$", 1)
    rest = F.regexp_extract("url", r"^.*/([^/]*)$", 1)
    path = F.regexp_extract("url", r"^[a-z]+://[^/]+(/.*)$", 1)
    player = F.regexp_replace("url", r"/[a-z]{2}/(\d+)", "/player/$1/")
    return pg.select("page_id", U.join_url(base, rest).alias("seed_url"), U.player_id(player).alias("player_id"),
                     U.prefix_if_relative(F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(path), PREFIX).alias("prefixed"))


def _doc_postings(spark: SparkSession, sf_dir: str, stemmed: bool = False,
                  lang: str | None = None, profile: str = "v2") -> DataFrame:
    if lang is None:
        docs = text_table(spark, sf_dir, "documents", "doc_id", "doc_id", "text")
    else:
        docs = text_table(spark, sf_dir, "documents", "doc_id", "doc_id", "text", "lang") \
            .where(F.col("lang") == lang).select("doc_id", "text")
    return IX.term_postings(docs, "doc_id", "text", profile=profile, stemmed=stemmed)


def tokens_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``term, doc_id, tf, first_pos`` after tokenizing and filtering."""
    return _doc_postings(spark, sf_dir)


def tokens_clean_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``tokens_clean`` with the earlier filter profile: digits may stay inside a term."""
    return _doc_postings(spark, sf_dir, profile="v1")


def top15_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 most frequent terms; ties by first encounter."""
    return IX.top_terms(_doc_postings(spark, sf_dir), TOP_K_TERMS)


def top15_terms_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-15 terms of the English documents, the language of the stop list."""
    return IX.top_terms(_doc_postings(spark, sf_dir, lang="en"), TOP_K_TERMS)


def inverted_index_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings of the 15 most frequent terms as sorted id strings."""
    return IX.inverted_index(_doc_postings(spark, sf_dir), TOP_K_TERMS)


def inverted_index_stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``inverted_index_top15`` with Porter stems as terms."""
    return IX.inverted_index(_doc_postings(spark, sf_dir, stemmed=True), TOP_K_TERMS)


def inverted_index_stemmed_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stemmed top-15 index of the English documents: the reference's index query."""
    return IX.inverted_index(_doc_postings(spark, sf_dir, stemmed=True, lang="en"), TOP_K_TERMS)


def _page_counts_wide(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    """Per-page counts; ``shared`` ones are hash-exchanged on ``page_id`` right after tokenizing.

    The counts are a few integers per page; the explicit exchange is cheap
    and is the point where the TF-IDF branches (document frequency and the
    per-page weights) share one tokenization pass through exchange reuse.
    Adaptive execution sizes it.  A query with one branch needs none.
    """
    pg = pages(spark, sf_dir)
    wide = TF.term_counts_wide(pg, ["page_id", "url"], html_raw_text("html"), PAGE_TERMS)
    return wide.repartition("page_id") if shared else wide


def term_counts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url`` + one count per query term."""
    return _page_counts_wide(spark, sf_dir)


def _page_counts_long(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    return TF.term_counts_long(_page_counts_wide(spark, sf_dir, shared), ["page_id", "url"], PAGE_TERMS) \
        .drop("url")


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``term, df`` over all pages."""
    return TF.document_frequency(_page_counts_long(spark, sf_dir))


def _idf_table(spark: SparkSession, sf_dir: str, shared: bool = False) -> DataFrame:
    n_docs = TF.n_documents(table(spark, sf_dir, "pages", "page_id"))
    return TF.idf(TF.document_frequency(_page_counts_long(spark, sf_dir, shared)), n_docs)


def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``term, df, idf`` with ``idf = log10(D/df)`` (H2)."""
    return _idf_table(spark, sf_dir).select("term", "df", F.round("idf", 6).alias("idf"))


def tf_sublinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, term, n, tf`` with ``tf = 1 + log10(n)`` (H1)."""
    long = _page_counts_long(spark, sf_dir)
    return long.select("page_id", "term", "n", F.round(TF.sublinear_tf(F.col("n")), 6).alias("tf"))


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TF.tfidf(_page_counts_long(spark, sf_dir, shared=True), _idf_table(spark, sf_dir, shared=True))


def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long TF-IDF grid over pages x query terms (H3, H4 long form)."""
    return _weights(spark, sf_dir).select(
        "page_id", "term", "n", F.round("tf", 6).alias("tf"), F.round("idf", 6).alias("idf"),
        F.round("tfidf", 6).alias("tfidf"))


def tfidf_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF matrix: one row per page, one column per query term (H4)."""
    w = _weights(spark, sf_dir).withColumn("tfidf", F.round("tfidf", 6))
    return TF.tfidf_wide(w, ["page_id"], PAGE_TERMS)


def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages ranked by summed TF-IDF of the query terms, top 10 (H5)."""
    w = _weights(spark, sf_dir).where(F.col("idf").isNotNull())
    return TF.search_top_k(w, ["page_id"], SEARCH_K).select(
        "rank", "page_id", F.round("score", 6).alias("score"))


def precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall of each top term as a query, judged by ``labels``.

    A document is retrieved by a term when it contains it; it is relevant when
    its label has ``quality = 1``.  Only judged documents count.
    """
    post = _doc_postings(spark, sf_dir)
    top = IX.top_terms(post, TOP_K_TERMS)
    retrieved = IX.top_postings(post, top).select(F.col("term").alias("query"), "doc_id")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    judged = labels.select("doc_id", (F.col("quality") == 1).alias("relevant"))
    return precision_recall_by_query(top.select(F.col("term").alias("query")), retrieved, judged)
