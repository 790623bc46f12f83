"""Ranked and conjunctive search, and the block matrix of all terms."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions.text import decode_entities, whitespace_tokens, without_markup
from courtside.operators.compressed import compress, conjunction
from courtside.operators.dictionary import dense_ids
from courtside.operators.index import term_filter, term_postings, tokens
from courtside.operators.matrix import all_term_weights, from_blocks, to_blocks
from courtside.operators.search import by_range, impact_blocks, search, write_impact_index
from courtside.session import ensure_checkpoint_dir
from courtside.sources.tables import pages, table, text_table

SEARCH_K = 10


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/courtside-index/{uuid.uuid4().hex}"


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_postings(text_table(spark, sf_dir, "documents", "doc_id", "doc_id", "text"))


def document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The impact index of ``documents``, written once below the shared checkpoint folder and read back."""
    path = _folder(spark)
    docs = by_range(table(spark, sf_dir, "documents", "doc_id", "text"))
    write_impact_index(impact_blocks(term_postings(docs, kept=("range",))), path)
    return spark.read.parquet(path)


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``query_id, term``: the distinct index terms of every benchmark item, one query each."""
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    found = tokens(items, "item_id").where(term_filter("term"))
    return found.select(F.col("doc_id").alias("query_id"), "term").distinct()


def search_topk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item as a query, all at once (H5)."""
    n_docs = table(spark, sf_dir, "documents", "doc_id").where(F.col("doc_id").isNotNull()).count()
    found = search(document_index(spark, sf_dir), benchmark_queries(spark, sf_dir), n_docs, SEARCH_K)
    return found.select(F.col("query_id").alias("item_id"), "rank", "doc_id", F.round("score", 6).alias("score"))


def conjunctive_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold both the first and the last term (by spelling) of a benchmark item, from compressed postings."""
    path = _folder(spark)
    compress(_postings(spark, sf_dir)).repartitionByRange("term", "block").sortWithinPartitions("term", "block").write.parquet(path)
    asked = benchmark_queries(spark, sf_dir).groupBy("query_id").agg(F.array(F.min("term"), F.max("term")).alias("terms"))
    return conjunction(spark.read.parquet(path), asked).select(F.col("query_id").alias("item_id"), "doc_id")


def _page_blocks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The block matrix of TF-IDF weights of all terms of all pages, and the terms' dictionary."""
    # Pages are dealt before they are read, so their terms are counted where they are.
    pg = pages(spark, sf_dir).select("page_id", "html").repartition("page_id").select("page_id", without_markup("html").alias("raw"))
    found = pg.select("page_id", F.explode(whitespace_tokens(F.lower(decode_entities(F.col("raw"))))).alias("term"))
    postings = found.groupBy("term", "page_id").agg(F.count(F.lit(1)).alias("n"))
    path = _folder(spark)
    postings.write.parquet(path)  # the dictionary and the weights both start here
    postings = spark.read.parquet(path)
    ids = dense_ids(postings, "term", count_col="df")
    n_docs = table(spark, sf_dir, "pages", "page_id").count()
    return to_blocks(all_term_weights(postings, n_docs, ids), ids), ids


def tfidf_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of the term x page matrix of all terms: their place, cells and sum of weights (H4)."""
    blocks, _ = _page_blocks(spark, sf_dir)
    total = F.aggregate("cells", F.lit(0.0), lambda a, c: a + c["value"])
    return blocks.select("term_block", "page_block", F.size("cells").cast("long").alias("n_cells"),
                         F.element_at("cells", 1)["term_id"].alias("first_term_id"), F.round(total, 4).alias("weight"))


def tfidf_all_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long form of the block matrix: TF-IDF of every term in every page that has it (H1-H4)."""
    blocks, ids = _page_blocks(spark, sf_dir)
    return from_blocks(blocks, ids).select("term", "page_id", F.round("value", 6).alias("tfidf"))
