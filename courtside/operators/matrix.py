"""Term x page weights as a block-sparse matrix (H4).

The report's layout has a column per page, which no corpus-sized table can
have.  Here a row of the table is one block: a run of term ids by a run of
page ids with its non-zero cells, so the width never depends on the corpus
and a block's size is bounded by ``BLOCK_SIDE`` squared, also for a term that
occurs in every page.  Term ids are dense and in term order, so blocks of one
term run are neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.operators.tfidf import sublinear_tf

#: Terms, and page ids, of one block.
BLOCK_SIDE = 256


def all_term_weights(postings: DataFrame, n_docs: int, ids: DataFrame | None = None) -> DataFrame:
    """``term, page_id, n, tfidf`` for every term of ``term, page_id, n`` postings (H1-H3 without a query list).

    With the terms' dictionary (``key, id, df``) the postings meet it once,
    for the frequencies and for the ``term_id`` that the rows then have too.
    A term is there once, so the dictionary is hashed and no posting sorted.
    """
    if ids is None:
        terms = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    else:
        terms = ids.select(F.col("key").alias("term"), F.col("id").alias("term_id"), "df")
    idf = terms.select(*[c for c in terms.columns if c != "df"], F.log10(F.lit(float(n_docs)) / F.col("df")).alias("idf"))
    found = postings.join(idf.hint("shuffle_hash"), "term")
    return found.select("term", "page_id", "n", (sublinear_tf(F.col("n")) * F.col("idf")).alias("tfidf"), *([] if ids is None else ["term_id"]))


def to_blocks(weights: DataFrame, ids: DataFrame, value_col: str = "tfidf", side: int = BLOCK_SIDE) -> DataFrame:
    """``term_block, page_block, cells`` with ``cells`` an array of (term_id, page_id, value) by term, then page.

    ``ids`` is the terms' dictionary (``key, id``); weights with a ``term_id`` have met it.
    """
    if "term_id" not in weights.columns:
        weights = weights.join(ids.select(F.col("key").alias("term"), F.col("id").alias("term_id")).hint("shuffle_hash"), "term")
    cells = weights.select("term_id", "page_id", F.col(value_col).alias("value"))
    return cells.groupBy(F.floor(F.col("term_id") / side).cast("long").alias("term_block"), F.floor(F.col("page_id") / side).cast("long").alias("page_block")).agg(
        F.sort_array(F.collect_list(F.struct("term_id", "page_id", "value"))).alias("cells"))


def from_blocks(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """The long form ``term, page_id, value`` of a block matrix."""
    terms = ids.select(F.col("key").alias("term"), F.col("id").alias("__cs_id"))
    cells = blocks.select(F.explode("cells").alias("c")).select("c.term_id", "c.page_id", "c.value")
    return cells.join(terms.hint("shuffle_hash"), F.col("term_id") == F.col("__cs_id")).select("term", "page_id", "value")


def transpose(blocks: DataFrame) -> DataFrame:
    """Pages as rows: blocks turn in place, cells inside are sorted by page, then term; no shuffle."""
    turned = F.sort_array(F.transform("cells", lambda c: F.struct(c["page_id"].alias("page_id"), c["term_id"].alias("term_id"), c["value"].alias("value"))))
    return blocks.select(F.col("page_block"), F.col("term_block"), turned.alias("cells"))


def times_vector(blocks: DataFrame, vector: DataFrame, side: int = BLOCK_SIDE) -> DataFrame:
    """``page_id, value``: the page scores of a sparse term vector (``term_id, weight``).

    The vector is cut like the terms, so each block meets its own piece, a
    map of at most ``side`` weights, and sends one sum per page on.
    """
    pieces = vector.groupBy(F.floor(F.col("term_id") / side).cast("long").alias("term_block")).agg(
        F.map_from_entries(F.collect_list(F.struct("term_id", "weight"))).alias("piece"))
    met = blocks.join(pieces, "term_block").select(F.explode(F.filter("cells", lambda c: F.map_contains_key("piece", c["term_id"]))).alias("c"), "piece")
    return met.groupBy(F.col("c.page_id").alias("page_id")).agg(F.sum(F.col("c.value") * F.element_at("piece", F.col("c.term_id"))).alias("value"))
