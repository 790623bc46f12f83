"""Query-term counts and TF-IDF weighting.

The query-term list is a parameter of bounded size, so per-document counts
are computed *inside* each document row: one ``size(filter(tokens, t = x))``
per term.  That gives the dense document x term grid (absent = 0) with no
shuffle and no cross join; the long form is an ``unpivot`` of it.  Corpus
statistics (document frequency, number of documents) are global aggregates
that combine partially on every task; the number of documents enters as a
scalar subquery.

Weights (not MLlib's IDF, which uses a natural log with +1 smoothing):
``tf = 1 + log10(n)`` for ``n > 0`` else 0; ``idf = log10(D / df)``,
undefined (null) when ``df = 0``; ``tfidf = tf * idf``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.text import whitespace_tokens
from courtside.operators.ranking import top_k


def term_counts_wide(docs: DataFrame, key_cols: list[str], text: Column,
                     terms: list[str]) -> DataFrame:
    """``key_cols`` + one count column per term, headed as written.

    Matching is on the lowercase token from ``str.split()``-style tokens
    (punctuation stays attached, so ``games,`` is not ``games``).
    """
    toks = F.lower(text)
    base = docs.select(*key_cols, whitespace_tokens(toks).alias("__cs_toks"))
    toks_col = F.col("__cs_toks")
    return base.select(*key_cols, *[
        (F.size(toks_col) - F.size(F.array_remove(toks_col, F.lit(t.lower())))).cast("int").alias(t)
        for t in terms])


def term_counts_long(wide: DataFrame, key_cols: list[str], terms: list[str]) -> DataFrame:
    """``key_cols, term, n``: the dense grid in long form."""
    return wide.unpivot(key_cols, terms, "term", "n")


def document_frequency(long: DataFrame) -> DataFrame:
    """``term, df``: documents with a positive count."""
    return long.groupBy("term").agg(F.count_if(F.col("n") > 0).alias("df"))


def n_documents(docs: DataFrame) -> Column:
    """Number of documents as a scalar subquery."""
    return docs.select(F.count(F.lit(1))).scalar()


def idf(df_table: DataFrame, n_docs: Column) -> DataFrame:
    """``term, df, idf`` with ``idf = log10(D / df)`` (H2)."""
    return df_table.select(
        "term", "df",
        F.when(F.col("df") > 0, F.log10(n_docs / F.col("df"))).alias("idf"))


def sublinear_tf(n: Column) -> Column:
    """``1 + log10(n)`` when ``n > 0``, else 0 (H1)."""
    return F.when(n > 0, F.lit(1.0) + F.log10(n)).otherwise(F.lit(0.0))


def tfidf(long: DataFrame, idf_table: DataFrame) -> DataFrame:
    """Long ``tf``/``idf``/``tfidf`` per (document, term) (H3).

    ``idf_table`` has one row per query term, so it is broadcast.
    """
    return (long.join(F.broadcast(idf_table), "term")
                .withColumn("tf", sublinear_tf(F.col("n")))
                .withColumn("tfidf", F.col("tf") * F.col("idf")))


def tfidf_matrix(weights: DataFrame, doc_col: str, docs: list, value_col: str = "tfidf") -> DataFrame:
    """Terms as rows, the listed documents as columns (H4).

    Only for a short, explicit document list (a report); the long form is the
    scalable representation.
    """
    return weights.groupBy("term").pivot(doc_col, docs).agg(F.first(value_col))


def tfidf_wide(weights: DataFrame, doc_cols: list[str], terms: list[str],
               value_col: str = "tfidf") -> DataFrame:
    """The document x term matrix with documents as rows, one column per term (H4).

    The transpose of the report's layout, which scales: the column count is
    the (bounded) query-term list, and the pivot values are given, so Spark
    runs no extra job to discover them.
    """
    return weights.groupBy(*doc_cols).pivot("term", terms).agg(F.first(value_col))


def search_top_k(weights: DataFrame, doc_cols: list[str], k: int = 10) -> DataFrame:
    """Rank documents by the sum of TF-IDF over the query terms (H5).

    Ties go to the smaller document key.
    """
    scores = weights.groupBy(*doc_cols).agg(F.sum("tfidf").alias("score"))
    return top_k(scores, k, [F.col("score").desc(), *[F.col(c).asc() for c in doc_cols]], "rank")
