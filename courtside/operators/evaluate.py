"""Retrieval evaluation: precision and recall per query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def precision_recall_by_query(queries: DataFrame, retrieved: DataFrame,
                              judged: DataFrame) -> DataFrame:
    """``query, n_retrieved, n_relevant_retrieved, n_relevant, precision, recall``.

    ``retrieved``: ``query, doc_id``; ``judged``: ``doc_id, relevant``.  Only
    judged documents are counted.  The number of relevant documents is one
    scalar for all queries (a scalar subquery, not a join).
    """
    n_rel = judged.where("relevant").select(F.count(F.lit(1))).scalar()
    hits = (retrieved.join(judged, "doc_id")
                     .groupBy("query")
                     .agg(F.count(F.lit(1)).alias("n_retrieved"),
                          F.count_if("relevant").alias("n_relevant_retrieved")))
    out = queries.join(hits, "query", "left").select(
        "query",
        F.coalesce("n_retrieved", F.lit(0)).alias("n_retrieved"),
        F.coalesce("n_relevant_retrieved", F.lit(0)).alias("n_relevant_retrieved"))
    return out.select(
        "*", n_rel.alias("n_relevant"),
        F.round(F.when(F.col("n_retrieved") > 0,
                       F.col("n_relevant_retrieved") / F.col("n_retrieved")), 6).alias("precision"),
        F.round(F.when(n_rel > 0, F.col("n_relevant_retrieved") / n_rel), 6).alias("recall"))
