"""Ranked keyword search over impact-ordered posting blocks (H5).

The score of a document for a query is the sum of ``(1 + log10 tf) * idf`` over
the query's distinct terms, as ``tfidf`` defines it.  Scoring every posting of
every query term is what this module avoids:

* ``by_range`` deals the documents by document range before they are read, so
  one shuffle of the texts is all that an index needs: a range's postings are
  counted, cut into blocks and written where its documents are.
* ``impact_blocks`` cuts each term's postings by impact tier (term frequency,
  then powers of two of it) and document range.  A block knows the least and
  greatest frequency in it, so its impact bounds are known from a narrow scan
  that leaves the postings column unread.  A block holds at most
  ``docs_per_block`` postings, also of a term that occurs in every document.
* A search reads the blocks of the terms that are asked for; no step moves the
  others.
* Per query a threshold, below which no document can be among the first
  ``k``, comes from block counts alone (a term's ``k``-th impact) and from
  scoring the document ranges with the highest bounds.
* A block can matter only if its bound and the best bounds of the query's
  other terms in the same range reach the threshold together.  Whoever
  reaches it has all its postings in such blocks.
* The terms of least impact that do not reach the threshold even together
  (mostly the frequent ones) name no document.  The other terms are added up
  first; the ``k``-th of these sums may raise the threshold, and only
  documents that can still reach it are looked up in the frequent terms,
  whose blocks in other ranges stay unread.

The result equals full scoring.  Many queries run at once; a query is rows of
``query_id, term``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.operators.tfidf import sublinear_tf
from courtside.session import ensure_checkpoint_dir

#: Documents of one range; bounds the postings of a block.
DOCS_PER_BLOCK = 1024
#: Frequencies up to this one are a tier each.
EXACT_TIERS = 8
#: Document ranges per query that are scored for the threshold.
FIRST_RANGES = 2
#: Bounds are sums of doubles in any order: they count as reached when they miss by this (share, and amount).
SLACK = 1e-9
#: Scores are compared at this many decimals; sums of doubles depend on their order beyond.
SCORE_DECIMALS = 9


def tier(tf: Column) -> Column:
    """Impact tier: the frequency itself, then its powers of two; higher is better."""
    return F.when(tf <= EXACT_TIERS, tf).otherwise(EXACT_TIERS + 1 + F.floor(F.log2(tf / F.lit(EXACT_TIERS + 1)))).cast("int")


def document_range(doc_id: Column, docs_per_block: int = DOCS_PER_BLOCK) -> Column:
    """The range of ``docs_per_block`` ids that a document falls in."""
    return F.floor(doc_id / F.lit(docs_per_block)).cast("long")


def by_range(docs: DataFrame, id_col: str = "doc_id", docs_per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """``docs`` with their ``range``, those of one range together; the ones without an id, which no index holds, stay out."""
    return docs.where(F.col(id_col).isNotNull()).withColumn("range", document_range(F.col(id_col), docs_per_block)).repartition("range")


def impact_blocks(postings: DataFrame, docs_per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """``term, tier, range, min_tf, max_tf, n, postings`` of ``term, doc_id, tf`` rows.

    ``postings`` are ``(doc_id, tf)`` by document within a block.  Rows that
    come with the ``range`` of ``by_range`` are grouped where they are.
    """
    span = F.col("range") if "range" in postings.columns else document_range(F.col("doc_id"), docs_per_block)
    return postings.groupBy("term", tier(F.col("tf")).alias("tier"), span.alias("range")).agg(
        F.min("tf").alias("min_tf"), F.max("tf").alias("max_tf"), F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings"))


def write_impact_index(blocks: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The blocks by whole ranges, within a file sorted by term, best impacts first; a frequent term spreads over the files."""
    blocks.repartition("range").sortWithinPartitions("term", F.desc("tier"), "range").write.mode(mode).parquet(path)


def _asked(index: DataFrame, queries: DataFrame) -> DataFrame:
    """The index's blocks of the queries' terms."""
    return index.join(queries.select("term").distinct(), "term", "left_semi")


def _bounds(index: DataFrame, queries: DataFrame, n_docs: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of the queries' terms with impact bounds, and the terms' idf; the postings are not read, the rest once."""
    ensure_checkpoint_dir(index.sparkSession)
    meta = _asked(index.select("term", "tier", "range", "min_tf", "max_tf", "n"), queries).checkpoint()
    idf = meta.groupBy("term").agg(F.log10(F.lit(float(n_docs)) / F.sum("n")).alias("idf"))
    blocks = meta.join(idf, "term").select("term", "tier", "range", "n", (sublinear_tf(F.col("min_tf")) * F.col("idf")).alias("low"),
                                           (sublinear_tf(F.col("max_tf")) * F.col("idf")).alias("high"))
    return blocks, idf


def _impacts(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """``query_id, range, doc_id, w`` of all postings in the ``wanted`` blocks (rows of ``query_id, term, tier, range, idf``)."""
    read = wanted.select("query_id", "term", "tier", "range", "idf").join(index.select("term", "tier", "range", "postings"), ["term", "tier", "range"])
    each = read.select("query_id", "range", "idf", F.explode("postings").alias("p"))
    return each.select("query_id", "range", "p.doc_id", (sublinear_tf(F.col("p.tf")) * F.col("idf")).alias("w"))


def _sums(impacts: DataFrame) -> DataFrame:
    return impacts.groupBy("query_id", "range", "doc_id").agg(F.sum("w").alias("score"))


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.round("score", SCORE_DECIMALS).desc(), "doc_id")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _kth(scores: DataFrame, k: int, name: str) -> DataFrame:
    return _ranked(scores, k).where(F.col("rank") == k).select("query_id", F.col("score").alias(name))


def block_plan(index: DataFrame, queries: DataFrame, n_docs: int, k: int, first_ranges: int = FIRST_RANGES) -> DataFrame:
    """Every block of a query's terms: ``query_id, term, tier, range, n, idf, top, bound, threshold, needed, naming``.

    ``top``: the term's best impact in the range; ``needed``: the block's
    ``bound`` reaches the threshold; ``naming``: the term is one of those that
    name documents.
    """
    q = queries.select("query_id", "term").distinct()
    blocks, idf = _bounds(index, q, n_docs)
    index = _asked(index, q)
    per_query = q.join(blocks, "term").join(idf, "term")
    best = per_query.groupBy("query_id", "range", "term").agg(F.max("high").alias("top"))
    ranges = best.groupBy("query_id", "range").agg(F.sum("top").alias("most"))
    # A term's k-th impact: the least one of the tier where the counts from the top reach k.
    tiers = blocks.groupBy("term", "tier").agg(F.sum("n").alias("n"), F.min("low").alias("low"))
    down = Window.partitionBy("term").orderBy(F.desc("tier"))
    kth = tiers.withColumn("seen", F.sum("n").over(down)).where(F.col("seen") >= k).groupBy("term").agg(F.max("low").alias("low"))
    by_counts = q.join(kth, "term").groupBy("query_id").agg(F.max("low").alias("by_counts"))
    # Full scores of the most promising ranges; their k-th best is a threshold too.
    order = Window.partitionBy("query_id").orderBy(F.desc("most"), "range")
    first = ranges.withColumn("at", F.row_number().over(order)).where(F.col("at") <= first_ranges).select("query_id", "range")
    by_scores = _kth(_sums(_impacts(index, per_query.join(first, ["query_id", "range"]))), k, "by_scores")
    threshold = F.coalesce(F.greatest("by_counts", "by_scores"), F.lit(0.0)) * F.lit(1 - SLACK)
    # Terms by rising best impact; those whose impacts up to and with their own stay below the threshold name no document.
    terms = best.groupBy("query_id", "term").agg(F.max("top").alias("best"))
    up = Window.partitionBy("query_id").orderBy("best", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    terms = (terms.withColumn("together", F.sum("best").over(up)).join(by_counts, "query_id", "left").join(by_scores, "query_id", "left")
             .select("query_id", "term", threshold.alias("threshold"), (F.col("together") >= threshold).alias("naming")))
    bound = F.col("high") + F.col("most") - F.col("top")
    return (per_query.join(best, ["query_id", "range", "term"]).join(ranges, ["query_id", "range"]).join(terms, ["query_id", "term"])
            .select("query_id", "term", "tier", "range", "n", "idf", "top", bound.alias("bound"), "threshold",
                    (bound + F.lit(SLACK) >= F.col("threshold")).alias("needed"), "naming"))


def search_with_blocks(index: DataFrame, queries: DataFrame, n_docs: int, k: int = 10, first_ranges: int = FIRST_RANGES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The result of ``search``, the block plan, and the rows of it that were read."""
    ensure_checkpoint_dir(index.sparkSession)
    plan = block_plan(index, queries, n_docs, k, first_ranges).checkpoint()
    index = _asked(index, queries)
    needed = plan.where("needed")
    named = needed.where("naming")
    found = _sums(_impacts(index, named)).checkpoint()
    # What the looked-up terms can still add in a document's range.
    rest = needed.where("NOT naming").groupBy("query_id", "range", "term").agg(F.max("top").alias("top")).groupBy("query_id", "range").agg(F.sum("top").alias("rest"))
    least = plan.groupBy("query_id").agg(F.max("threshold").alias("threshold")).join(_kth(found, k, "partial"), "query_id", "left")
    least = least.select("query_id", F.greatest("threshold", F.col("partial") * F.lit(1 - SLACK)).alias("least"))
    open_ = found.join(rest, ["query_id", "range"], "left").join(least, "query_id")
    open_ = open_.where(F.col("score") + F.coalesce("rest", F.lit(0.0)) + F.lit(SLACK) >= F.col("least")).select("query_id", "range", "doc_id", "score").checkpoint()
    looked_up = needed.where("NOT naming").join(open_.select("query_id", "range").distinct(), ["query_id", "range"], "left_semi")
    more = _impacts(index, looked_up).join(open_.select("query_id", "range", "doc_id"), ["query_id", "range", "doc_id"], "left_semi")
    scores = _sums(more.union(open_.select("query_id", "range", "doc_id", "score")))
    read = named.unionByName(looked_up.select(*named.columns))
    return _ranked(scores, k).select("query_id", "rank", "doc_id", "score"), plan, read


def search(index: DataFrame, queries: DataFrame, n_docs: int, k: int = 10, first_ranges: int = FIRST_RANGES) -> DataFrame:
    """``query_id, rank, doc_id, score``: the first ``k`` documents of each query, ties by document.

    ``index`` is a table of ``impact_blocks``, best read from a file: the
    plan reads its narrow columns first and then the needed blocks only.
    Terms that occur nowhere add nothing; a query without any known term has
    no rows.
    """
    return search_with_blocks(index, queries, n_docs, k, first_ranges)[0]
