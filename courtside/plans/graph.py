"""Link-graph questions over the driver tables.

Trade graph: a directed edge from the supplier's nation to the customer's
nation when their traded revenue is above the mean revenue of all
nation pairs (self-pairs excluded).  Vertices are all nations, so nations
without out-edges are dangling.  The page graph comes from ``pages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtside.functions import urls as U
from courtside.functions.cells import fixed
from courtside.operators.graph import hits, in_set_edges, out_degree, pagerank, pagerank_by_key
from courtside.sources.tables import pages, table

# Steps after which the oracle's unrolled iterations agree with the converged ranks to 6 decimals.
PAGERANK_STEPS = 100
HITS_STEPS = 120
PAGERANK_TOLERANCE = 1e-10
# Page ranks are about 1 / pages, so they are listed with more decimals and iterated until the doubles stand still.
PAGE_RANK_DECIMALS = 9
PAGE_RANK_TOLERANCE = 1e-15
PAGE_RANK_STEPS = 200


def trade_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src, dst, n_lines, revenue`` for every (supplier nation, customer nation).

    Lines meet their orders first (the one large join, on the order key),
    and are reduced to one row per (customer, supplier nation) before the
    customer join; the final aggregate has at most one row per nation pair.
    """
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_extendedprice")
    supp = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    # One row per (customer, supplier nation) before the customer join: a
    # customer with a huge share of the orders reaches the join as <= 25 rows.
    per_cust = (li.join(orders, li.l_orderkey == orders.o_orderkey)
                  .join(supp, li.l_suppkey == supp.s_suppkey)
                  .groupBy("o_custkey", "s_nationkey")
                  .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_extendedprice").alias("rev")))
    return (per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
                    .groupBy(F.col("s_nationkey").alias("src"), F.col("c_nationkey").alias("dst"))
                    .agg(F.sum("lines").alias("n_lines"), F.sum("rev").alias("revenue")))


def trade_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src, dst, revenue``: supplier nation -> customer nation, self-pairs excluded."""
    return trade_pairs(spark, sf_dir).where(F.col("src") != F.col("dst")).select("src", "dst", "revenue")


def trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges above the mean pair revenue.

    The mean is a window over the pairs (at most one row per nation pair), so
    the pipeline below them runs once.
    """
    rev = trade_revenue(spark, sf_dir).withColumn("mean", F.avg("revenue").over(Window.partitionBy(F.lit(0))))
    return rev.where(F.col("revenue") > F.col("mean")).select("src", "dst")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation", "n_nationkey", "n_name")


def out_degree_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-degree of every nation with out-edges."""
    return out_degree(trade_edges(spark, sf_dir))


def pagerank_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converged PageRank of the nations, 6 decimals."""
    v = _nations(spark, sf_dir).select(F.col("n_nationkey").alias("id"))
    r = pagerank(v, trade_edges(spark, sf_dir), tol=PAGERANK_TOLERANCE, max_iter=200)
    return r.select(F.col("id").alias("n_nationkey"), F.round("rank", 6).alias("rank"))


def pagerank_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converged PageRank listed as ``name : 0.xxx``."""
    v = _nations(spark, sf_dir).select(F.col("n_nationkey").alias("id"))
    r = pagerank(v, trade_edges(spark, sf_dir))
    names = _nations(spark, sf_dir)
    return (r.join(names, r.id == names.n_nationkey)
             .select(F.col("n_name").alias("node"), fixed("rank", 3).alias("rank_text"),
                     F.concat(F.col("n_name"), F.lit(" : "), fixed("rank", 3)).alias("line")))


def hits_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Converged hub and authority scores of the nations (I4)."""
    v = _nations(spark, sf_dir).select(F.col("n_nationkey").alias("id"))
    h = hits(v, trade_edges(spark, sf_dir))
    return h.select(F.col("id").alias("n_nationkey"), F.round("hub", 6).alias("hub"),
                    F.round("authority", 6).alias("authority"))


def page_out_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct resolved links per page: the page -> target bipartite graph."""
    pg = pages(spark, sf_dir)
    hrefs = pg.select("page_id", "url", F.explode(U.anchor_hrefs("html")).alias("href"))
    links = hrefs.select(F.col("page_id").alias("src"),
                         U.strip_trailing_slash(U.absolutize("href", "url")).alias("dst"))
    return out_degree(links)


def link_graph_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page graph edges between known nodes, nodes trimmed to their last segment.

    Known are all page URLs and the resolved targets (with and without their
    trailing slash) that two pages or more link to.  A link counts when its
    resolved target is known, is not the page itself, and after the trailing
    slash is removed still is a known node.
    """
    pg = pages(spark, sf_dir)
    hrefs = pg.select("url", F.explode(U.anchor_hrefs("html")).alias("href"))
    links = hrefs.select(F.col("url").alias("src"), U.absolutize("href", "url").alias("dst"))
    links = links.distinct()
    shared = links.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("dst")
    targets = shared.select(F.explode(F.array("dst", U.strip_trailing_slash("dst"))).alias("id"))
    known = pg.select(F.col("url").alias("id")).union(targets).distinct()
    edges = in_set_edges(links, known, "id")
    edges = in_set_edges(edges.select("src", U.strip_trailing_slash("dst").alias("dst")), known, "id")
    return edges.select(U.last_segment("src").alias("src_node"), U.last_segment("dst").alias("dst_node")).distinct()


def pagerank_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PageRank of the page graph, nodes named by their last path segment.

    Every page is a node, also without links; pages with the same last
    segment are one node, as are the targets inside the known set.
    """
    nodes = pages(spark, sf_dir).select(U.last_segment("url").alias("key"))
    edges = link_graph_in_set(spark, sf_dir).select(F.col("src_node").alias("src"), F.col("dst_node").alias("dst"))
    ranks = pagerank_by_key(nodes, edges, tol=PAGE_RANK_TOLERANCE, max_iter=PAGE_RANK_STEPS)
    return ranks.select(F.col("key").alias("node"), F.round("rank", PAGE_RANK_DECIMALS).alias("rank"), fixed("rank", 3).alias("rank_text"))
