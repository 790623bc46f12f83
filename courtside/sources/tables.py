"""Table scans over landed Parquet (A2, A3, A7 and the driver tables).

Scans name their columns so Catalyst prunes the Parquet read to them; filters
written after the scan are pushed into the reader by the optimizer.
"""

from __future__ import annotations

import os

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


#: Input rows per task of a step that sorts or expands them, whatever the size of the tables.
TASK_ROWS = 1 << 18


def row_bounded(df: DataFrame, task_rows: int = TASK_ROWS) -> int:
    """Partitions that give a task about ``task_rows`` rows of ``df``, and each core one.

    For scans: their row count comes from the file footers.  As a fixed number
    of ``repartition`` it is not merged by adaptive execution, which fills a
    task by shuffled bytes: a multiple of them once rows are sorted or expanded.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // task_rows))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet``; keep only ``columns`` when given."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def spread(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-spread the rows on ``key`` when the scan has fewer splits than the cluster has cores.

    Text operators spend most of their time in per-row regex work before the
    first shuffle; a table landed as one large file (or one row group) would
    otherwise be tokenized by a single task.  When the scan already has
    enough splits, as with any large table, the frame is returned unchanged
    and no shuffle is added.  Hash (not round-robin) partitioning keeps the
    placement deterministic under task retries and lets Spark reuse the
    exchange when two branches of a query read the same table.
    """
    spark = df.sparkSession
    try:
        want = min_partitions or spark.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except (PySparkAttributeError, PySparkNotImplementedError):  # no RDD view (a Spark Connect session): leave the scan as is
        return df
    # Spread on a hash of the key: the placement does not pre-satisfy later
    # (key, ...) groupings, so the plan keeps the shape it has on large input.
    return df if have >= want else df.repartition(want, F.xxhash64(key))


def text_table(spark: SparkSession, sf_dir: str, name: str, key: str, *columns: str) -> DataFrame:
    """``table`` for text-heavy scans, spread over the available cores on ``key``."""
    return spread(table(spark, sf_dir, name, *columns), key)


def pages(spark: SparkSession, sf_dir: str, keep_failed: bool = True) -> DataFrame:
    """``page_id, url, html`` (A2).

    A page whose body is missing contributes no terms but stays a document
    (``html`` becomes ``''``), like a fetch whose status was not 200.  With
    ``keep_failed=False`` such pages are dropped instead (A3 counts every page
    as it comes, so it is the default).
    """
    df = text_table(spark, sf_dir, "pages", "page_id", "page_id", "url", "html")
    df = df.withColumn("html", F.coalesce(F.col("html"), F.lit("")))
    return df if keep_failed else df.where(F.col("html") != "")


def seed_pages(seed: DataFrame, landed: DataFrame, url_col: str = "url", order_col: str = "html") -> DataFrame:
    """Seed documents with their landed HTML (A1, A2).

    Of several landed bodies of one URL the one with the largest ``order_col``
    counts (a landing time or page id; by default the body itself).

    ``seed``: ``doc_id, base_url, path`` (see ``params.seed_frame``);
    ``landed``: ``url, html``.  The full URL is ``join_url(base, path)``; a
    seed whose page is missing keeps its row with ``html = ''``, so it is
    still a document that contributes no terms.
    """
    from courtside.functions.urls import join_url
    docs = seed.select("doc_id", join_url("base_url", "path").alias("url"))
    pages_ = landed.groupBy(F.col(url_col).alias("url")).agg(F.max_by("html", order_col).alias("html"))
    return (docs.join(pages_, "url", "left")
                .select("doc_id", "url", F.coalesce("html", F.lit("")).alias("html")))
