"""The report files, each written and read back.

A query writes its files below the shared checkpoint folder, in a folder of
its own, and returns what a reader finds there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside import sinks
from courtside.plans import boxscore, text
from courtside.session import ensure_checkpoint_dir

TOP_ROWS = "rank {}, c_custkey long, c_name string, g1 double, g2 double, g3 double, avg_price string, n_games long"


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/courtside-exports/{uuid.uuid4().hex}"


def export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's last ten games and averages as one CSV (B1)."""
    path = _folder(spark)
    rows = boxscore.last10_avg_with_summary(spark, sf_dir)
    sinks.write_csv(rows, path)
    return sinks.read_csv(spark, path, ", ".join(f"{c} {t}" for c, t in rows.dtypes))


def export_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of the 15 most frequent terms, its rows in file order (B2)."""
    path = _folder(spark)
    sinks.export_inverted_index(text.inverted_index_top15(spark, sf_dir), path)
    found = sinks.read_in_order(spark, path, "`Word` string, `Block` long, `Document IDs` string")
    return found.select("position", F.col("Word").alias("word"), F.col("Block").alias("block"), F.col("Document IDs").alias("document_ids"))


def export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query-term counts per page, headed as written."""
    path = _folder(spark)
    sinks.export_term_counts(text.term_counts_wide(spark, sf_dir), path, terms=text.PAGE_TERMS)
    return sinks.read_csv(spark, path, ", ".join(["URL string", *(f"`{t}` int" for t in text.PAGE_TERMS)]))


def export_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers ranked and the first five, two sections under one folder."""
    path = _folder(spark)
    sinks.export_two_section_report(boxscore.ranked_avg_last_n(spark, sf_dir), boxscore.topk_avg_last_n(spark, sf_dir), path)
    parts = [sinks.read_csv(spark, f"{path}/{s}", TOP_ROWS.format("long")).withColumn("section", F.lit(s)) for s in ("all", "top")]
    return parts[0].unionByName(parts[1]).select("section", "rank", "c_custkey", "c_name", "avg_price", "n_games")


def export_per_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The all-pairs history, one folder per first team."""
    path = _folder(spark)
    rows = boxscore.all_pairs_h2h(spark, sf_dir)
    sinks.write_per_entity(rows, path, ["team1"])
    kinds = dict(rows.dtypes)
    return sinks.read_per_entity(spark, path, ", ".join(f"{c} {kinds[c]}" for c in [*(x for x in rows.columns if x != "team1"), "team1"])).select(*rows.columns)
