"""Writers (B1-B6): CSV with header, index/count exports, two-part reports.

All writers are distributed: they write one part file per task and never
funnel the data through the driver or a single task.  Row order in the
output follows a global sort where the report has an order.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions.cells import fixed
from courtside.operators.ranking import global_row_number


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 CSV with a header row, replacing the target (B1)."""
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def export_inverted_index(index: DataFrame, path: str) -> None:
    """``Word, Block, Document IDs`` rows in frequency order (B2); a word's long id list comes in numbered blocks."""
    out = index.orderBy("rank", "block").select(
        F.col("word").alias("Word"), F.col("block").alias("Block"), F.col("document_ids").alias("Document IDs"))
    write_csv(out, path)


def export_term_counts(wide: DataFrame, path: str, url_col: str = "url",
                       terms: list[str] | None = None) -> None:
    """``URL`` + one column per query term, header as written."""
    terms = terms or [c for c in wide.columns if c not in (url_col, "page_id")]
    write_csv(wide.select(F.col(url_col).alias("URL"), *terms), path)


def export_two_section_report(all_rows: DataFrame, top_rows: DataFrame, path: str, avg_cols: tuple[str, ...] = ("avg_price",)) -> None:
    """A ranked listing and its top-k as two datasets under one folder.

    One CSV cannot hold two schemas; ``<path>/all`` and ``<path>/top`` keep
    the reference's two sections apart.  Averages are written with two decimals.
    """
    for rows, section in ((all_rows, "all"), (top_rows, "top")):
        shown = rows.withColumns({c: fixed(c, 2) for c in avg_cols if c in rows.columns})
        write_csv(shown, os.path.join(path, section))


def rank_lines(ranks: DataFrame, id_col: str = "id", rank_col: str = "rank") -> DataFrame:
    """``id : 0.xxx`` text lines."""
    return ranks.select(F.concat(F.col(id_col).cast("string"), F.lit(" : "),
                                 fixed(rank_col, 3)).alias("line"))


def write_per_entity(df: DataFrame, path: str, entity_cols: list[str], keep_others: bool = False) -> None:
    """One folder per entity, all written by one job.

    The rows of an entity are brought together first, so a folder gets one
    file unless its rows are split for size.  The target is replaced when the
    job commits; with ``keep_others`` only the folders of entities in ``df``
    are, each as a whole, and a failed job replaces none.
    """
    w = df.repartition(*entity_cols).write.mode("overwrite").option("header", True).partitionBy(*entity_cols)
    w.option("partitionOverwriteMode", "dynamic" if keep_others else "static").csv(path)


def read_per_entity(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of ``write_per_entity``; ``schema`` has the file columns, then the entity columns."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a CSV written here, with the given column types (a header that does not fit is an error)."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def read_in_order(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As ``read_csv`` with ``position`` from 1: files by part number, rows as they stand in a file."""
    rows = read_csv(spark, path, schema)
    names = rows.columns
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    placed = rows.select(*names, part.alias("__cs_part"), F.col("_metadata.file_block_start").alias("__cs_start"), F.monotonically_increasing_id().alias("__cs_row"))
    order = [F.col(c) for c in ("__cs_part", "__cs_start", "__cs_row")]
    return global_row_number(placed, order, "position").select("position", *names)
