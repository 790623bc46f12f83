"""Last-N rows per entity and their summaries.

A Spark table has no page order, so "last N" always names its order key.
``row_number() <= N`` over a per-entity window is planned as a
WindowGroupLimit: a partial limit runs before the shuffle, so even an entity
holding a third of all rows sends at most N rows per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.functions.cells import half_even


def last_n(df: DataFrame, entity_cols: list[str], order_by: list[Column], n: int,
           rn_col: str = "rn") -> DataFrame:
    """The first ``n`` rows per entity in ``order_by`` with their position (F2).

    The limit is taken before any validity filter: a bad row among the first
    ``n`` is dropped later, not replaced by an older row.
    """
    w = Window.partitionBy(*entity_cols).orderBy(*order_by)
    return df.withColumn(rn_col, F.row_number().over(w)).where(F.col(rn_col) <= n)


def mean_or_zero(entities: DataFrame, rows: DataFrame, entity_cols: list[str],
                 measures: dict[str, str]) -> DataFrame:
    """Per-entity mean of each measure over ``rows``; 0 when none (E5).

    ``measures`` maps output name -> input column.  Entities come from
    ``entities`` (left join), so an entity without rows still gets a row.
    """
    agg = rows.groupBy(*entity_cols).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(src).alias(out) for out, src in measures.items()])
    out = entities.join(agg, entity_cols, "left")
    return out.select(
        *entities.columns,
        F.coalesce(F.col("n_rows"), F.lit(0)).alias("n_rows"),
        *[F.coalesce(F.col(o), F.lit(0.0)).alias(o) for o in measures])


def values_wide(rows: DataFrame, entity_cols: list[str], value_col: str, rn_col: str,
                n: int, prefix: str = "g") -> DataFrame:
    """Ordered values per entity as columns ``g1..gn``.

    Ragged entities get nulls instead of shifted columns.  Conditional
    aggregation keeps it a single hash aggregate (no pivot value-discovery job).
    """
    return rows.groupBy(*entity_cols).agg(*[
        F.max(F.when(F.col(rn_col) == i, F.col(value_col))).alias(f"{prefix}{i}")
        for i in range(1, n + 1)])


def values_list(rows: DataFrame, entity_cols: list[str], value_col: str, rn_col: str,
                out_col: str = "values") -> DataFrame:
    """Ordered values per entity as an array (E7); bounded by the N of ``last_n``."""
    return rows.groupBy(*entity_cols).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(rn_col).alias("k"),
                                                         F.col(value_col).alias("v")))),
                    lambda x: x["v"]).alias(out_col))


def with_summary(detail: DataFrame, summary: DataFrame, label_col: str,
                 label: str = "Averages") -> DataFrame:
    """Detail rows followed by one labelled summary row per entity.

    ``summary`` must carry the detail columns except ``label_col``; numeric
    columns widen to the common type (int detail + double mean -> double).
    """
    return detail.unionByName(summary.withColumn(label_col, F.lit(label)))


def rollup_summary(rows: DataFrame, entity_cols: list[str], pos_col: str, label_col: str, measures: list[str],
                   label: str = "Averages") -> DataFrame:
    """Detail rows and one summary row per entity from a single aggregate.

    ``GROUPING SETS ((entity, position), (entity))``: Spark expands each row
    to both groups and aggregates once, where ``with_summary`` reads the rows
    twice.  Positions are the keys, so details with equal labels stay apart.
    An entity whose only row has a null position (it has no games) gets its
    summary row alone, with means of 0.  ``grouping_id`` tells the two kinds
    apart: a null position of a detail row is not the summary's.
    """
    keys = [*entity_cols, pos_col]
    sets = rows.groupingSets([keys, entity_cols], *[F.col(c) for c in keys]).agg(
        F.grouping_id().alias("__cs_kind"), F.max(label_col).alias("__cs_label"), *[F.avg(c).alias(c) for c in measures])
    total = F.col("__cs_kind") > 0
    return (sets.where(total | F.col(pos_col).isNotNull())
                .select(*keys, F.when(total, F.lit(label)).otherwise(F.col("__cs_label")).alias(label_col),
                        *[F.when(total, half_even(F.coalesce(F.col(c), F.lit(0.0)), 2)).otherwise(F.col(c)).alias(c) for c in measures]))
