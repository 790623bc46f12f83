"""Sorting, top-k and rank numbering.

``top_k`` is a ``TakeOrderedAndProject``: every task keeps its own k best rows
and only those reach the final merge, so it never sorts the whole input.

``global_row_number`` numbers a *full* ordering (F4) without funnelling all
rows through one task, which is what ``row_number() over (order by ...)``
without a partition would do: the rows are range-partitioned on the sort key,
each partition is sorted locally, and the position of a row is the number of
rows in earlier partitions plus its index inside its own partition.  Only one
count per partition (a table whose size is bounded by the partition number)
is broadcast back.

The counting pass and the numbering pass must see the very same partitions,
so the range-sorted rows are written once with a reliable ``checkpoint()``
(into ``spark.checkpoint.dir``) and both passes read that copy; the upstream
plan runs once and a lost executor cannot reshuffle the rows in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.session import ensure_checkpoint_dir

_PID = "__cs_pid"
_MID = "__cs_mid"
_OFF = "__cs_offset"


def top_k(df: DataFrame, k: int, order_by: list[Column], rank_col: str | None = "rank") -> DataFrame:
    """The first ``k`` rows of ``order_by`` with a 1..k rank.

    Ranks are row numbers (no shared ranks); they are computed after the limit,
    so the numbering window sees at most ``k`` rows.
    """
    limited = df.orderBy(*order_by).limit(k)
    if rank_col is None:
        return limited
    return limited.withColumn(rank_col, F.row_number().over(Window.orderBy(*order_by)))


def global_row_number(df: DataFrame, order_by: list[Column], rank_col: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    """Append ``rank_col`` = 1-based position of each row in ``order_by``.

    ``order_by`` should be a total order (end it with a unique key) so the
    numbering is deterministic, as with any ``row_number``.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # Without a number, adaptive execution merges small ranges; a fixed one is kept.
    ranged = df.repartitionByRange(num_partitions, *order_by) if num_partitions else df.repartitionByRange(*order_by)
    ordered = ranged.sortWithinPartitions(*order_by).checkpoint(eager=True)
    tagged = (ordered.withColumn(_PID, F.spark_partition_id())
                .withColumn(_MID, F.monotonically_increasing_id()))
    # One row per non-empty partition: the number of rows before it.
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_OFF))
    # The id is (partition << 33) + index within the partition.
    local_index = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), _PID)
                  .withColumn(rank_col, (F.col(_OFF) + local_index + 1).cast("long"))
                  .drop(_PID, _MID, _OFF))
