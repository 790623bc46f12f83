"""Dense ids for string keys, and tables moved between both forms.

A graph of URLs repeats long strings in every edge and in every step of an
iteration.  ``dense_ids`` numbers the distinct strings 0..n-1 without one task
seeing them all: they are range-partitioned and sorted, each partition
counts its own, and a key's id is the count of the partitions before it plus
its place inside its own.  Ids therefore follow the order of the strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.operators.ranking import global_row_number


def dense_ids(keys: DataFrame, key_col: str = "key", num_partitions: int | None = None, count_col: str | None = None) -> DataFrame:
    """``key, id`` for the distinct non-null keys; ids count from 0 in key order.

    The numbered table is checkpointed, so every join below sees the same ids.
    With a ``count_col`` it also holds under that name how many rows have the key.
    """
    found = keys.select(F.col(key_col).alias("key")).where(F.col("key").isNotNull())
    distinct = found.groupBy("key").agg(F.count(F.lit(1)).alias(count_col)) if count_col else found.distinct()
    numbered = global_row_number(distinct, [F.col("key").asc()], "id", num_partitions)
    return numbered.select("key", (F.col("id") - 1).alias("id"), *([count_col] if count_col else []))


def encode(df: DataFrame, ids: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with each key column replaced by its id: ``columns`` maps key column to id column.

    Rows whose key is not in the dictionary are dropped.
    """
    for key, out in columns.items():
        side = ids.select(F.col("key").alias("__cs_key"), F.col("id").alias(out))
        df = df.join(side, df[key] == F.col("__cs_key")).drop("__cs_key", key)
    return df


def decode(df: DataFrame, ids: DataFrame, id_col: str, key_col: str, *others: str | Column) -> DataFrame:
    """``df``'s ids back as keys, with the ``others`` columns."""
    side = ids.select(F.col("key").alias(key_col), F.col("id").alias("__cs_id"))
    return df.join(side, df[id_col] == F.col("__cs_id")).select(key_col, *others)
