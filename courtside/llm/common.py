"""Helpers shared by the training-data operators: inputs, scratch tables, code shipping.

Scratch tables are written under the folder that ``spark.checkpoint.dir``
names (shared storage on a cluster); a session without one falls back to the
library's rule in ``courtside.session.ensure_checkpoint_dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.session import ensure_checkpoint_dir

#: Rows a Python worker turns into Python objects at once.
SLICE_ROWS = 512

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors once per application (``addPyFile``)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="courtside-code-"), "courtside_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/courtside-llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it back.

    Cuts the lineage: later jobs reread the table, also after lost executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that few texts are Python objects at once."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def as_bytes(df: DataFrame, column: str = "text"):
    """The column's UTF-8 bytes; null stays null."""
    return F.col(column).cast("string").cast("binary")


def hold(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with its columns named by position, and the name that ``text`` has then."""
    held = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    return held, f"_{[c.lower() for c in docs.columns].index('text')}"
