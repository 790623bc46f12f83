"""The streaming drivers give the batch results."""

import os
import tempfile

from pyspark.sql import functions as F

from courtside.operators.index import term_frequency, term_postings
from courtside.streaming.index_stream import (document_stream, running_term_frequency,
                                              start_postings_stream)
from tests.conftest import SF_SMALL


def test_incremental_postings_equal_batch(spark):
    scratch = tempfile.mkdtemp(prefix="courtside-stream-")
    docs = document_stream(spark, SF_SMALL, "documents.parquet")
    q = start_postings_stream(docs, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(scratch, "out")).drop("batch_id")
    batch = term_postings(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert got.count() == batch.count()
    assert got.exceptAll(batch.select(*got.columns)).count() == 0


def test_running_term_frequency_equals_batch(spark):
    docs = document_stream(spark, SF_SMALL, "documents.parquet")
    q = (running_term_frequency(docs).writeStream.outputMode("complete").format("memory")
         .queryName("cs_term_freq").start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT term, n FROM cs_term_freq")
    want = term_frequency(term_postings(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))) \
        .select("term", F.col("n").cast("long").alias("n"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_postings_over_several_batches_and_restart(spark):
    scratch = tempfile.mkdtemp(prefix="courtside-stream-multi-")
    src = os.path.join(scratch, "src")
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(4, "doc_id").write.parquet(src)
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    q = start_postings_stream(document_stream(spark, src, "*.parquet", files_per_trigger=1), out, ckpt)
    q.awaitTermination(300)
    batches = spark.read.parquet(out).select("batch_id").distinct().count()
    assert batches >= 2
    # a restart with nothing new leaves the output as it was (no duplicates)
    q2 = start_postings_stream(document_stream(spark, src, "*.parquet", files_per_trigger=1), out, ckpt)
    q2.awaitTermination(300)
    got = spark.read.parquet(out).drop("batch_id")
    batch = term_postings(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert got.count() == batch.count()
    assert got.exceptAll(batch.select(*got.columns)).count() == 0
