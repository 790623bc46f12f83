"""Incremental postings and running term frequency over arriving documents.

* ``start_postings_stream``: each micro-batch of new documents is tokenized
  with the batch operator (``term_postings``) inside ``foreachBatch`` and
  written to ``<out>/batch_id=<n>``, overwriting only that partition, so a
  replayed batch (after a failure) replaces its own output: exactly-once
  results on top of the checkpointed source offsets.  No streaming state is
  kept, since documents arrive whole.
* ``running_term_frequency``: the corpus term count (E1) as a streaming
  aggregation; its state is one row per distinct term.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from courtside.operators.index import term_filter, term_postings, tokens

DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def document_stream(spark: SparkSession, source_dir: str, file_glob: str = "*.parquet",
                    files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(DOCUMENT_SCHEMA).option("pathGlobFilter", file_glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(source_dir)


def start_postings_stream(docs: DataFrame, out_dir: str, checkpoint_dir: str,
                          profile: str = "v2") -> StreamingQuery:
    """Append the postings of every micro-batch to ``out_dir`` (idempotently)."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        post = term_postings(batch.select("doc_id", "text"), profile=profile)
        (post.withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(out_dir))

    return (docs.writeStream.foreachBatch(write_batch)
                .option("checkpointLocation", checkpoint_dir)
                .trigger(availableNow=True).start())


def running_term_frequency(docs: DataFrame, profile: str = "v2") -> DataFrame:
    """Streaming ``term, n``: the corpus count of each term so far."""
    toks = tokens(docs.select("doc_id", "text")).where(term_filter("term", profile))
    return toks.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
