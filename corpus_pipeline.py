"""Corpus pipeline: quality rules, near duplicates, decontamination, secret scan, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and works on all rows that the stage before it kept.  All but the last return
the columns of ``docs``.

Defined results: rows with null or empty text fail the quality rules and go.
A stage by itself keeps them: without words they are linked with nothing, not
contaminated and have no secrets; packed, they are one piece.  Very long texts
pass whole.  Ties go as the operators' modules say; of repeated rows one stays
after the joins; empty tables give no rows.  Extra columns, whatever their
names, pass all stages up to packing, which leaves them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtside.llm import decontaminate, ngram_join, packing, quality_rules, secrets
from courtside.llm.common import materialize, table
from courtside.llm.queries import TOKENIZER


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules or the isolation forest reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents stays, the one with the smallest doc_id."""
    return ngram_join.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows contaminated by benchmark items go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; every row stays."""
    return secrets.mask_secrets(docs, words=TOKENIZER)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in near-equal windows."""
    return packing.pack_documents(docs, TOKENIZER, end_id=2)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]

#: The forest, the joins' components, the guess costs and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table that the next stage reads."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
