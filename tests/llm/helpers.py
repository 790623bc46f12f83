"""Small frames with the awkward rows that every operator must take."""

from __future__ import annotations

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **extra):
    """A documents table of (doc_id, text) pairs, or of texts numbered from 0."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs], DOC_SCHEMA)


def with_clashes(df, *names):
    """``df`` with extra columns of the given names, which operators may use inside."""
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit("extra") for n in names})
