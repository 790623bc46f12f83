"""Fixed parameter lists: stop words, query terms, seeds, team dimension.

These are small, bounded literal tables (tens to a couple of hundred rows);
they become DataFrames or ``isin`` sets, never per-row Python.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The English stop-word list of the NLTK corpus, in its own
# order.  Matching is on the lowercase, unstemmed token.
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you",
    "you're", "you've", "you'll", "you'd", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "that'll", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did",
    "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as",
    "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above",
    "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when",
    "where", "why", "how", "all", "any", "both", "each", "few", "more", "most",
    "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so",
    "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't",
    "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain",
    "aren", "aren't", "couldn", "couldn't", "didn", "didn't", "doesn",
    "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn",
    "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn",
    "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't",
    "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
]


def stop_words(profile: str = "v2") -> list[str]:
    """Stop list.

    ``v1`` adds the digits 0-9 and the letters a-z; ``v2`` (the current
    profile, used with the digit filter) adds the letters only.
    """
    words = list(ENGLISH_STOP_WORDS)
    if profile == "v1":
        words += list(string.digits)
    words += list(string.ascii_lowercase)
    return sorted(set(words))


# The query terms of the term-count report, matched lowercase
# and reported as written.
QUERY_TERMS = ["Player", "Games", "Assists", "Last", "Rebounds", "Points"]

def dimension_frame(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    """``team, team_id, dim_order`` from ordered (name, id) pairs.

    The list order is kept as ``dim_order``: it is the tie-break of rankings.
    """
    rows = [(name, tid, i) for i, (name, tid) in enumerate(pairs)]
    schema = T.StructType([
        T.StructField("team", T.StringType(), False),
        T.StructField("team_id", T.StringType(), False),
        T.StructField("dim_order", T.IntegerType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def seed_frame(spark: SparkSession, seed: dict[str, dict[int, str]]) -> DataFrame:
    """``doc_id, base_url, path`` rows flattened from base URL -> {id: path} (A1)."""
    rows = [(doc_id, base, path)
            for base, paths in seed.items()
            for doc_id, path in paths.items()]
    schema = T.StructType([
        T.StructField("doc_id", T.LongType(), False),
        T.StructField("base_url", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
    ])
    return spark.createDataFrame(rows, schema)
