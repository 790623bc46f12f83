"""Term statistics and the inverted index.

Layout: documents are tokenized once into a *long* postings table
``(term, doc_id, tf, first_pos)``, aggregated per (term, document) so that a
document ships each of its terms once.  Everything else derives from it:

* corpus frequency per term = ``sum(tf)``; the first encounter (for stable
  tie-breaks) = ``min(struct(doc_id, first_pos))``; both aggregate partially
  on the map side, so a hot term costs one row per task before the shuffle;
* the top-k terms are a ``TakeOrderedAndProject`` (k rows per task);
* postings of the top terms join the long table with the k-row list
  (broadcast; its size is k by construction);
* the presentation string of a posting is built per ``(term, doc_id div
  block)``, so no group ever holds more than ``block`` ids even for a term
  that occurs in every document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.porter import stem_terms
from courtside.functions.text import has_digit, is_alnum, word_tokens
from courtside.operators.ranking import top_k
from courtside.session import ensure_checkpoint_dir
from courtside.sources.params import stop_words

DEFAULT_BLOCK = 1_000_000


def tokens(docs: DataFrame, id_col: str = "doc_id", text: Column | str = "text", kept: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, pos, term``: one row per raw token, document order (C3, C4); before them the ``kept`` columns.

    A document without an id cannot be indexed.  Filtering it here also makes
    every branch that reads the tokens start from the same scan predicate, so
    their shared shuffles stay reusable even when a later join infers it.
    """
    return (docs.where(F.col(id_col).isNotNull())
                .select(*kept, F.col(id_col).alias("doc_id"),
                        F.posexplode(word_tokens(text)).alias("pos", "term")))


def term_filter(term: Column | str = "term", profile: str = "v2") -> Column:
    """Keep-predicate of a filter profile.

    ``v2``: no digit anywhere, fully alphanumeric, not a stop word (letters
    a-z included).  ``v1``: alphanumeric and not a stop word (digits 0-9 and
    letters a-z included).  Stop words are an ``isin`` over a literal set, so
    the check is a hash-set probe inside generated code, not a join.
    """
    t = F.col(term) if isinstance(term, str) else term
    keep = is_alnum(t) & ~t.isin(*stop_words(profile))
    if profile == "v2":
        keep = ~has_digit(t) & keep
    return keep


def term_postings(docs: DataFrame, id_col: str = "doc_id", text: Column | str = "text",
                  profile: str = "v2", stemmed: bool = False, kept: tuple[str, ...] = ()) -> DataFrame:
    """Long postings ``term, doc_id, tf, first_pos`` after filtering (and stemming).

    ``kept`` columns, which must follow from the document's id, come before
    them; documents dealt by such a column are counted without a shuffle.

    Stemming runs on the distinct vocabulary only and is joined back (C9): the
    vocabulary is far smaller than the token stream.  The vocabulary -> stem
    dictionary is written once with a reliable ``checkpoint()``; the main plan
    then joins a plain table instead of carrying the long rule chain.
    """
    toks = tokens(docs, id_col, text, kept).where(term_filter("term", profile))
    per_doc = toks.groupBy(*kept, "term", "doc_id").agg(
        F.count(F.lit(1)).alias("tf"), F.min("pos").alias("first_pos"))
    if not stemmed:
        return per_doc
    vocab = toks.select("term").distinct()  # one map-side-deduplicated aggregate
    ensure_checkpoint_dir(docs.sparkSession)
    stems = stem_terms(vocab, "term", "stem").checkpoint(eager=True)
    return (per_doc.join(stems, "term")
                   .groupBy(*kept, F.col("stem").alias("term"), "doc_id")
                   .agg(F.sum("tf").alias("tf"), F.min("first_pos").alias("first_pos")))


def term_frequency(postings: DataFrame) -> DataFrame:
    """``term, n, n_docs, first``: corpus count and first encounter.

    A term has one row per document, so the least document's position is the
    first; both are numbers, which a hash aggregate holds (the least struct
    would sort all postings).
    """
    found = postings.groupBy("term").agg(
        F.sum("tf").alias("n"),
        F.count(F.lit(1)).alias("n_docs"),
        F.min("doc_id").alias("doc_id"), F.min_by("first_pos", "doc_id").alias("first_pos"))
    return found.select("term", "n", "n_docs", F.struct("doc_id", "first_pos").alias("first"))


def top_terms(postings: DataFrame, k: int = 15) -> DataFrame:
    """``rank, term, n``: the k most frequent terms; ties by first encounter (F1)."""
    freq = term_frequency(postings)
    return top_k(freq, k, [F.col("n").desc(), F.col("first").asc()], "rank") \
        .select("rank", "term", "n", "n_docs")


def top_postings(postings: DataFrame, top: DataFrame) -> DataFrame:
    """Long postings restricted to the top terms.

    The validity predicate references every postings column, so this branch
    reads the same aggregate as the ranking branch and Spark reuses the
    postings shuffle instead of tokenizing again.
    """
    valid = (F.col("tf") >= 1) & (F.col("first_pos") >= 0)
    return postings.where(valid).join(F.broadcast(top.select("term", "rank")), "term")


def posting_strings(postings: DataFrame, block: int = DEFAULT_BLOCK,
                    keys: tuple[str, ...] = ("term",)) -> DataFrame:
    """``keys, block, document_ids, n_docs, occurrences, first_doc, first_pos``.

    Ids are sorted before they become strings, so ``2`` precedes ``10``.  One
    row per (term, block of ``block`` consecutive ids) bounds every group.
    ``first_doc``/``first_pos`` is the first encounter of the term in the
    block in (document, position) order.
    """
    blk = F.floor(F.col("doc_id") / F.lit(block)).cast("long")
    return (postings.groupBy(*keys, blk.alias("block"))
                    .agg(F.array_join(F.array_sort(F.collect_list("doc_id")).cast("array<string>"),
                                      ", ").alias("document_ids"),
                         F.count(F.lit(1)).alias("n_docs"),
                         F.sum("tf").alias("occurrences"),
                         F.min(F.struct("doc_id", "first_pos")).alias("first"))
                    .select(*keys, "block", "document_ids", "n_docs", "occurrences",
                            F.col("first.doc_id").alias("first_doc"),
                            F.col("first.first_pos").alias("first_pos")))


def inverted_index(postings: DataFrame, k: int = 15, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Top-k terms with their posting strings, in frequency order (B2).

    The top-k list is computed once and broadcast (k rows); the strings
    branch reads the same postings columns as the ranking branch, whichever
    of its own a caller keeps, so Spark reuses the postings shuffle instead
    of tokenizing the corpus twice.
    """
    ranked = top_postings(postings, top_terms(postings, k))
    strings = posting_strings(ranked, block, keys=("term", "rank"))
    return strings.select("rank", F.col("term").alias("word"), "block", "document_ids", "n_docs",
                          "occurrences", "first_doc", "first_pos")
