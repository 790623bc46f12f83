"""Compressed posting lists with skip entries, and conjunctive queries over them.

A term's sorted document ids are stored per block of ``docs_per_block``
consecutive ids: the gaps between ids, each in the same number of bits, in
one binary.  A block knows its first and last id, count and gap width (its skip
entry), so two terms are intersected by meeting on the block number first;
blocks that the other term lacks, or whose id ranges do not overlap, are never
decoded.  A block decodes to at most ``docs_per_block`` ids whatever the
term's frequency.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOCS_PER_BLOCK = 512


def compress(postings: DataFrame, docs_per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """``term, block, first, last, n, width, gaps`` of ``term, doc_id`` rows; repeated rows count once.

    Each step is a projection of its own whose result the next one uses more
    than once, so the optimizer keeps them apart and nothing is worked out
    again for every element of an array.
    """
    block = F.floor(F.col("doc_id") / docs_per_block).cast("long")
    ids = postings.groupBy("term", block.alias("block")).agg(F.array_sort(F.collect_set("doc_id")).alias("ids"))
    gaps = ids.select("term", "block", F.element_at("ids", 1).alias("first"), F.element_at("ids", -1).alias("last"), F.size("ids").cast("long").alias("n"),
                      F.transform(F.slice("ids", 2, F.size("ids")), lambda x, i: x - F.get("ids", i)).alias("steps"))
    wide = gaps.select("*", F.length(F.bin(F.coalesce(F.array_max("steps"), F.lit(0)))).alias("width"))
    bits = wide.select("*", F.array_join(F.transform("steps", lambda g: F.lpad(F.bin(g), F.col("width"), "0")), "").alias("bits"))
    at = F.when(F.length("bits") > 0, F.sequence(F.lit(1), F.length("bits"), F.lit(8))).otherwise(F.array().cast("array<int>"))
    bytes_ = F.transform(at, lambda k: F.lpad(F.conv(F.rpad(F.substr("bits", k, F.lit(8)), 8, "0"), 2, 16), 2, "0"))
    return bits.select("term", "block", "first", "last", "n", "width", F.unhex(F.array_join(bytes_, "")).alias("gaps"))


def decompress(blocks: DataFrame, *kept: str) -> DataFrame:
    """``kept`` columns and ``ids``, the ascending ids of each block."""
    digits = F.filter(F.split(F.hex("gaps"), ""), lambda h: h != "")
    bits = blocks.select(*kept, "first", "n", "width", F.array_join(F.transform(digits, lambda h: F.lpad(F.conv(h, 16, 2), 4, "0")), "").alias("bits"))
    last = F.least(F.col("n").cast("int") - 2, F.floor(F.length("bits") / F.col("width")).cast("int"))
    steps = F.when(F.col("n") > 1, F.transform(F.sequence(F.lit(0), last), lambda i: F.conv(F.substr("bits", i * F.col("width") + 1, F.col("width")), 2, 10).cast("long")))
    ids = F.aggregate(F.coalesce(steps, F.array().cast("array<bigint>")), F.array("first"), lambda held, g: F.concat(held, F.array(F.element_at(held, -1) + g)))
    return bits.select(*kept, ids.alias("ids"))


def conjunction(index: DataFrame, queries: DataFrame) -> DataFrame:
    """``query_id, doc_id``: the documents that hold all terms of each query (rows of ``query_id, terms``, an array).

    Only blocks that every term of the query has, with overlapping id ranges,
    are decoded.  A query with a term that occurs nowhere, or without terms,
    has no documents.
    """
    asked = queries.select("query_id", F.array_distinct("terms").alias("terms")).where(F.size("terms") > 0)
    each = asked.select("query_id", F.size("terms").alias("many"), F.explode("terms").alias("term"))
    skips = each.join(index.select("term", "block", "first", "last"), "term")
    met = skips.groupBy("query_id", "block", "many").agg(F.count(F.lit(1)).alias("has"), F.max("first").alias("low"), F.min("last").alias("high")) \
        .where("has = many AND low <= high").select("query_id", "block", "low", "high")
    read = decompress(met.join(each, "query_id").join(index, ["term", "block"]), "query_id", "block", "low", "high")
    inside = F.filter("ids", lambda x: x.between(F.col("low"), F.col("high")))
    lists = read.select("query_id", "block", inside.alias("ids")).groupBy("query_id", "block").agg(F.collect_list("ids").alias("lists"))
    # a query has few terms, so a group holds few lists of at most one block each
    both = F.aggregate(F.slice("lists", 2, F.size("lists")), F.element_at("lists", 1), F.array_intersect)
    return lists.select("query_id", F.explode(both).alias("doc_id"))

