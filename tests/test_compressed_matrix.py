"""Compressed postings and block matrices: round trips, bounded blocks, plain intersections."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from courtside.operators.compressed import compress, conjunction, decompress
from courtside.operators.dictionary import dense_ids
from courtside.operators.matrix import all_term_weights, from_blocks, times_vector, to_blocks, transpose
from courtside.plans.search import tfidf_all_terms


def postings(spark, lists):
    return spark.createDataFrame([(t, d) for t, ids in lists.items() for d in ids], "term string, doc_id long")


def some(seed):
    r = random.Random(seed)
    big = 1 << 40
    return {"one": [5], "all": list(range(700)), "twice": [3, 3, 9], "rare": [0, 699, 10_000, big, big + 1], "none but negative": [-5, -1, 2],
            **{f"t{k}": r.sample(range(2000), r.randint(1, 300)) for k in range(12)}}


@pytest.mark.parametrize("per_block", [1, 7, 512, 1 << 42])
def test_round_trip(spark, per_block):
    lists = {t: ids for t, ids in some(1).items() if per_block < 1 << 42 or t != "rare"}
    packed = compress(postings(spark, lists).repartition(3), per_block)
    got = {}
    for r in decompress(packed, "term", "block", "last", "n").orderBy("term", "block").collect():
        assert len(r.ids) == r.n <= per_block and r.ids == sorted(r.ids) and r.ids[-1] == r.last and all(i // per_block == r.block for i in r.ids)
        got.setdefault(r.term, []).extend(r.ids)
    assert got == {t: sorted(set(ids)) for t, ids in lists.items()}


def test_gaps_take_few_bits(spark):
    r = compress(postings(spark, {"all": range(512)}), 512).first()
    assert (r.n, r.width, len(r.gaps)) == (512, 1, 64)


@pytest.mark.parametrize("per_block", [16, 512])
def test_conjunctions(spark, per_block):
    lists = some(2)
    queries = {1: ["all", "t1"], 2: ["t1", "t2", "t3"], 3: ["one", "rare"], 4: ["one", "nowhere"], 5: ["twice"], 6: ["t4", "t4"], 7: [], 8: ["rare", "all"]}
    asked = spark.createDataFrame(list(queries.items()), "query_id int, terms array<string>")
    got = sorted(map(tuple, conjunction(compress(postings(spark, lists), per_block), asked).collect()))
    want = sorted((q, d) for q, terms in queries.items() if terms for d in set.intersection(*(set(lists.get(t, ())) for t in terms)))
    assert got == want


def test_no_postings(spark):
    assert compress(postings(spark, {})).collect() == []


def weights(spark, side):
    r = random.Random(3)
    docs = {p * 2: Counter(r.choices([f"w{k}" for k in range(40)], range(40, 0, -1), k=r.randint(0, 30)) + ["all"]) for p in range(50)}
    rows = [(t, p, n) for p, c in docs.items() for t, n in c.items()]
    long = all_term_weights(spark.createDataFrame(rows, "term string, page_id long, n long"), len(docs)).cache()
    ids = dense_ids(long, "term")
    df = Counter(t for c in docs.values() for t in c)
    want = {(t, p): (1 + math.log10(n)) * math.log10(len(docs) / df[t]) for t, p, n in rows}
    return long, ids, to_blocks(long, ids, side=side).cache(), want


@pytest.mark.parametrize("side", [4, 256])
def test_blocks_equal_the_long_form(spark, side):
    _, ids, blocks, want = weights(spark, side)
    assert blocks.agg(F.max(F.size("cells"))).first()[0] <= side * side
    got = {(r.term, r.page_id): r.value for r in from_blocks(blocks, ids).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    for r in blocks.collect():
        places = [(c.term_id, c.page_id) for c in r.cells]
        assert places == sorted(places) and all(t // side == r.term_block and p // side == r.page_block for t, p in places)


def test_transpose_and_product(spark):
    long, ids, blocks, want = weights(spark, 8)
    turned = {(c.page_id, c.term_id): c.value for r in transpose(blocks).collect() for c in r.cells}
    key = {r.id: r.key for r in ids.collect()}
    assert {(key[t], p): v for (p, t), v in turned.items()} == {(r.term, r.page_id): r.tfidf for r in long.collect()}
    vector = {"w1": 2.0, "w9": -1.0, "all": 5.0, "w30": 0.5}
    terms = spark.createDataFrame(list(vector.items()), "key string, weight double").join(ids, "key").select(F.col("id").alias("term_id"), "weight")
    got = {r.page_id: r.value for r in times_vector(blocks, terms, 8).collect()}
    for p in {p for _, p in want}:
        assert abs(got.get(p, 0.0) - sum(w * want.get((t, p), 0.0) for t, w in vector.items())) < 1e-12


def test_postings_meet_the_dictionary_once_and_are_not_sorted(spark):
    """The dictionary brings frequency and id of a term together; neither weights nor their long form sort the cells."""
    docs = [("a", 1), ("a", 2), ("a", 2), ("b", 2), ("c", 9), ("c", None)]
    postings = spark.createDataFrame(docs, "term string, page_id long").groupBy("term", "page_id").agg(F.count(F.lit(1)).alias("n"))
    ids = dense_ids(postings, "term", count_col="df")
    assert sorted((r.key, r.id, r.df) for r in ids.collect()) == [("a", 0, 2), ("b", 1, 1), ("c", 2, 2)]
    met = all_term_weights(postings, 4, ids)
    plainly = all_term_weights(postings, 4)
    assert sorted(map(str, met.select(*plainly.columns).collect())) == sorted(map(str, plainly.collect()))
    assert {(r.term, r.term_id) for r in met.collect()} == {("a", 0), ("b", 1), ("c", 2)}
    blocks = to_blocks(met, ids, side=2)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, to_blocks(plainly, dense_ids(postings, "term"), side=2).collect()))
    plan = blocks._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ShuffledHashJoin") == 1 and "SortMergeJoin" not in plan
    assert "SortMergeJoin" not in from_blocks(blocks, ids)._jdf.queryExecution().sparkPlan().toString()


def test_terms_of_all_pages_on_repeated_and_missing_ids(spark, tmp_path):
    """Pages of one id count as one page's text, in whatever files they are; the number of pages counts rows."""
    rows = [(1, "u", "<p>One &amp; one</p><!-- no -->"), (1, "v", "<b>two</b> one<script>x</script>"), (2, "w", "two"), (None, "x", "three"), (3, "y", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    got = {(r.term, r.page_id): r.tfidf for r in tfidf_all_terms(spark, str(tmp_path)).collect()}
    n = {("one", 1): 3, ("&", 1): 1, ("two", 1): 1, ("two", 2): 1, ("three", None): 1}
    df = Counter(t for t, _ in n)
    assert got == {k: round((1 + math.log10(c)) * math.log10(5 / df[k[0]]), 6) for k, c in n.items()}
