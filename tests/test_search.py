"""Ranked search over blocks against full scoring; blocks that the threshold skips are counted."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from courtside.operators.index import term_postings, tokens
from courtside.operators.search import SCORE_DECIMALS, by_range, impact_blocks, search, search_with_blocks, tier, write_impact_index
from courtside.session import ensure_checkpoint_dir


def frame(spark, docs):
    rows = [(t, d, n) for d, text in docs.items() for t, n in Counter(text.split()).items()]
    return spark.createDataFrame(rows, "term string, doc_id long, tf long")


def asked(spark, queries):
    return spark.createDataFrame([(q, t) for q, terms in queries.items() for t in terms], "query_id long, term string")


def plain(docs, queries, k):
    n = {d: Counter(t.split()) for d, t in docs.items()}
    df = Counter(t for c in n.values() for t in c)
    out = []
    for q, terms in queries.items():
        scores = defaultdict(float)
        for t in sorted(set(terms)):
            for d, c in n.items():
                if c[t]:
                    scores[d] += (1 + math.log10(c[t])) * math.log10(len(docs) / df[t])
        best = sorted(scores.items(), key=lambda x: (-round(x[1], SCORE_DECIMALS), x[0]))[:k]
        out += [(q, r, d, round(s, 6)) for r, (d, s) in enumerate(best, 1)]
    return sorted(out)


def corpus(n, seed):
    """Skewed words: w0 is in nearly every document, late ones are rare and sometimes frequent inside a document."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = {}
    for d in range(n):
        text = r.choices(words, weights, k=r.randint(1, 60)) + ["common"]
        text += [r.choice(words)] * r.choice([0, 0, 0, 0, 5, 30])
        docs[d * 3] = " ".join(text)
    return docs


QUERIES = {1: ["w0", "w1"], 2: ["w40", "w41", "w42"], 3: ["w5", "w5", "w90"], 4: ["nowhere"], 5: ["w7", "nowhere"], 6: ["common"], 7: [f"w{i}" for i in range(0, 120, 9)]}


def rows(df):
    return sorted((r.query_id, r.rank, r.doc_id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("per_block, k, first", [(50, 5, 2), (7, 3, 1), (4096, 10, 2), (100, 1000, 2)])
def test_equals_full_scoring(spark, per_block, k, first):
    docs = corpus(300, per_block)
    index = impact_blocks(frame(spark, docs), per_block).cache()
    assert rows(search(index, asked(spark, QUERIES), len(docs), k, first)) == plain(docs, QUERIES, k)
    index.unpersist()


def test_blocks_are_skipped_and_bounded(spark):
    docs = corpus(600, 1)
    path = f"{ensure_checkpoint_dir(spark)}/test-impact-index"
    write_impact_index(impact_blocks(frame(spark, docs), 30), path)
    index = spark.read.parquet(path)
    assert index.agg(F.max("n")).first()[0] <= 30
    found, plan, read = search_with_blocks(index, asked(spark, QUERIES), len(docs), 3)
    every = {r.query_id: (r.blocks, r.n) for r in plan.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("n")).collect()}
    own = {r.query_id: (r.blocks, r.n) for r in read.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("n")).collect()}
    # query 6 asks for a word of every document: all score 0, nothing can be skipped
    assert own[6] == every[6]
    assert all(own[q][0] < 0.75 * every[q][0] for q in (1, 3, 5, 7)), (own, every)
    assert sum(own[q][1] for q in own if q != 6) < 0.6 * sum(every[q][1] for q in every if q != 6), (own, every)
    assert rows(found) == plain(docs, QUERIES, 3)
    # what is skipped could not have reached the first three
    third = {q: s for q, r, _, s in plain(docs, QUERIES, 3) if r == 3}
    assert all(r.bound <= third[r.query_id] + 1e-6 for r in plan.where("not needed").collect())


def test_the_narrow_scan_leaves_postings_unread(spark):
    path = f"{ensure_checkpoint_dir(spark)}/test-impact-narrow"
    write_impact_index(impact_blocks(frame(spark, corpus(50, 2)), 10), path)
    narrow = spark.read.parquet(path).select("term", "tier", "range", "n").join(asked(spark, QUERIES).select("term").distinct(), "term", "left_semi")
    assert "postings" not in narrow._jdf.queryExecution().executedPlan().toString()


def test_tiers_rise_with_frequency(spark):
    got = [r[0] for r in spark.range(1, 2000).select(tier(F.col("id"))).collect()]
    assert got[:9] == [1, 2, 3, 4, 5, 6, 7, 8, 9] and got == sorted(got) and got[-1] < 20


@pytest.mark.parametrize("docs, queries", [({}, {1: ["a"]}), ({1: "a b"}, {}), ({1: "a b"}, {1: ["a"]})])
def test_empty_sides(spark, docs, queries):
    index = impact_blocks(frame(spark, docs))
    assert rows(search(index, asked(spark, queries), len(docs))) == plain(docs, queries, 10)


def test_documents_without_id_or_text(spark):
    docs = spark.createDataFrame([(None, "apple"), (1, None), (2, "apple pear"), (3, "")], "doc_id long, text string")
    assert sorted((r.doc_id, r.term) for r in tokens(docs).collect()) == [(2, "apple"), (2, "pear")]


def test_an_index_takes_one_shuffle_and_its_files_hold_whole_ranges(spark):
    """Texts dealt by range are counted, cut into blocks and written where they are; a repeated id counts as one document."""
    docs = {d: t for d, t in corpus(90, 3).items()}
    rows_ = [(d, w) for d, t in docs.items() for w in (t.replace("w", "x").translate(str.maketrans("0123456789", "abcdefghij")), "pear pear")]
    table_ = spark.createDataFrame([*rows_, (None, "apple"), (500, None)], "doc_id long, text string")
    dealt = impact_blocks(term_postings(by_range(table_, docs_per_block=10), kept=("range",)), 10)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(range" in plan
    path = f"{ensure_checkpoint_dir(spark)}/test-impact-ranges"
    write_impact_index(dealt, path)
    written = spark.read.parquet(path)
    assert written.select("range", F.input_file_name().alias("file")).distinct().groupBy("range").count().where("count > 1").count() == 0
    plainly = impact_blocks(term_postings(table_), 10)
    columns = sorted(plainly.columns)
    assert sorted(map(str, written.select(*columns).collect())) == sorted(map(str, plainly.select(*columns).collect()))
    assert {p.tf for r in written.where("term = 'pear'").collect() for p in r.postings} == {2}


def test_blocks_of_other_terms_are_not_moved(spark, tmp_path):
    """No shuffle of a search holds a block of a term that no query asks for."""
    docs = {d: f"asked{d % 2} " + " ".join(f"other{d}x{i}" for i in range(200)) for d in range(60)}
    write_impact_index(impact_blocks(frame(spark, docs), 10), str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    queries = {1: ["asked0"], 2: ["asked0", "asked1"]}
    found, _, _ = search_with_blocks(index, asked(spark, queries), len(docs), 3)
    assert rows(found) == plain(docs, queries, 3)
    scanned = found._jdf.queryExecution().optimizedPlan().toString()
    # the postings' scan has only the semi join with the asked terms above it
    assert re.search(r"Join LeftSemi, \(term[^\n]*(\n[ :+|-]*(Project|Filter)[^\n]*)*\n[ :+|-]*Relation \[[^\n]*postings", scanned), scanned
