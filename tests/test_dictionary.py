"""Dense ids of string nodes, and PageRank over them against plain power iteration."""

import random

import pytest
from pyspark.sql import functions as F

from courtside.operators.dictionary import decode, dense_ids, encode
from courtside.operators.graph import pagerank_by_key


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "key string")


@pytest.mark.parametrize("parts", [None, 1, 7])
def test_ids_are_dense_and_in_key_order(spark, parts):
    values = [f"k{random.Random(i).randint(0, 500)}" for i in range(900)] + [None, "", "é", "z"]
    got = {r.key: r.id for r in dense_ids(keys(spark, values).repartition(5), num_partitions=parts).collect()}
    want = sorted({v for v in values if v is not None}, key=str.encode)
    assert got == {k: i for i, k in enumerate(want)}


def test_no_keys(spark):
    assert dense_ids(keys(spark, [])).collect() == [] and dense_ids(keys(spark, [None])).collect() == []


def test_encode_and_decode(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "a", 2), ("a", "x", 3), (None, "a", 4)], "src string, dst string, w int")
    ids = dense_ids(keys(spark, ["a", "b"]))
    coded = encode(edges, ids, {"src": "s", "dst": "d"})
    assert sorted(map(tuple, coded.select("s", "d", "w").collect())) == [(0, 1, 1), (1, 0, 2)]
    assert sorted(map(tuple, decode(coded, ids, "s", "from", "w").collect())) == [("a", 1), ("b", 2)]


def plain(nodes, edges, alpha=0.85):
    nodes = sorted(nodes | {x for e in edges for x in e})
    out = {n: [d for s, d in edges if s == n] for n in nodes}
    rank = {n: 1 / len(nodes) for n in nodes}
    for _ in range(400):
        spread = sum(rank[n] for n in nodes if not out[n])
        new = {n: (1 - alpha) / len(nodes) + alpha * spread / len(nodes) for n in nodes}
        for n in nodes:
            for d in out[n]:
                new[d] += alpha * rank[n] / len(out[n])
        rank = new
    return rank


def test_pagerank_of_string_nodes(spark):
    r = random.Random(4)
    names = [f"/page/{i:03d}?q=é" for i in range(40)]
    edges = {(r.choice(names[:30]), r.choice(names)) for _ in range(150)} | {(n, names[0]) for n in names[5:25]}
    e = spark.createDataFrame([*edges, *list(edges)[:20], (None, names[1]), (names[2], None)], "src string, dst string")
    got = pagerank_by_key(keys(spark, names + names[:9] + ["alone", None]), e, tol=1e-14, max_iter=400)
    assert got.columns == ["key", "rank"]
    want = plain({*names, "alone"}, edges)
    ranks = {x.key: x.rank for x in got.collect()}
    assert ranks.keys() == want.keys() and all(abs(ranks[n] - want[n]) < 1e-11 for n in want)
    assert abs(got.agg(F.sum("rank")).first()[0] - 1) < 1e-9


def test_pagerank_of_no_nodes(spark):
    assert pagerank_by_key(keys(spark, []), spark.createDataFrame([], "src string, dst string")).collect() == []
