"""TF-IDF goldens (H1-H5), graph invariants (I1-I4, D2, E9), precision/recall."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.functions.text import html_raw_text
from courtside.operators import tfidf as TF
from courtside.operators.evaluate import precision_recall_by_query
from courtside.operators.graph import ConvergenceError, hits, in_set_edges, out_degree, pagerank

TERMS = ["Player", "Games", "Assists", "Last", "Rebounds", "Points"]
# Golden per-document counts of the six query terms (documents 1..10).
COUNTS = [(0, 0, 3, 1, 1, 4), (3, 1, 3, 1, 1, 6), (3, 0, 0, 1, 0, 0), (3, 0, 1, 1, 0, 1),
          (3, 0, 1, 1, 0, 7), (2, 0, 4, 1, 0, 5), (2, 0, 1, 1, 0, 2), (2, 0, 0, 1, 1, 1),
          (3, 0, 1, 1, 0, 2), (2, 0, 0, 1, 0, 4)]


def _golden(spark):
    wide = spark.createDataFrame([(i + 1, *c) for i, c in enumerate(COUNTS)],
                                 "doc int, " + ", ".join(f"{t} int" for t in TERMS))
    long = TF.term_counts_long(wide, ["doc"], TERMS)
    idf = TF.idf(TF.document_frequency(long), TF.n_documents(wide))
    return long, idf


def test_idf_golden(spark):
    _, idf = _golden(spark)
    got = {r.term: (r.df, round(r.idf, 6)) for r in idf.collect()}
    assert got == {"Player": (9, 0.045757), "Games": (1, 1.0), "Assists": (7, 0.154902),
                   "Last": (10, 0.0), "Rebounds": (3, 0.522879), "Points": (9, 0.045757)}


def test_tfidf_golden_and_search(spark):
    long, idf = _golden(spark)
    w = TF.tfidf(long, idf)
    got = {(r.doc, r.term): round(r.tfidf, 6) for r in w.collect()}
    assert got[(1, "Assists")] == 0.228809
    assert got[(6, "Assists")] == 0.248162
    assert got[(5, "Points")] == 0.084427
    assert got[(3, "Points")] == 0.0  # count 0 -> tf 0
    assert all(v >= 0 for v in got.values())
    top = TF.search_top_k(w, ["doc"], 3).orderBy("rank").collect()
    assert top[0].doc == 2 and [r.rank for r in top] == [1, 2, 3]
    m = TF.tfidf_matrix(w, "doc", list(range(1, 11))).where("term = 'Games'").first()
    assert round(m["2"], 6) == 1.0 and m["1"] == 0.0


def test_sublinear_tf_values(spark):
    r = spark.createDataFrame([(3,), (4,), (6,), (0,)], "n int") \
        .select(F.round(TF.sublinear_tf(F.col("n")), 3).alias("tf")).collect()
    assert [x.tf for x in r] == [1.477, 1.602, 1.778, 0.0]


def test_term_counts_from_html(spark):
    html = "<p>Games, games</p><td>Last</td><td>Points</td> points player"
    df = spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string")
    r = TF.term_counts_wide(df, ["page_id", "url"], html_raw_text("html"), TERMS).first()
    # "Games," keeps its comma and "games" is glued to the next cell: "gameslastpoints"
    assert (r.Player, r.Games, r.Assists, r.Last, r.Rebounds, r.Points) == (1, 0, 0, 0, 0, 1)


def _np_pagerank(nodes, edges, alpha=0.85, tol=1e-6, max_iter=100):
    idx = {v: i for i, v in enumerate(nodes)}
    n = len(nodes)
    out = {v: [d for s, d in edges if s == v] for v in nodes}
    x = np.full(n, 1.0 / n)
    for _ in range(max_iter):
        last = x
        x = np.zeros(n)
        dangle = alpha * sum(last[idx[v]] for v in nodes if not out[v])
        for v in nodes:
            for d in out[v]:
                x[idx[d]] += alpha * last[idx[v]] / len(out[v])
        x += dangle / n + (1 - alpha) / n
        if np.abs(x - last).sum() < n * tol:
            return {v: x[idx[v]] for v in nodes}
    raise AssertionError("no convergence")


GRAPH_NODES = ["a", "b", "c", "d", "e"]
GRAPH_EDGES = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "d"), ("a", "b")]


def test_pagerank_matches_power_iteration(spark):
    v = spark.createDataFrame([(x,) for x in GRAPH_NODES], "id string")
    e = spark.createDataFrame(GRAPH_EDGES, "src string, dst string")
    got = {r.id: r.rank for r in pagerank(v, e).collect()}
    want = _np_pagerank(GRAPH_NODES, sorted(set(GRAPH_EDGES)))
    assert set(got) == set(GRAPH_NODES)  # isolated node e kept
    assert abs(sum(got.values()) - 1.0) < 1e-9
    for k in GRAPH_NODES:
        assert abs(got[k] - want[k]) < 1e-5
    with pytest.raises(ConvergenceError):
        pagerank(v, e, max_iter=2)


def test_hits_scores(spark):
    v = spark.createDataFrame([(x,) for x in GRAPH_NODES], "id string")
    e = spark.createDataFrame(GRAPH_EDGES, "src string, dst string")
    got = {r.id: (r.hub, r.authority) for r in hits(v, e, tol=1e-12).collect()}
    idx = {x: i for i, x in enumerate(GRAPH_NODES)}
    A = np.zeros((5, 5))
    for s, d in set(GRAPH_EDGES):
        A[idx[s], idx[d]] = 1
    h = np.full(5, 0.2)
    for _ in range(50):
        a = A.T @ h
        a /= a.max()
        h = A @ a
        h /= h.max()
    h, a = h / h.sum(), a / a.sum()
    for x in GRAPH_NODES:
        assert abs(got[x][0] - h[idx[x]]) < 1e-6 and abs(got[x][1] - a[idx[x]]) < 1e-6


def test_in_set_edges_and_out_degree(spark):
    links = spark.createDataFrame([("p1", "p2"), ("p1", "p1"), ("p1", "x"), ("p2", "p1"), ("p2", "p1")],
                                  "src string, dst string")
    nodes = spark.createDataFrame([("p1",), ("p2",)], "id string")
    e = in_set_edges(links, nodes)
    assert sorted((r.src, r.dst) for r in e.distinct().collect()) == [("p1", "p2"), ("p2", "p1")]
    deg = {r.src: r.out_degree for r in out_degree(links).collect()}
    assert deg == {"p1": 3, "p2": 1}


def test_precision_recall_golden(spark):
    retrieved = spark.createDataFrame([(u, p) for u in ("a", "b") for p in range(1, 11)],
                                      "query string, doc_id int")
    marks = {"a": {1, 2, 3, 5, 6, 7, 8}, "b": {1, 2, 5, 6, 10}}
    for user, rel in marks.items():
        judged = spark.createDataFrame([(p, p in rel) for p in range(1, 11)], "doc_id int, relevant boolean")
        q = spark.createDataFrame([(user,)], "query string")
        r = precision_recall_by_query(q, retrieved.where(F.col("query") == user), judged).first()
        assert r.precision == len(rel) / 10 and r.recall == 1.0 and r.n_relevant == len(rel)
    judged = spark.createDataFrame([(p, True) for p in range(1, 21)], "doc_id int, relevant boolean")
    r = precision_recall_by_query(spark.createDataFrame([("a",)], "query string"),
                                  retrieved.where("query = 'a'"), judged).first()
    assert (r.precision, r.recall) == (1.0, 0.5)


def test_graph_with_hub_is_salted_and_exact(spark):
    """A hub holds most edges in both directions; salting must not change results."""
    from courtside.operators.graph import _hot_nodes
    nodes = [f"n{i}" for i in range(40)]
    edges = [("hub", x) for x in nodes] + [(x, "hub") for x in nodes[:30]] + [("n1", "n2"), ("n2", "n3")]
    v = spark.createDataFrame([(x,) for x in nodes + ["hub"]], "id string")
    e = spark.createDataFrame(edges, "src string, dst string")
    # 40 of 72 edges leave the hub; a fair share over 8 partitions is 9 -> 5 buckets
    assert {r.id: r.salts for r in _hot_nodes(e, "src", 8).collect()} == {"hub": 5}
    assert {r.id: r.salts for r in _hot_nodes(e, "dst", 8).collect()} == {"hub": 4}
    assert _hot_nodes(e, "src", 1) is None  # one partition: nothing exceeds its share
    want = _np_pagerank(nodes + ["hub"], edges)
    salted = {r.id: r.rank for r in pagerank(v, e, num_partitions=8).collect()}
    plain = {r.id: r.rank for r in pagerank(v, e, num_partitions=1).collect()}
    for k in want:
        assert abs(salted[k] - want[k]) < 1e-5 and abs(salted[k] - plain[k]) < 1e-12
    h8 = {r.id: (r.hub, r.authority) for r in hits(v, e, tol=1e-12, num_partitions=8).collect()}
    h1 = {r.id: (r.hub, r.authority) for r in hits(v, e, tol=1e-12, num_partitions=1).collect()}
    for k in h1:
        assert abs(h8[k][0] - h1[k][0]) < 1e-12 and abs(h8[k][1] - h1[k][1]) < 1e-12


def test_empty_graph(spark):
    v = spark.createDataFrame([], "id string")
    e = spark.createDataFrame([], "src string, dst string")
    assert pagerank(v, e).count() == 0
    assert hits(v, e).count() == 0
    lone = spark.createDataFrame([("a",), ("b",)], "id string")
    ranks = {r.id: r.rank for r in pagerank(lone, e).collect()}
    assert ranks == {"a": 0.5, "b": 0.5}  # no edges: all mass is dangling, spread evenly


def test_edges_outside_the_vertex_set_lose_no_rank(spark):
    v = spark.createDataFrame([(1,), (2,)], "id long")
    e = spark.createDataFrame([(1, 2), (1, 9), (2, 1)], "src long, dst long")
    ranks = {r.id: r.rank for r in pagerank(v, e, tol=1e-12, max_iter=300).collect()}
    assert set(ranks) == {1, 2, 9} and abs(sum(ranks.values()) - 1) < 1e-9
    # the stationary distribution as a linear system
    m = np.array([[0, 1, 1 / 3], [0.5, 0, 1 / 3], [0.5, 0, 1 / 3]])  # column: from 1, 2, 9 (9 is dangling)
    want = np.linalg.solve(np.eye(3) - 0.85 * m, np.full(3, 0.05))
    assert np.allclose([ranks[k] for k in (1, 2, 9)], want, atol=1e-8)
    scores = {r.id: (r.hub, r.authority) for r in hits(v, e).collect()}
    assert set(scores) == {1, 2, 9} and scores[9][1] > 0


def test_hits_raises_without_convergence(spark):
    v = spark.createDataFrame([(x,) for x in GRAPH_NODES], "id string")
    e = spark.createDataFrame(GRAPH_EDGES, "src string, dst string")
    with pytest.raises(ConvergenceError):
        hits(v, e, tol=0.0, max_iter=5)


@pytest.mark.parametrize("hub", [False, True])
@pytest.mark.parametrize("key, other", [("src", "dst"), ("dst", "src")])
def test_a_step_does_not_shuffle_the_edges(spark, hub, key, other):
    """With broadcast off, the edges of a step's join (PageRank joins on src, HITS on both) have no exchange."""
    from courtside.operators import graph as G
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(k % 60, (k * 7) % 60) for k in range(400)] + ([(0, k) for k in range(60)] + [(k, 0) for k in range(60)] if hub else [])
        e = spark.createDataFrame(sorted(set(rows)), "src long, dst long")
        hot = G._hot_nodes(e, key, 4) if hub else None
        edges = G._salted_edges(e, key, other, hot, 4)
        values = spark.range(60).selectExpr("id", "double(id) as rank").checkpoint()
        plan = G._join_edges(values, edges, key, hot)._jdf.queryExecution().executedPlan()
        text = plan.toString()
        # the edges are the scan with the salt column: nothing but a sort stands between it and the join
        lines = text.split("\n")
        at = next(i for i, x in enumerate(lines) if "Scan ExistingRDD" in x and "src#" in x and "dst#" in x)
        depth = lines[at].index("Scan") if "Scan" in lines[at] else 0
        above = []
        for x in reversed(lines[:at]):
            d = len(x) - len(x.lstrip(" :+-*(0123456789)"))
            if d < depth:
                above.append(x)
                depth = d
            if "Join" in x:
                break
        assert above and not any("Exchange" in x for x in above), text
        assert any("Exchange" in x for x in lines)  # the values do move
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
