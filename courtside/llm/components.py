"""Connected components of an edge table by alternating stars.

Edges are first contracted inside each partition (a spanning forest of at
most as many edges).  While more edges are left than one task may take,
large-star and small-star steps alternate until nothing changes; each step is
a group minimum and a join.  Nothing passes the driver but one count per
round.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import materialize, ship_code


def _contract(batches):
    """Edges (a, b) of one partition as (node, root): a forest with the same components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = x = parent.get(p, p)
        return x

    for b in batches:
        for x, y in zip(b["a"].to_pylist(), b["b"].to_pylist()):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                parent.setdefault(min(x, y), min(x, y))
    nodes = [x for x in parent if parent[x] != x]
    for k in range(0, len(nodes), 1 << 16):
        part = nodes[k:k + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], names=["a", "b"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    met = down.join(least, "a")
    return met.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()


#: Edges that one task may contract alone; its forest then is the answer.
TASK_EDGES = 1 << 20


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, comp) of every node with an edge to another; comp is the least node of its component.

    Partitions are contracted first; when at most ``task_edges`` edges are
    left, one task contracts them too, else the stars go on.  Both give the
    same components.
    """
    ship_code(edges.sparkSession)
    now = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b").mapInArrow(_contract, "a long, b long")
    now = materialize(now, "edges")
    while now.count() > task_edges:
        after = materialize(_small_star(_large_star(now)).mapInArrow(_contract, "a long, b long"), "edges")
        # a star forest: no root is another's member, and each member has one root
        if after.select("b").distinct().join(after.select(F.col("a").alias("b")), "b", "left_semi").isEmpty() and \
                after.groupBy("a").agg(F.countDistinct("b").alias("n")).filter("n > 1").isEmpty():
            return _with_roots(after.distinct())
        now = after
    return _with_roots(now.coalesce(1).mapInArrow(_contract, "a long, b long"))


def _with_roots(forest: DataFrame) -> DataFrame:
    return forest.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(forest.select("b", "b").distinct())
