"""Link graphs: build, out-degree, PageRank, HITS.

PageRank and HITS are iterative DataFrame jobs.  Per step, node values are
joined with the edge list and summed per target with map-side combine.  The
edge list is checkpointed once, hash-partitioned by join node, with adaptive
execution off for that one action: a frame written under adaptive execution
forgets its partitioning, and every step would shuffle all edges again.  So
only the vertex-sized side moves in a step.  Hub nodes, whose edges exceed one partition's share, have their
edges salted over several buckets and their value replicated per bucket, so
a node holding a third of all edges never lands in a single task.

Each step brings back one row to the driver: the L1 change and the rank
mass on dangling nodes (PageRank), or the maxima used for scaling (HITS).
Step results are persisted and written with a reliable ``checkpoint()``
every few steps, which bounds the lineage and lets a lost executor recompute
from the last checkpoint instead of from the first step.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.operators.dictionary import decode, dense_ids, encode
from courtside.session import ensure_checkpoint_dir


class ConvergenceError(RuntimeError):
    """Power iteration did not reach the tolerance within ``max_iter`` steps."""


def in_set_edges(links: DataFrame, nodes: DataFrame, node_col: str = "id") -> DataFrame:
    """Keep links whose target is a known node and which are not self-links.

    ``links``: ``src, dst``.  A semi join (no columns added, no duplicates),
    then the theta condition ``src <> dst``.
    """
    known = nodes.select(F.col(node_col).alias("__cs_node"))
    return (links.join(known, links.dst == known.__cs_node, "left_semi")
                 .where(F.col("src") != F.col("dst")))


def out_degree(edges: DataFrame) -> DataFrame:
    """``src, out_degree`` over distinct edges."""
    return edges.select("src", "dst").distinct().groupBy("src").agg(
        F.count(F.lit(1)).alias("out_degree"))


@contextmanager
def _fixed_partitioning(spark):
    """Adaptive execution off: what is checkpointed inside keeps its partitioning."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _partitioned(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` hash-partitioned by ``keys`` and checkpointed, in a form whose joins on ``keys`` need no exchange of it."""
    with _fixed_partitioning(df.sparkSession):
        return df.repartition(parts, *keys).checkpoint(eager=True)


def with_endpoints(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``id``: the vertices and every endpoint of an edge, as adding an edge adds its nodes."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return vertices.select("id").union(ends).where(F.col("id").isNotNull()).distinct()


# Rows per partition of the iteration state (vertices, edges).
ROWS_PER_PARTITION = 2_000_000


def _partitions(df: DataFrame, rows: int | None = None) -> int:
    """Partitions for the iteration state: by size, capped at the shuffle setting.

    A small graph runs each step in a few tasks instead of paying scheduling
    overhead for hundreds of near-empty ones; a large graph gets the full
    shuffle parallelism.
    """
    cap = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rows is None:
        return cap
    return max(1, min(cap, -(-rows // ROWS_PER_PARTITION)))


def _hot_nodes(edges: DataFrame, key: str, parts: int) -> DataFrame | None:
    """``id, salts`` for nodes whose edges exceed one partition's fair share (None if none).

    A hot node gets ``ceil(degree / share)`` salt buckets.  Every hot node has
    more than ``total / parts`` edges, so there are fewer hot nodes than
    partitions: the table is small by construction and is broadcast.
    """
    deg = edges.groupBy(key).agg(F.count(F.lit(1)).alias("deg"))
    total = edges.select(F.count(F.lit(1))).first()[0]
    share = max(1, -(-total // parts))
    hot = (deg.where(F.col("deg") > share)
              .select(F.col(key).alias("id"), F.ceil(F.col("deg") / F.lit(share)).cast("int").alias("salts"))
              .checkpoint(eager=True))
    return hot if hot.limit(1).count() else None


def _salted_edges(edges: DataFrame, key: str, other: str, hot: DataFrame | None,
                  parts: int) -> DataFrame:
    """Edges with a ``salt`` spreading each hot node's edges over its buckets.

    Partitioned by ``(key, salt)``: a node with a third of all edges is split
    into partition-sized pieces instead of landing in one task every step.
    Without hot nodes (``hot is None``) the edges are partitioned by ``key``
    alone and the per-step join needs no exchange on either side.
    """
    if hot is None:
        return _partitioned(edges.withColumn("salt", F.lit(0)), parts, key)
    salted = (edges.join(F.broadcast(hot), edges[key] == hot.id, "left")
                   .select(*[edges[c] for c in edges.columns],
                           F.coalesce(F.pmod(F.xxhash64(edges[other]), F.col("salts")), F.lit(0))
                            .cast("int").alias("salt")))
    return _partitioned(salted, parts, key, "salt")


def _join_edges(values: DataFrame, edges: DataFrame, key: str, hot: DataFrame | None) -> DataFrame:
    """Join node values (``id``) to the edges on ``key``, salted when there are hubs.

    With hubs, each hub's value is replicated once per salt bucket and the
    join is on ``(node, salt)``, matching the edges' partitioning.  Without,
    the join is on the node alone, which the edges are partitioned by.
    """
    if hot is None:
        return values.join(edges, values.id == edges[key])
    n = F.coalesce(F.col("salts"), F.lit(1))
    side = (values.join(F.broadcast(hot), "id", "left")
                  .select(*[F.col(c) for c in values.columns],
                          F.explode(F.sequence(F.lit(0), n - 1)).alias("salt")))
    return side.join(edges, (side.id == edges[key]) & (side.salt == edges.salt))


def _keep(df: DataFrame, step: int, interval: int) -> DataFrame:
    """Persist a step's result; every ``interval`` steps write a reliable checkpoint."""
    if step % interval == 0:
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def pagerank(vertices: DataFrame, edges: DataFrame, alpha: float = 0.85, tol: float = 1e-6,
             max_iter: int = 100, checkpoint_interval: int = 5, num_partitions: int | None = None) -> DataFrame:
    """``id, rank`` by power iteration.

    Uniform start and teleport, the rank of dangling nodes spread uniformly;
    stops when the L1 change is below ``N * tol``, and raises
    ``ConvergenceError`` after ``max_iter`` steps.  Endpoints of edges that
    ``vertices`` lacks are nodes too, so no rank is lost.  Ranks sum to 1.

    Each step is one job: it materialises the new ranks and returns, in one
    row, the L1 change and the rank mass on dangling nodes for the next step.
    """
    spark = vertices.sparkSession
    ensure_checkpoint_dir(spark)
    # The input edges (often a whole join pipeline) are materialised once;
    # weights, out-degrees and dangling flags all derive from that copy.
    e = edges.select("src", "dst").where("src is not null and dst is not null").distinct().checkpoint(eager=True)
    v = with_endpoints(vertices, e).checkpoint(eager=True)
    n = v.count()
    deg = e.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    w = e.join(deg, "src").select("src", "dst", (F.lit(1.0) / F.col("deg")).alias("w"))
    parts = num_partitions or _partitions(vertices, max(n, e.count()))
    hot = _hot_nodes(w, "src", parts)
    w = _salted_edges(w, "src", "dst", hot, parts)
    if n == 0:
        return v.select("id", F.lit(None).cast("double").alias("rank"))
    v = _partitioned(v.join(deg.select(F.col("src").alias("id"), F.lit(False).alias("has_out")), "id", "left")
                      .select("id", F.col("has_out").isNull().alias("dangling")), parts, "id")
    n_dangling = v.select(F.count_if("dangling")).first()[0]

    ranks = v.select("id", "dangling", F.lit(1.0 / n).alias("rank"))
    dangling_mass = n_dangling / n
    converged = False
    for step in range(1, max_iter + 1):
        contrib = (_join_edges(ranks.select("id", "rank"), w, "src", hot)
                   .groupBy("dst").agg(F.sum(F.col("rank") * F.col("w")).alias("c")))
        base = alpha * dangling_mass / n + (1.0 - alpha) / n
        new = (v.join(contrib, v.id == contrib.dst, "left")
                .select("id", "dangling",
                        (F.lit(alpha) * F.coalesce(F.col("c"), F.lit(0.0)) + F.lit(base)).alias("rank")))
        new = _keep(new, step, checkpoint_interval)
        mass = F.coalesce(F.sum(F.when(F.col("dangling"), F.col("rank"))), F.lit(0.0))
        err, dangling_mass = (
            new.join(ranks.select("id", F.col("rank").alias("old")), "id")
               .select(F.sum(F.abs(F.col("rank") - F.col("old"))), mass).first())
        ranks.unpersist()
        ranks = new
        if err < n * tol:
            converged = True
            break
    if not converged:
        ranks.unpersist()
        raise ConvergenceError(f"pagerank did not converge in {max_iter} iterations")
    out = ranks.select("id", "rank").checkpoint(eager=True)
    ranks.unpersist()
    return out


def pagerank_by_key(vertices: DataFrame, edges: DataFrame, **options) -> DataFrame:
    """``key, rank`` of a graph whose nodes are strings.

    ``vertices``: ``key``; ``edges``: ``src, dst`` as keys.  Vertices with the
    same key are one node.  The keys become dense ids once, so what a step
    shuffles is a long and a double per node whatever the keys' length; the
    keys come back with the result.  ``options`` are those of ``pagerank``.
    """
    ensure_checkpoint_dir(vertices.sparkSession)
    own = edges.select("src", "dst").where("src is not null and dst is not null").distinct().checkpoint(eager=True)
    ids = dense_ids(vertices.select("key").union(own.select(F.explode(F.array("src", "dst")))), "key")
    numbered = encode(own, ids, {"src": "s", "dst": "d"}).select(F.col("s").alias("src"), F.col("d").alias("dst"))
    return decode(pagerank(ids.select("id"), numbered, **options), ids, "id", "key", "rank")


def _checkpoint_scaled(df: DataFrame, col: str) -> DataFrame:
    """Write ``df`` with a reliable checkpoint, ``col`` divided by its maximum."""
    df = df.checkpoint(eager=True)
    top = df.select(F.max(col)).first()[0]
    return df.select("id", (F.col(col) / F.lit(top)).alias(col)) if top else df


def _largest_change(new: DataFrame, old: DataFrame | None, col: str) -> float:
    """Largest absolute difference of two scaled vectors; infinite without an old one."""
    if old is None:
        return float("inf")
    both = new.select("id", F.col(col).alias("x")).join(old.select("id", F.col(col).alias("y")), "id", "full")
    return both.select(F.max(F.abs(F.coalesce("x", F.lit(0.0)) - F.coalesce("y", F.lit(0.0))))).first()[0] or 0.0


def hits(vertices: DataFrame, edges: DataFrame, tol: float = 1e-9, max_iter: int = 500,
         checkpoint_interval: int = 5, num_partitions: int | None = None) -> DataFrame:
    """``id, hub, authority`` by power iteration (I4, Kleinberg 1999).

    Per step: authority = sum of hub scores of in-neighbours, hub = sum of
    authority scores of out-neighbours.  Scores are kept sparse (a node with
    no in-links, or no out-links, scores 0 and contributes nothing), so a
    step is one join and one aggregate per vector; zeros are filled in once at
    the end.  Every ``checkpoint_interval`` steps both vectors are checkpointed
    and divided by their maximum; the steps in between stay lazy (each
    references the previous one once, so the plan grows linearly).  The
    iteration stops when neither scaled vector changed by ``tol`` or more since
    the checkpoint before, and raises ``ConvergenceError`` after ``max_iter``
    steps.  Endpoints of edges that ``vertices`` lacks are nodes too.  The
    result is normalised to sum 1 per score.
    """
    spark = vertices.sparkSession
    ensure_checkpoint_dir(spark)
    e = edges.select("src", "dst").where("src is not null and dst is not null").distinct().checkpoint(eager=True)
    v = with_endpoints(vertices, e).checkpoint(eager=True)
    n, n_edges = v.count(), e.count()
    parts = num_partitions or _partitions(vertices, max(n, n_edges))
    if n == 0 or n_edges == 0:
        zero = F.lit(0.0) if n else F.lit(None).cast("double")
        return v.select("id", zero.alias("hub"), zero.alias("authority"))
    # Two copies of the edge list, one per join direction, each salted on its
    # join key so a hub (by out- or in-degree) is split across tasks.
    hot_src = _hot_nodes(e, "src", parts)
    hot_dst = _hot_nodes(e, "dst", parts)
    e_src = _salted_edges(e, "src", "dst", hot_src, parts)
    e_dst = _salted_edges(e, "dst", "src", hot_dst, parts)
    hub, auth = v.select("id", F.lit(1.0 / n).alias("hub")), None
    last_hub = last_auth = None
    converged = False
    for step in range(1, max_iter + 1):
        auth = (_join_edges(hub, e_src, "src", hot_src)
                .groupBy("dst").agg(F.sum("hub").alias("authority"))
                .select(F.col("dst").alias("id"), "authority"))
        at_checkpoint = step % checkpoint_interval == 0 or step == max_iter
        if at_checkpoint:
            auth = _checkpoint_scaled(auth, "authority")
        hub = (_join_edges(auth, e_dst, "dst", hot_dst)
               .groupBy("src").agg(F.sum("authority").alias("hub"))
               .select(F.col("src").alias("id"), "hub"))
        if at_checkpoint:
            hub = _checkpoint_scaled(hub, "hub")
            converged = _largest_change(auth, last_auth, "authority") < tol and _largest_change(hub, last_hub, "hub") < tol
            if converged:
                break
            last_hub, last_auth = hub, auth
    if not converged:
        raise ConvergenceError(f"hits did not converge in {max_iter} iterations")
    hs = hub.select(F.sum("hub")).first()[0]
    as_ = auth.select(F.sum("authority")).first()[0]
    full = (v.join(hub, "id", "left").join(auth, "id", "left")
             .select("id", F.coalesce("hub", F.lit(0.0)).alias("hub"),
                     F.coalesce("authority", F.lit(0.0)).alias("authority")))
    return full.select("id", (F.col("hub") / F.lit(hs)).alias("hub"), (F.col("authority") / F.lit(as_)).alias("authority"))
