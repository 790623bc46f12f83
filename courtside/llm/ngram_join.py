"""N-gram Jaccard self-join by vertical partitioning, and the groups that its links make.

A document's set is its distinct shingles of ``N`` words as 64-bit hashes (a
shorter text is one shingle).  Two documents link when their sets' Jaccard
similarity is at least ``percent`` / 100; the result is every document's
component.  Documents with one set form a class and are one node from then
on, so copies never meet each other.

1. *Global order.*  Shingles are ordered by how many nodes have them, as far
   as counts in chunks of documents show it (classes of powers of two; what is
   not frequent comes first), then by hash.  Any order gives the same links;
   this one keeps frequent passages out of the prefixes.  The frequent ones
   are at most (mean set size / ``FREQUENT_SHARE``), however large the corpus.
2. *Prefixes by fragments.*  Each set's prefix in that order (the first
   n - ceil(0.75 n) + 1 + n / MORE shingles) is cut by ranges of hashes into
   buckets.  A bucket counts the shingles that pairs of nodes share there, in
   groups of up to ``SMALL_GROUP`` nodes with a common shingle; the counts are
   summed per pair.  Linked sets must share a known part of their prefixes
   (``least_in_prefix``); pairs with less, counting all they could share in
   larger groups, go.
3. *Vertical partitioning.*  The sets of the remaining pairs are cut at fixed
   places of the hash order into ``FRAGMENTS``; the overlaps of a pair are
   counted in each fragment separately and summed per pair.
4. *Large groups.*  Nodes that share enough shingles of large groups and are
   in different components are paired with a pivot of their group: in rounds,
   with ``PIVOTS`` different ones over all groups of one set of near copies,
   drawn from those with the most links so far; in the end with all nodes of
   other components in the group.  So every pair that could link is either
   counted or already connected; copies of copies do not all meet.

Defined results: a document without words, or without text, has an empty set
and is linked with nothing, other empty ones included; a null ``doc_id`` is a
document, and a component's id is its smallest doc_id that is not null;
repeated rows are copies of each other; an empty table gives no rows.  Equal
doc_ids are told apart by their texts' hashes; a text of any length is one
document of its task.  Extra columns of any name are ignored by the join and
kept by ``keep_first``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import materialize, ship_code, slices
from courtside.llm.components import components
from courtside.llm.hashing import mix, stretch_hashes

N = 5
PERCENT = 75
FRAGMENTS = 8
#: Share of the nodes from which on a shingle is ordered as frequent.
FREQUENT_SHARE = 0.0005
FREQUENT_LEAST = 32
SMALL_GROUP = 24
#: A prefix is longer by the set's size / MORE than one common shingle would take.
MORE = 20
#: Rounds, and the different pivots that nodes of one large group of near copies meet in each, over all their shingles.
PIVOTS = (8, 48)
CHUNK = 1 << 21  # shingles (or entries) that a task holds before it hands them on
GROUP_BYTES = 1 << 20  # texts hashed at once

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE = np.array([c == 0x20 or 0x09 <= c <= 0x0D for c in range(256)])
_MULT = np.array([0x9E3779B97F4A7C15], np.uint64)
_ENTRY = np.dtype([("key", "<u8"), ("node", "<i8"), ("size", "<u4")])


def word_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lower-cased bytes, and where each word begins."""
    inside = np.concatenate([[False], ~_SPACE[text], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    return stretch_hashes(text, start, end), start


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def shingle_sets(texts: list[bytes | None], n: int = N):
    """Sorted distinct shingle hashes of each UTF-8 text in turn."""
    at = 0
    while at < len(texts):
        held, size = [], 0
        while at < len(texts) and size < GROUP_BYTES:
            held.append(texts[at] or b"")
            size += len(held[-1]) + 1
            at += 1
        joined = b" ".join(held).translate(_LOWER)
        own, start = [], []
        k = 0
        while k < len(joined):  # long stretches are cut at a space
            cut = joined.find(b" ", k + GROUP_BYTES) if len(joined) - k > 2 * GROUP_BYTES else -1
            stop = len(joined) if cut < 0 else cut
            h, s = word_hashes(np.frombuffer(joined, np.uint8, stop - k, k))
            own.append(h)
            start.append(s + k)
            k = stop
        h, start = (np.concatenate(own), np.concatenate(start)) if own else (np.zeros(0, np.uint64), np.zeros(0, int))
        first = np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in held]))
        grams = np.zeros(len(h), np.uint64)
        for k in range(min(n, len(h))):
            grams[:len(h) - k] = grams[:len(h) - k] * _MULT + h[k:]
        grams = mix(grams)
        for x, y in zip(first[:-1].tolist(), first[1:].tolist()):
            if y - x >= n:
                yield _distinct(grams[x:y - n + 1])
            elif y > x:  # one shingle, told apart by its number of words
                whole = np.zeros(1, np.uint64)
                for v in h[x:y]:
                    whole = whole * _MULT + v
                yield mix(whole + np.array([y - x], np.uint64) * _MULT)
            else:
                yield np.zeros(0, np.uint64)


def node_of(own: np.ndarray) -> int:
    """The class of a set, as a signed 64-bit number."""
    h = xxhash.xxh3_64_intdigest(own.tobytes())
    return h - (1 << 64) if h >> 63 else h


def beyond_prefix(n, percent: int = PERCENT):
    """Shingles after the prefix: so few that linked sets share at least 1 + n / MORE of their prefixes."""
    return (percent * n + 99) // 100 - 1 - n // MORE


def prefix_length(n, percent: int = PERCENT):
    return n - beyond_prefix(n, percent)


def least_overlap(size_a, size_b, percent: int = PERCENT):
    """Common shingles that a link takes."""
    return (percent * (size_a + size_b) + 99 + percent) // (100 + percent)


def least_in_prefix(size_a, size_b, percent: int = PERCENT):
    """Shingles that linked sets have in common in their prefixes: at most one set's rest can lie beyond."""
    return least_overlap(size_a, size_b, percent) - np.maximum(beyond_prefix(size_a, percent), beyond_prefix(size_b, percent))


MEMBERS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()), T.StructField("n_shingles", T.LongType()),
                        T.StructField("node", T.LongType()), T.StructField("often", T.BinaryType()), T.StructField("counts", T.BinaryType())])


def members(docs: DataFrame, n: int = N) -> DataFrame:
    """(doc_id, text_hash, n_shingles, node) per document; beside them, on some rows, shingles that
    several nodes of the same chunk have, and how many."""
    ship_code(docs.sparkSession)
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))

    def often(sets: list[np.ndarray]) -> tuple[bytes, bytes]:
        ranked = np.sort(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        edge = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])) if len(ranked) else np.zeros(1, int)
        count = np.diff(edge)
        found = np.flatnonzero(count >= 3)
        return ranked[edge[found]].tobytes(), count[found].astype("<u4").tobytes()

    def run(batches):
        seen, sets, total = set(), [], 0
        for b in slices(batches):
            sizes, nodes, one, many = [], [], [None] * b.num_rows, [None] * b.num_rows
            for own in shingle_sets(b["text"].cast(pa.binary()).to_pylist(), n):
                sizes.append(len(own))
                nodes.append(node_of(own))
                if len(own) and nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    sets.append(own)
                    total += len(own)
            if total >= CHUNK:
                one[-1], many[-1] = often(sets)
                seen, sets, total = set(), [], 0
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_hash"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(one, pa.binary()), pa.array(many, pa.binary())], names=MEMBERS.names)
        if sets:
            one, many = often(sets)
            if one:  # a row without a document
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * 4 + [pa.array([one], pa.binary()), pa.array([many], pa.binary())], names=MEMBERS.names)

    return held.mapInArrow(run, MEMBERS)


def frequent_shingles(rows: DataFrame, n_nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and the power of two of their counts."""
    least = max(FREQUENT_LEAST, int(FREQUENT_SHARE * n_nodes))
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("c", T.LongType())])

    def run(batches):
        for b in slices(batches, 1):
            if b["often"][0].is_valid:
                h = np.frombuffer(b["often"][0].as_py(), "<u8").view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.frombuffer(b["counts"][0].as_py(), "<u4").astype(np.int64))], names=["h", "c"])

    found = rows.filter("often is not null").select("often", "counts").mapInArrow(run, schema).groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= least).toArrow()
    h = found["h"].to_numpy().view(np.uint64)
    level = np.array([c.bit_length() for c in found["c"].to_pylist()], np.uint8)
    order = np.argsort(h)
    return h[order], level[order]


def in_order(own: np.ndarray, often: np.ndarray, level: np.ndarray) -> np.ndarray:
    """A sorted set's shingles in the global order."""
    if not len(often):
        return own
    at = np.minimum(np.searchsorted(often, own), len(often) - 1)
    found = often[at] == own
    if not found.any():
        return own
    return own[np.argsort(np.where(found, level[at], 0), kind="stable")]


def prefix_entries(docs: DataFrame, often: np.ndarray, level: np.ndarray, buckets: int, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(bucket, entries): prefix shingles of all nodes as packed records, dealt by hash ranges."""
    order = docs.sparkSession.sparkContext.broadcast((often, level))
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("entries", T.BinaryType())])

    def run(batches):
        seen, held, total = set(), [], 0

        def rows():
            own = np.concatenate(held)
            bucket = ((own["key"] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            rank = np.argsort(bucket, kind="stable")
            own, edge = own[rank], np.searchsorted(bucket[rank], np.arange(buckets + 1))
            raw = own.tobytes()
            full = np.flatnonzero(np.diff(edge))
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([raw[edge[k] * _ENTRY.itemsize:edge[k + 1] * _ENTRY.itemsize] for k in full], pa.binary())], names=schema.names)

        for b in slices(batches):
            for own in shingle_sets(b["text"].cast(pa.binary()).to_pylist(), n):
                if not len(own) or (node := node_of(own)) in seen:
                    continue
                seen.add(node)
                size = prefix_length(len(own), percent)
                out = np.empty(size, _ENTRY)
                out["key"], out["node"], out["size"] = in_order(own, *order.value)[:size], node, len(own)
                held.append(out)
                total += size
            if total >= CHUNK // 2:
                yield from rows()
                held, total = [], 0
        if held:
            yield from rows()

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _groups(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries without repeats and without shingles of a single node, by shingle and size; the start and length of each group."""
    own = own[np.lexsort((own["node"], own["size"], own["key"]))]
    fresh = np.ones(len(own), bool)
    fresh[1:] = (own["key"][1:] != own["key"][:-1]) | (own["node"][1:] != own["node"][:-1])
    own = own[fresh]
    edge = np.flatnonzero(np.concatenate([[True], own["key"][1:] != own["key"][:-1], [True]])) if len(own) else np.zeros(1, int)
    size = np.diff(edge)
    own = own[np.repeat(size > 1, size)]
    size = size[size > 1]
    return own, np.cumsum(size) - size, size


def _pairs(own: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Distinct (a, b, size of a, size of b, times), a below b, of the entries i and j whose sizes allow a link."""
    a, b = own[i], own[j]
    low, high = np.minimum(a["size"], b["size"]).astype(np.int64), np.maximum(a["size"], b["size"]).astype(np.int64)
    ok = (100 * low >= percent * high) & (a["node"] != b["node"])
    if "often" in own.dtype.names:  # as many common shingles in large groups as either has there at most
        ok &= np.minimum(a["often"], b["often"]) >= least_in_prefix(low, high, percent)
    a, b = a[ok], b[ok]
    swap = a["node"] > b["node"]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    rank = np.lexsort((b["node"], a["node"]))
    a, b = a[rank], b[rank]
    edge = np.flatnonzero(np.concatenate([[True], (a["node"][1:] != a["node"][:-1]) | (b["node"][1:] != b["node"][:-1])])) if len(a) else np.zeros(0, int)
    times = np.diff(np.concatenate([edge, [len(a)]]))
    a, b = a[edge], b[edge]
    return np.stack([a["node"], b["node"], a["size"].astype(np.int64), b["size"].astype(np.int64), times], axis=1)


def pivot_of(own: np.ndarray, seed: int, pivots: int) -> int:
    """A group's pivot: of the nodes with the most links so far (up to the first round's pivots) the first in one of ``pivots`` random orders."""
    best = np.flatnonzero(own["links"] == own["links"].max())
    order = mix(own["node"][best].view(np.uint64) ^ mix(own["key"][:1] % np.uint64(pivots) + np.array([seed << 20], np.uint64)))
    return int(best[order.argmin()])


FOUND = T.StructType([T.StructField("kind", T.ByteType()), T.StructField("key", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                      T.StructField("size_a", T.IntegerType()), T.StructField("size_b", T.IntegerType()), T.StructField("times", T.IntegerType())])


def candidates(entries: DataFrame, percent: int = PERCENT, small_group: int = SMALL_GROUP) -> DataFrame:
    """Rows of kind 0: pairs with the number of shingles that they share in small groups of one bucket;
    of kind 1: entries of large groups."""
    def find(own: np.ndarray):
        own, start, size = _groups(own)
        if not len(own):
            return
        group = np.repeat(np.arange(len(size)), size)
        large = np.repeat(size > small_group, size)
        i = [np.flatnonzero((group[:-d] == group[d:]) & ~large[:-d]) for d in range(1, small_group)]
        pairs = _pairs(own, np.concatenate([*i, np.zeros(0, int)]), np.concatenate([*(x + d for d, x in enumerate(i, 1)), np.zeros(0, int)]), percent)
        m, rest = len(pairs), own[large]
        if m:
            yield [np.zeros(m, np.int8), np.zeros(m, np.int64), pairs[:, 0], pairs[:, 1], *(pairs[:, k].astype(np.int32) for k in (2, 3, 4))]
        if len(rest):
            zero = np.zeros(len(rest), np.int32)
            yield [np.ones(len(rest), np.int8), rest["key"].view(np.int64), rest["node"], np.zeros(len(rest), np.int64), rest["size"].astype(np.int32), zero, zero]

    def run(batches):
        bucket, held = None, []
        for b in batches:
            for k, raw in zip(b["bucket"].to_pylist(), b["entries"]):
                if k != bucket and held:
                    for cols in find(np.concatenate(held)):
                        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=FOUND.names)
                    held = []
                bucket = k
                held.append(np.frombuffer(raw.as_buffer(), _ENTRY))
        if held:
            for cols in find(np.concatenate(held)):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=FOUND.names)

    return entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, FOUND)


def _to_count(found: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs that share enough of their prefixes (summed over all buckets), and entries of large groups whose node can.

    A pair that meets in small groups shares there what was counted, and in large groups at most as many
    shingles as either node has there.  A pair that meets in large groups only shares no more than that.
    """
    def whole(expr):
        return F.floor(expr).cast("long")

    def beyond(size):
        return whole((percent * size + 99) / 100) - 1 - whole(size / MORE)

    entries = found.filter("kind = 1").select("key", F.col("a").alias("node"), F.col("size_a").cast("long").alias("size"))
    often = entries.groupBy("node", "size").agg(F.count("*").alias("often"))
    pairs = found.filter("kind = 0").groupBy("a", "b").agg(F.first("size_a").cast("long").alias("size_a"), F.first("size_b").cast("long").alias("size_b"), F.sum("times").alias("times"))
    pairs = pairs.join(often.select(F.col("node").alias("a"), F.col("often").alias("often_a")), "a", "left") \
        .join(often.select(F.col("node").alias("b"), F.col("often").alias("often_b")), "b", "left")
    need = whole((percent * (F.col("size_a") + F.col("size_b")) + 99 + percent) / (100 + percent)) - F.greatest(beyond(F.col("size_a")), beyond(F.col("size_b")))
    pairs = pairs.filter(F.col("times") + F.least(F.coalesce("often_a", F.lit(0)), F.coalesce("often_b", F.lit(0))) >= need).select("a", "b", "size_a", "size_b")
    able = often.filter(F.col("often") >= F.greatest(F.lit(1), whole(F.col("size") / MORE))).select("node", "often")
    return pairs, entries.join(able, "node")


def fragments(rows: DataFrame, n: int = N) -> DataFrame:
    """(node, fragment, part): each node's set cut by the top bits of the hashes; empty parts are left out."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("fragment", T.IntegerType()), T.StructField("part", T.BinaryType())])
    cuts = np.array([k * ((1 << 64) // FRAGMENTS) for k in range(1, FRAGMENTS)], np.uint64)

    def run(batches):
        for b in slices(batches):
            out = []
            for node, own in zip(b["node"].to_pylist(), shingle_sets(b["text"].cast(pa.binary()).to_pylist(), n)):
                for f, part in enumerate(np.split(own, np.searchsorted(own, cuts))):
                    if len(part):
                        out.append((node, f, part.tobytes()))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary()))], names=schema.names)

    return rows.select("node", "text").mapInArrow(run, schema)


def count_links(pairs: DataFrame, parts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b, ...) that link: overlaps are counted per fragment and summed per pair."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "size_a", "size_b", "common")])

    def run(batches):
        for b in slices(batches, 2048):
            common = []
            for x, y in zip(b["part_a"], b["part_b"]):
                u, v = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(u) > len(v):
                    u, v = v, u
                common.append(int((v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u).sum()))
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], b["size_a"], b["size_b"], pa.array(common, pa.int64())], names=schema.names)

    own = pairs.select("a", "b", F.col("size_a").cast("long").alias("size_a"), F.col("size_b").cast("long").alias("size_b"))
    left = parts.select(F.col("node").alias("a"), "fragment", F.col("part").alias("part_a"))
    right = parts.select(F.col("node").alias("b"), "fragment", F.col("part").alias("part_b"))
    met = own.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "size_a", "size_b", "part_a", "part_b")
    summed = met.mapInArrow(run, schema).groupBy("a", "b", "size_a", "size_b").agg(F.sum("common").alias("common"))
    return summed.filter(100 * F.col("common") >= percent * (F.col("size_a") + F.col("size_b") - F.col("common"))).select("a", "b")


def _rest(entries: DataFrame, comp: DataFrame, links: DataFrame) -> DataFrame:
    """Entries of groups with more than one component, with their component and number of links."""
    degree = links.select("a").union(links.select("b")).toDF("node").groupBy("node").agg(F.least(F.count("*"), F.lit(PIVOTS[0])).alias("links"))
    now = entries.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = now.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("key")
    return now.join(mixed, "key", "left_semi").join(degree, "node", "left").withColumn("links", F.coalesce("links", F.lit(0)))


def _rest_pairs(rest: DataFrame, seed: int, pivots: int, percent: int) -> DataFrame:
    """Pairs of different components in one group: with its pivot, or (no pivots) all that may link."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "size_a", "size_b")])
    fields = ("node", "size", "often", "comp", "links")
    kind = np.dtype([("key", "<u8"), *[(c, "<i8") for c in fields]])

    def batch(pairs):
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in range(4)], names=schema.names)

    def find(own):
        if pivots:
            p = pivot_of(own, seed, pivots)
            i = np.flatnonzero(own["comp"] != own["comp"][p])
            yield _pairs(own, i, np.full(len(i), p), percent)
            return
        own = own[np.argsort(own["comp"], kind="stable")]
        after = np.searchsorted(own["comp"], own["comp"], "right")  # each entry with those of later components, some entries at a time
        ends = np.cumsum(len(own) - after)
        at = 0
        while at < len(own):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 19), "right")))
            count = len(own) - after[at:stop]
            i = np.repeat(np.arange(at, stop), count)
            yield _pairs(own, i, np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(after[at:stop], count), percent)
            at = stop

    def run(batches):
        held, key = [], None
        for b in slices(batches, 1 << 16):
            own = np.empty(b.num_rows, kind)
            own["key"] = b["key"].to_numpy().view(np.uint64)
            for c in fields:
                own[c] = b[c].to_numpy()
            for part in np.split(own, np.flatnonzero(own["key"][1:] != own["key"][:-1]) + 1):
                if key is not None and part["key"][0] != key:
                    yield from (batch(p) for p in find(np.concatenate(held)) if len(p))
                    held = []
                key = part["key"][0]
                held.append(part)
        if held:
            yield from (batch(p) for p in find(np.concatenate(held)) if len(p))

    return rest.select("key", *[F.col(c).cast("long").alias(c) for c in fields]).repartition("key").sortWithinPartitions("key").mapInArrow(run, schema).dropDuplicates(["a", "b"])


def linked_components(docs: DataFrame, rows: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """(node, comp) of every node that has a link; ``rows`` are the written ``members``."""
    spark = docs.sparkSession
    own = rows.filter("n_shingles > 0")
    n_nodes = own.agg(F.approx_count_distinct("node")).first()[0]
    often, level = frequent_shingles(rows, n_nodes)
    buckets = max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = materialize(candidates(prefix_entries(docs, often, level, buckets, n, percent), percent), "candidates")
    pairs, entries = (materialize(x, name) for x, name in zip(_to_count(found, percent), ("pairs", "entries")))
    wanted = pairs.select("a").union(pairs.select("b")).union(entries.select("node")).toDF("node").distinct()
    first = own.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")) \
        .select("node", F.col("first.doc_id").alias("d"), F.col("first.text_hash").alias("h"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    met = texts.join(first, texts["doc_id"].eqNullSafe(first["d"]) & (F.xxhash64(texts["text"]) == first["h"]))
    held = materialize(met.select("node", "text"), "candidate-texts")
    if not held.groupBy("node").count().filter("count > 1").isEmpty():  # the same row stands more than once
        held = materialize(held.dropDuplicates(["node"]), "candidate-texts")
    parts = fragments(held, n)
    links = materialize(count_links(pairs, parts, percent), "links")
    comp = materialize(components(links), "components")
    for k, pivots in enumerate((*PIVOTS, 0)):
        rest = materialize(_rest(entries, comp, links), "rest")
        if rest.isEmpty():
            break
        more = materialize(count_links(_rest_pairs(rest, k, pivots, percent), parts, percent), "links")
        links = links.union(more)
        comp = materialize(components(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(more)), "components")
    return comp


def join_documents(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and the component's number per document."""
    rows = materialize(members(docs, n), "members")
    comp = linked_components(docs, rows, n, percent)
    own = rows.filter("n_shingles is not null").drop("often", "counts")
    classes = own.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least")).join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = classes.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = classes.select("node", "comp").join(least, "comp")
    return own.join(ids, "node", "left").select(
        "doc_id", "text_hash", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "comp")


def keep_first(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row of each component (smallest doc_id, then text hash), and all rows without words; the columns of ``docs``."""
    found = join_documents(docs, n, percent)
    first = found.filter("n_shingles > 0").groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("w")).select("w.doc_id", "w.text_hash")
    held = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    names = [c.lower() for c in docs.columns]
    doc, text = F.col(f"_{names.index('doc_id')}").cast("long"), F.col(f"_{names.index('text')}").cast("string")
    words = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    held = held.withColumn("_d", doc).withColumn("_h", F.xxhash64(text))
    won = held.filter(words).join(first, held["_d"].eqNullSafe(first["doc_id"]) & (held["_h"] == first["text_hash"]), "left_semi").dropDuplicates(["_d", "_h"])
    return won.unionByName(held.filter(~words)).drop("_d", "_h").toDF(*docs.columns)
