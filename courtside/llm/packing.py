"""Packing into windows by Karmarkar-Karp multiway differencing.

A document is its token ids and an end id.  It is cut into pieces: every full
``capacity`` ids are a window of their own, and the remainder is halved until
no piece is longer than ``piece`` ids.  The pieces are dealt by hash into
groups of about ``group_windows`` windows, whatever partition they came from,
and each group is packed alone:

* every piece starts as a partition into ``k`` windows of which one is used;
* the two partial partitions with the largest difference between their
  fullest and emptiest window are merged, the fullest windows of one with the
  emptiest of the other, until one is left: near-equal windows;
* ``k`` begins at the fewest windows that could hold the group and rises
  whenever a window exceeds the capacity.

Only piece lengths and checksums pass the shuffle unless ``with_ids`` asks
for the ids themselves.

Defined results: null and empty texts are one piece with the end id; repeated
rows are packed separately; an empty table has no pieces; ``sequence_id`` is
unique, not gapless.  A very long text is encoded whole by one task and cut
into many pieces; pieces of equal length go by their place in the group; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import materialize, ship_code, slices
from courtside.llm.tokens import encoder

CAPACITY = 4096
PIECE = 1024
GROUP_WINDOWS = 128


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Item numbers of at most ``k`` windows with near-equal sums, the fullest first.

    A partial partition is the list of its used windows as (sum, members),
    fullest first; members are an item or a pair of members.
    """
    heap = [(-s, n, [(s, n)]) for n, s in enumerate(sizes)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        alone, most = k - len(b), len(a)  # windows of a that meet an unused window of b
        if most <= alone:
            merged = a + b
        else:
            merged = a[:alone] + [(a[i][0] + b[k - 1 - i][0], (a[i][1], b[k - 1 - i][1])) for i in range(alone, most)] + b[:k - most]
        merged.sort(key=lambda w: -w[0])
        low = merged[-1][0] if len(merged) == k else 0
        heapq.heappush(heap, (low - merged[0][0], number, merged))
        number += 1
    out = []
    for _, members in heap[0][2] if heap else []:
        own, stack = [], [members]
        while stack:
            m = stack.pop()
            if isinstance(m, tuple):
                stack += m
            else:
                own.append(m)
        out.append(own)
    return out


def pack(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Windows (item numbers) of at most ``capacity`` each; no size may exceed it."""
    full = [[n] for n, s in enumerate(sizes) if s == capacity]
    rest = [n for n, s in enumerate(sizes) if s != capacity]
    if not rest:
        return full
    own = [sizes[n] for n in rest]
    k = -(-sum(own) // capacity)
    while True:
        windows = differencing(own, k)
        if max(sum(own[i] for i in w) for w in windows) <= capacity:
            return full + [[rest[i] for i in w] for w in windows]
        k += 1


def cuts(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    out = [(s, capacity) for s in range(0, n - n % capacity, capacity)]
    rest, at = n % capacity, n - n % capacity
    parts = 1
    while -(-rest // parts) > piece:
        parts *= 2
    edges = [at + rest * k // parts for k in range(parts + 1)]
    return out + [(s, e - s) for s, e in zip(edges, edges[1:]) if e > s]


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, piece: int = PIECE, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids, little-endian unsigned 32-bit) of every piece."""
    ship_code(docs.sparkSession)
    held = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    end = np.array([end_id], "<u4").tobytes()
    fields = [held.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")]]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids
    names = [f.name for f in fields]

    def run(batches):
        for b in slices(batches):
            rows, which = [], []
            for n, ids in enumerate(encoder(tokenizer).encode(b["text"].cast(pa.binary()).to_pylist())):
                ids += end
                for s, size in cuts(len(ids) // 4, capacity, piece):
                    own = ids[4 * s:4 * (s + size)]
                    which.append(n)
                    rows.append((s, size, zlib.crc32(own), len(ids) // 4, own))
            cols = list(zip(*rows))
            arrays = [b["doc_id"].take(pa.array(which, pa.int32())), *[pa.array(c, pa.int64()) for c in cols[:4]]]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(cols[4], pa.binary())] * with_ids, names=names)

    return held.mapInArrow(run, T.StructType(fields))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = CAPACITY, piece: int = PIECE,
                   group_windows: int = GROUP_WINDOWS, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their ``sequence_id`` and ``offset`` there."""
    cut = materialize(pieces(docs, tokenizer, end_id, capacity, piece, with_ids), "pieces")
    total = cut.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / (group_windows * capacity)))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        sizes = group["length"].to_pylist()
        first = group["group"][0].as_py() << 24
        order, sequence, offset = [], [], []
        for k, window in enumerate(pack(sizes, capacity)):
            at = 0
            for n in window:
                order.append(n)
                sequence.append(first + k)
                offset.append(at)
                at += sizes[n]
        out = group.drop_columns(["group"]).take(pa.array(order, pa.int64()))
        return out.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return dealt.groupBy("group").applyInArrow(run, schema)
