"""Token ids in binary shards with Re-Pair grammar compression.

Documents are dealt by ranges of ``doc_id`` and sorted, so shards in order of
(part, shard) hold all documents in ascending ``doc_id``.  A shard has about
``shard_ids`` ids.  In it the frequent pairs of neighbouring symbols are
replaced by new symbols, round after round: each round counts all pairs,
takes the most frequent ones (at least ``min_count`` times) and replaces
their occurrences from the left without overlap.  A pair never spans two
documents.  Rounds end when no pair is frequent enough.  Symbols have 16 bits,
or 32 once those are used up.

A shard's payload (all numbers little-endian):

    4 bytes "RPG1", u32 symbol bytes (2 or 4), u32 base (first rule symbol),
    u32 documents, u32 rules, u32 symbols,
    rules x (u32 left, u32 right), rules x u32 expansion length,
    (documents + 1) x u32 first symbol of each document,
    documents x u32 ids of each document, symbols

Rule k is symbol base + k; its parts are ids or earlier rules.  Any document
is decoded from its own symbols (``Shard.document``), and any range of its
ids by skipping symbols by their expansion lengths (``Shard.ids``).

The files are Parquet tables of (part, shard, n_docs, n_ids, doc_ids,
payload) in the shared scratch folder, committed by Spark's writer.

Defined results: null and empty texts are the end id alone; rows with equal
doc_id are ordered by text, null first; a null doc_id comes first; an empty
table gives no shards.  A very long text makes its shard as long as it is;
other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import scratch_path, ship_code, slices
from courtside.llm.tokens import encoder

SHARD_IDS = 1 << 20
ROUND_PAIRS = 8192
MIN_COUNT = 8
_HASH_BITS = 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slots(codes: np.ndarray) -> np.ndarray:
    """A slot below 2^20 for each code, by multiplication in the codes' own width."""
    bits = 8 * codes.dtype.itemsize
    return (codes * codes.dtype.type(int(_MIX) >> (64 - bits) | 1)) >> codes.dtype.type(bits - _HASH_BITS)


def compress(ids: np.ndarray, ends: np.ndarray, rounds: int | None = None, round_pairs: int = ROUND_PAIRS, min_count: int = MIN_COUNT):
    """(base, rules, symbols, symbol ends) of the ids of documents that end before ``ends``.

    Goes on until no pair is found ``min_count`` times (``rounds`` stops
    earlier, for tests).  Symbols have 16 bits until those are used up.
    """
    base = int(ids.max()) + 1 if len(ids) else 0
    shift = 16 if base <= 0xF000 else 32
    seq = ids.astype(np.uint32 if shift == 16 else np.uint64)
    last = np.zeros(len(seq), bool)
    last[ends[ends > 0] - 1] = True
    rules: list[np.ndarray] = []
    made = 0
    while len(seq) > 1 and (rounds is None or len(rules) < rounds):
        if shift == 16 and base + made + round_pairs > 1 << 16:
            seq, shift = seq.astype(np.uint64), 32
        code = (seq[:-1] << seq.dtype.type(shift)) | seq[1:]
        slot = _slots(code)
        # a pair is found no more often than its slot: only pairs of full slots are counted one by one
        within = ~last[:-1]
        full = np.bincount(slot, minlength=1 << _HASH_BITS) >= min_count
        ranked = np.sort(code[full[slot] & within])
        edge = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]])) if len(ranked) else np.zeros(1, int)
        count = np.diff(edge)
        often = np.flatnonzero(count >= min_count)
        if not len(often):
            break
        often = often[np.lexsort((ranked[edge[often]], -count[often]))][:round_pairs]
        chosen = ranked[edge[often]]
        keep = np.unique(_slots(chosen), return_index=True)[1]  # pairs that share a slot wait for a later round
        chosen = chosen[np.sort(keep)]
        held = np.full(1 << _HASH_BITS, -1, np.int32)
        held[_slots(chosen)] = np.arange(len(chosen), dtype=np.int32)
        rule = held[slot]
        # runs of neighbouring hits: every second one, from the left
        at = np.flatnonzero((rule >= 0) & within)
        at = at[chosen[rule[at]] == code[at]]
        start = np.concatenate([[True], np.diff(at) > 1])
        if not start.all():
            since = np.arange(len(at)) - np.flatnonzero(start)[np.cumsum(start) - 1]
            at = at[since % 2 == 0]
        hit = rule[at]
        used = np.flatnonzero(np.bincount(hit, minlength=len(chosen)))
        number = np.zeros(len(chosen), seq.dtype)
        number[used] = np.arange(base + made, base + made + len(used))
        pairs = chosen[used].astype(np.uint64)
        rules.append(np.stack([pairs >> np.uint64(shift), pairs & np.uint64((1 << shift) - 1)], axis=1).astype(np.uint32))
        seq[at] = number[hit]
        last[at] |= last[at + 1]
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq, last = seq[stay], last[stay]
        made += len(used)
    return base, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), seq, np.flatnonzero(last) + 1


def write_payload(docs: list[bytes], **options) -> bytes:
    """The payload of one shard; each document is its id bytes, not empty."""
    sizes = np.array([len(d) // 4 for d in docs], np.int64)
    ids = np.frombuffer(b"".join(docs), "<u4")
    base, rules, seq, ends = compress(ids, np.cumsum(sizes), **options)
    wide = base + len(rules) > 1 << 16
    lengths = np.ones(len(rules), np.int64)
    for k, (a, b) in enumerate(rules.tolist()):
        lengths[k] = (lengths[a - base] if a >= base else 1) + (lengths[b - base] if b >= base else 1)
    return b"".join([
        b"RPG1", struct.pack("<5I", 4 if wide else 2, base, len(docs), len(rules), len(seq)), rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(),
        np.concatenate([[0], ends]).astype("<u4").tobytes(), sizes.astype("<u4").tobytes(), seq.astype("<u4" if wide else "<u2").tobytes()])


class Shard:
    """Reader of one payload."""

    def __init__(self, payload: bytes):
        if payload[:4] != b"RPG1":
            raise ValueError("not a shard payload")
        width, self.base, docs, rules, symbols = struct.unpack_from("<5I", payload, 4)
        at = 24

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.rules = take(2 * rules, "<u4").reshape(-1, 2)
        self.lengths = take(rules, "<u4")
        self.first = take(docs + 1, "<u4").astype(np.int64)
        self.sizes = take(docs, "<u4").astype(np.int64)
        self.symbols = take(symbols, "<u2" if width == 2 else "<u4")
        # expansions of all rules in one array
        self._at = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        self._flat = np.zeros(int(self._at[-1]), np.uint32)
        flat, where, base = self._flat, self._at.tolist(), self.base
        for k, (a, b) in enumerate(self.rules.tolist()):
            s, e = where[k], where[k + 1]
            if a < base:
                flat[s] = a
                m = s + 1
            else:
                m = s + where[a - base + 1] - where[a - base]
                flat[s:m] = flat[where[a - base]:where[a - base + 1]]
            if b < base:
                flat[m] = b
            else:
                flat[m:e] = flat[where[b - base]:where[b - base + 1]]

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        s = symbols.astype(np.int64)
        rule = s >= self.base
        size = np.ones(len(s), np.int64)
        size[rule] = self.lengths[s[rule] - self.base]
        table = np.concatenate([self._flat, np.zeros(1, np.uint32)])
        start = np.full(len(s), len(table) - 1, np.int64)
        start[rule] = self._at[s[rule] - self.base]
        begin = np.cumsum(size) - size
        out = table[np.repeat(start - begin, size) + np.arange(int(size.sum()))] if rule.any() else np.zeros(len(s), np.uint32)
        out[begin[~rule]] = s[~rule]
        return out

    def document(self, k: int) -> np.ndarray:
        return self._expand(self.symbols[self.first[k]:self.first[k + 1]])

    def ids(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of document ``k``; symbols outside the range are skipped, not expanded."""
        own = self.symbols[self.first[k]:self.first[k + 1]].astype(np.int64)
        size = np.ones(len(own), np.int64)
        rule = own >= self.base
        size[rule] = self.lengths[own[rule] - self.base]
        end = np.cumsum(size)
        a, b = int(np.searchsorted(end, start, "right")), int(np.searchsorted(end, stop, "left")) + 1
        skipped = int(end[a - 1]) if a else 0
        return self._expand(own[a:b])[start - skipped:stop - skipped]

    def all_ids(self) -> np.ndarray:
        return self._expand(self.symbols)


SHARDS = T.StructType([T.StructField("part", T.LongType()), T.StructField("shard", T.LongType()), T.StructField("n_docs", T.LongType()),
                       T.StructField("n_ids", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType())])


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_ids: int = SHARD_IDS, **options) -> None:
    """Encode all texts and write their shards as the table ``path``."""
    ship_code(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    ranged = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        part, shard = TaskContext.get().partitionId(), 0
        doc_ids, held, n = [], [], 0

        def row():
            cols = [[part], [shard], [len(held)], [n], [doc_ids], [write_payload(held, **options)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(),) * 4 + (pa.list_(pa.int64()), pa.binary()))], names=SHARDS.names)

        for b in slices(batches):
            for d, ids in zip(b["doc_id"].to_pylist(), encoder(tokenizer).encode(b["text"].cast(pa.binary()).to_pylist())):
                doc_ids.append(d)
                held.append(ids + end)
                n += len(ids) // 4 + 1
                if n >= shard_ids:
                    yield row()
                    doc_ids, held, n, shard = [], [], 0, shard + 1
        if held:
            yield row()

    ranged.mapInArrow(run, SHARDS).write.parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, shard, shard_start): ids before each shard.  The window without keys has one row per part."""
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    own = shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("in_part"))
    return own.join(before, "part").select("part", "shard", (F.col("part_start") + F.col("in_part")).alias("shard_start"))


DIGESTS = T.StructType([T.StructField(c, T.LongType()) for c in ("part", "shard", "doc_id", "in_shard", "n_tokens", "ids_crc32")])


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the shards."""
    shards = read_shards(spark, path)

    def run(batches):
        for b in slices(batches, 1):
            reader = Shard(b["payload"][0].as_buffer().to_pybytes())
            raw = reader.all_ids().astype("<u4").tobytes()
            at = np.concatenate([[0], np.cumsum(reader.sizes)])
            crc = [zlib.crc32(raw[4 * s:4 * e]) for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
            n = len(crc)
            cols = [np.full(n, b["part"][0].as_py()), np.full(n, b["shard"][0].as_py()), None, at[:-1], reader.sizes, crc]
            yield pa.RecordBatch.from_arrays([b["doc_ids"].flatten() if c is None else pa.array(c, pa.int64()) for c in cols], names=DIGESTS.names)

    found = shards.select("part", "shard", "doc_ids", "payload").mapInArrow(run, DIGESTS)
    return found.join(shard_starts(shards.drop("payload", "doc_ids")), ["part", "shard"]) \
        .select("doc_id", (F.col("shard_start") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_read_back(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_path(spark, "token-shards")
    write_shards(docs, path, tokenizer, **options)
    return read_documents(spark, path)
