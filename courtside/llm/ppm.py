"""LM scoring by prediction by partial matching (PPM) over bytes, beside a word model.

A text is lower-cased (A-Z); its words, each with a space after it, and an end
mark are the bytes to predict.  A trie of byte contexts of up to ``ORDER``
bytes is counted over all training documents.  A byte's probability comes
from its longest known context: with ``T`` occurrences and ``d`` distinct
successors of the context, a seen byte has n / (T + d) and the escape to the
next shorter context d / (T + d) (method C).  Successors of the longer
context are excluded from the shorter one; beyond order 0 all bytes not yet
excluded are alike.  A document's score is the sum of log10 probabilities.

The trie is one table of (ORDER + 1)-byte strings with counts; shorter
contexts are sums of it.  Two ways give the same scores:

* a table of at most ``MODEL_GRAMS`` strings is broadcast, the size having
  been counted before;
* of a larger one the most frequent strings, at most so many, are broadcast
  with their scores.  What is left of the documents is packed: a chunk of
  documents asks once for each of its other strings, in blobs by bucket, and a
  bucket's strings and scores meet in one task, whose answers go back to the
  chunk.  Strings that no training document has are scored by joins with each
  order's table.

Words: counts of all training words are summed up; those of at least
``COMMON_SHARE`` of all tokens (so at most 1 / COMMON_SHARE words) are
broadcast, occurrences of the others are joined.  Words are told apart by
63-bit hashes.

Defined results: null and empty texts have only the end token; without
training documents every byte has probability 1/256; repeated rows are
scored, and learned from, one by one; a null doc_id counts as the empty text.
A very long text is one document of its task; an empty table gives no rows;
equal counts need no order; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import materialize, ship_code, slices

ORDER = 5
MODEL_GRAMS = 1 << 22
COMMON_SHARE = 1e-6
CACHE_WORDS = 400_000
SEGMENT = 1 << 20  # bytes scored at once
CHUNK = 1 << 20  # strings outside the broadcast table that are asked for together
BUCKET = 1 << 20  # strings outside it, or occurrences of them, in a bucket
END_WORD = -1  # hash of the end token; words have hashes from 0 on

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PRIME = (1 << 31) - 1
_PLACES, _HELD = -1, -2  # buckets of a chunk's own records


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_LOWER).split() if text else []


def canonical(words: list[bytes]) -> bytes:
    """What the byte model predicts: each word and a space, then the end mark."""
    return b" ".join(words) + b" \n" if words else b"\n"


def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> 1


def segments(text: bytes, order: int = ORDER, size: int = SEGMENT):
    """Stretches of a canonical text, each after the ``order`` bytes before it."""
    padded = b"\n" * order + text
    for k in range(0, len(text), size):
        yield padded[k:k + size + order]


def grams(parts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """All (order + 1)-byte strings of the segments as numbers, and where each segment's begin."""
    s = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    code = np.zeros(max(0, len(s) - order), np.uint64)
    for k in range(order + 1):
        code = (code << np.uint64(8)) | s[k:len(s) - order + k]
    sizes = np.array([len(p) - order for p in parts])
    start = np.cumsum(sizes + order) - sizes - order
    keep = np.ones(len(code), bool)
    for k in range(1, order + 1):  # strings that reach into the next segment's context
        at = start[1:] - k
        keep[at] = False
    return code[keep], np.cumsum(sizes) - sizes


def _in_groups(items, size):
    """Lists of consecutive items of about SEGMENT bytes."""
    held, total = [], 0
    for x in items:
        held.append(x)
        total += size(x)
        if total >= SEGMENT:
            yield held
            held, total = [], 0
    if held:
        yield held


def _sum_by(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    return key[edge], np.add.reduceat(n, edge) if len(edge) else n


def count_corpus(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(kind, key, n): counts of byte strings (kind 0) and of words (kind 1) in the training documents."""
    ship_code(docs.sparkSession)
    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches):
        words: Counter = Counter()
        held, total, ends = [], 0, 0

        def rows():
            nonlocal words, held, total, ends
            key, n = _sum_by(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            own = np.array([word_hash(w) for w in words] + [END_WORD], np.int64)
            for kind, keys, ns in ((0, key.view(np.int64), n), (1, own, np.array([*words.values(), ends], np.int64))):
                for k in range(0, len(keys), 1 << 16):
                    part = keys[k:k + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int32)), pa.array(part), pa.array(ns[k:k + (1 << 16)])], names=schema.names)
            words, held, total, ends = Counter(), [], 0, 0

        for b in slices(batches):
            own = [words_of(t) for d, t in zip(b["doc_id"].to_pylist(), b["text"].cast(pa.binary()).to_pylist()) if not is_held_out(d)]
            ends += len(own)
            for w in own:
                words.update(w)
            for group in _in_groups((p for w in own for p in segments(canonical(w), order)), len):
                code = np.sort(grams(group, order)[0])
                edge = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1], [True]]))
                held.append((code[edge[:-1]], np.diff(edge)))
                total += len(edge) - 1
            if total > 1 << 22 or len(words) > 1 << 20:
                yield from rows()
            elif len(held) > 24:
                held = [_sum_by(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))]
                total = len(held[0][0])
        if ends:
            yield from rows()

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, schema).groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Known:
    """Hash table of byte strings and their scores."""

    def __init__(self, key: np.ndarray, score: np.ndarray):
        self.bits = max(4, int(2 * len(key)).bit_length())
        slot = (key * _MIX) >> np.uint64(64 - self.bits)
        rank = np.argsort(slot, kind="stable")  # linear probing: each at its slot or the first free one after it
        place = np.maximum.accumulate(slot[rank].astype(np.int64) - np.arange(len(key))) + np.arange(len(key)) if len(key) else np.zeros(0, np.int64)
        self.keys = np.full(max(1 << self.bits, int(place[-1]) + 1 if len(place) else 0) + 1, np.iinfo(np.uint64).max, np.uint64)
        self.scores = np.zeros(len(self.keys))
        self.keys[place], self.scores[place] = key[rank], score[rank]

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the strings, 0 for those not in the table, and where these are."""
        at = ((code * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.zeros(len(code))
        live = np.arange(len(code))
        missing = []
        free = np.iinfo(np.uint64).max
        while len(live):
            key, own = self.keys[at], code[live]
            hit = key == own
            out[live[hit]] = self.scores[at[hit]]
            none = key == free
            missing.append(live[none])
            more = ~(hit | none)
            live, at = live[more], at[more] + 1
        return out, np.concatenate(missing) if missing else np.zeros(0, int)


class Trie:
    """Contexts of all orders of a table of byte strings: sorted arrays, and a hash table for known strings."""

    def __init__(self, key: np.ndarray, n: np.ndarray, order: int = ORDER):
        self.order = order
        self.levels = []  # per order: strings, counts, contexts, occurrences, successors, count of these successors one order below
        rank = np.argsort(key)
        tables = [(key[rank], n[rank].astype(np.int64))]
        for k in range(order, 0, -1):
            tables.append(_sum_by(tables[-1][0] & np.uint64((1 << (8 * k)) - 1), tables[-1][1]))
        for k, (u, c) in enumerate(reversed(tables)):
            ctx = u >> np.uint64(8)
            edge = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(u) else np.zeros(0, int)
            size = np.diff(np.concatenate([edge, [len(u)]]))
            below = np.zeros(len(edge), np.int64)
            if k and len(u):
                low, low_n = self.levels[-1][:2]
                below = np.add.reduceat(low_n[np.searchsorted(low, u & np.uint64((1 << (8 * k)) - 1))], edge)
            self.levels.append((u, c, ctx[edge], np.add.reduceat(c, edge) if len(edge) else c, size, below))
        u, c, ctx, occ, succ, _ = self.levels[-1]
        at = np.searchsorted(ctx, u >> np.uint64(8))
        known = np.log10(c / (occ[at] + succ[at])) if len(u) else np.zeros(0)
        self.known = Known(u, known)

    def log10(self, code: np.ndarray) -> np.ndarray:
        """log10 probabilities of the last byte of each string after the others."""
        out, lost = self.known.find(code)
        if len(lost):
            u, back = np.unique(code[lost], return_inverse=True)
            out[lost] = self.escaped(u)[back]
        return out

    def escaped(self, code: np.ndarray) -> np.ndarray:
        """The same by walking down the orders, for any strings."""
        out, live = np.zeros(len(code)), np.ones(len(code), bool)
        gone_n, gone = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        for k in range(self.order, -1, -1):
            u, c, ctx, occ, succ, below = self.levels[k]
            if not len(u):
                continue
            own = code & np.uint64((1 << (8 * (k + 1))) - 1)
            p = np.minimum(np.searchsorted(ctx, own >> np.uint64(8)), len(ctx) - 1)
            has = live & (ctx[p] == own >> np.uint64(8))
            e = np.minimum(np.searchsorted(u, own), len(u) - 1)
            seen = has & (u[e] == own)
            left, kinds = occ[p] - gone_n, succ[p] - gone
            out[seen] += np.log10(c[e[seen]] / (left + kinds)[seen])
            live &= ~seen
            esc = has & ~seen
            some = esc & (kinds > 0)
            out[some] += np.log10(kinds[some] / (left + kinds)[some])
            gone_n, gone = np.where(esc, below[p], gone_n), np.where(esc, succ[p], gone)
        out[live] -= np.log10(256 - gone[live])
        return out


class _Words(dict):
    """Count of a common word, or -1 - hash of another; the end token's count apart."""

    def __init__(self, counts: dict[int, int]):
        super().__init__()
        self.counts = counts

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        h = word_hash(word)
        out = self[word] = self.counts.get(h) or -1 - h
        return out


# bucket: null in a document's row; otherwise a chunk's record, with the chunk's number in row
ROWS = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
                     T.StructField("known", T.LongType()), T.StructField("logs", T.DoubleType()), T.StructField("score", T.DoubleType()),
                     T.StructField("rare", T.ArrayType(T.LongType())), T.StructField("bucket", T.IntegerType()), T.StructField("strings", T.ArrayType(T.LongType())),
                     T.StructField("packed", T.BinaryType())])
_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64()),
                    ("rare", pa.list_(pa.int64())), ("bucket", pa.int32()), ("strings", pa.list_(pa.int64())), ("packed", pa.binary())])


def _chunk(number: int, parts: list[tuple[int, bool, np.ndarray]], n_buckets: int) -> pa.RecordBatch:
    """A chunk's records, of (row, held out, strings): the places of its strings, those of held-out documents, and the distinct ones by bucket."""
    code = np.concatenate([x for _, _, x in parts])
    key, back = np.unique(code, return_inverse=True)
    bucket = (key % np.uint64(_PRIME) % np.uint64(n_buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")  # by bucket, in it by string
    place = np.empty(len(key), np.int32)
    place[order] = np.arange(len(key), dtype=np.int32)
    key, bucket = key[order].view(np.int64), bucket[order]
    rows = np.array([r for r, _, _ in parts], np.int64)
    sizes = np.array([len(x) for _, _, x in parts], np.int64)
    held = [x for _, h, x in parts if h]
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    blobs = [zlib.compress(np.diff(key[i:j], prepend=0).tobytes(), 1) for i, j in zip(edge[:-1], edge[1:])]
    places = zlib.compress(np.int64(len(parts)).tobytes() + rows.tobytes() + sizes.tobytes() + place[back].tobytes(), 1)
    n = len(blobs) + 2
    own = {"row": [number] * n, "bucket": [_PLACES, _HELD, *bucket[edge[:-1]].tolist()], "packed": [places, None, *blobs],
           "strings": [None, np.unique(np.concatenate(held)).view(np.int64) if held else None] + [None] * len(blobs)}
    return pa.RecordBatch.from_arrays([pa.array(own[f.name], f.type) if f.name in own else pa.nulls(n, f.type) for f in _ARROW], names=ROWS.names)


def _document_rows(docs: DataFrame, common: dict[int, int], n_end: int, model: Trie | Known, n_buckets: int, order: int) -> DataFrame:
    """Per document: sums over common words, hashes of the others, and its score, with ``Known`` of the strings in it; the others are in chunks."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((common, model))
    chunk_size = CHUNK

    def run(batches):
        counts, own_model = shared.value
        words = _Words(counts)
        log_end = np.log10(n_end + 1)
        row = chunk = TaskContext.get().partitionId() << 40
        rest: list[tuple[int, bool, np.ndarray]] = []
        waiting = 0
        for b in slices(batches):
            held = zip(b["doc_id"].to_pylist(), b["text"].cast(pa.binary()).to_pylist())
            for group in _in_groups(held, lambda x: len(x[1] or b"")):
                cols: list[list] = [[] for _ in _ARROW]
                parts, owner = [], []
                first = row
                for k, (d, t) in enumerate(group):
                    w = words_of(t)
                    c = np.fromiter(map(words.__getitem__, w), np.int64, len(w))
                    own = c[c > 0]
                    text = canonical(w)
                    for p in segments(text, order):
                        parts.append(p)
                        owner.append(k)
                    for col, v in zip(cols, (row, d, is_held_out(d), len(w) + 1, len(own) + (n_end > 0), float(np.log10(own + 1.0).sum() + log_end), 0.0, -1 - c[c < 0], None, None, None)):
                        col.append(v)
                    row += 1
                score = np.zeros(len(group))
                for one in _in_groups(zip(parts, owner), lambda x: len(x[0])):
                    code, start = grams([p for p, _ in one], order)
                    if isinstance(own_model, Trie):
                        value = own_model.log10(code)
                    else:
                        value, lost = own_model.find(code)
                        lost.sort()
                        ends = np.searchsorted(lost, start[1:])
                        new = [(first + k, cols[2][k], x) for (_, k), x in zip(one, np.split(code[lost], ends)) if len(x)]
                        rest += new
                        waiting += len(lost)
                    np.add.at(score, [k for _, k in one], np.add.reduceat(value, start))
                    if waiting >= chunk_size:
                        yield _chunk(chunk, rest, n_buckets)
                        rest, waiting, chunk = [], 0, chunk + 1
                cols[6] = score
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], names=ROWS.names)
        if rest:
            yield _chunk(chunk, rest, n_buckets)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, ROWS)


def known_log10(table: DataFrame) -> DataFrame:
    """(key, n, lp) of the strings of the training documents: the distributed form of what ``Trie`` has in its hash table."""
    of_context = Window.partitionBy("ctx")  # 256 strings at most
    return table.withColumn("ctx", F.shiftright("key", 8)).select("key", "n", F.log10(F.col("n") / (F.sum("n").over(of_context) + F.count("*").over(of_context))).alias("lp"))


def frequent(table: DataFrame, most: int) -> tuple[Column, int, int]:
    """Whether a string is one of the most frequent, ``most`` at most; how many others there are, and their occurrences."""
    step = F.floor(8 * F.log2("n"))
    found = sorted(table.groupBy(step.alias("step")).agg(F.count("*").alias("strings"), F.sum("n").alias("n")).collect(), key=lambda r: -r["step"])
    held = 0
    for k, r in enumerate(found):
        held += r["strings"]
        if held > most:
            return step > r["step"], sum(x["strings"] for x in found[k:]), sum(x["n"] for x in found[k:])
    return F.lit(True), 0, 0


def _answers(rows: DataFrame, scores: DataFrame, n_buckets: int) -> DataFrame:
    """(row, score) of the chunks' strings: each bucket's blobs meet its scores, their answers the chunk's places."""

    def look_up(asked: pa.Table, known: pa.Table) -> pa.Table:
        key, lp = known["key"].to_numpy(), known["lp"].to_numpy()
        rank = np.argsort(key)
        key, lp = key[rank], lp[rank]
        out = []
        for blob in asked["packed"].to_pylist():
            own = np.cumsum(np.frombuffer(zlib.decompress(blob), np.int64))
            at = np.searchsorted(key, own)
            if len(own) and (at[-1] >= len(key) or (key[at] != own).any()):
                raise ValueError("a string has no score")
            out.append(zlib.compress(lp[at].tobytes(), 1))
        return pa.table({"chunk": asked["chunk"], "bucket": asked["bucket"], "packed": pa.array(out, pa.binary())})

    def add_up(places: pa.Table, answers: pa.Table) -> pa.Table:
        rank = np.argsort(answers["bucket"].to_numpy())
        blobs = answers["packed"].to_pylist()
        lp = np.concatenate([np.frombuffer(zlib.decompress(blobs[k])) for k in rank])
        rows, sums = [], []
        for blob in places["packed"].to_pylist():  # one
            held = zlib.decompress(blob)
            n = int(np.frombuffer(held, np.int64, 1)[0])
            sizes = np.frombuffer(held, np.int64, n, 8 + 8 * n)
            rows.append(np.frombuffer(held, np.int64, n, 8))
            sums.append(np.add.reduceat(lp[np.frombuffer(held, np.int32, -1, 8 + 16 * n)], np.cumsum(sizes) - sizes))
        return pa.table({"row": np.concatenate(rows), "score": np.concatenate(sums)})

    asked = rows.filter("bucket >= 0").select(F.col("row").alias("chunk"), "bucket", "packed")
    known = scores.select("key", "lp", F.expr(f"cast(key % {_PRIME} % {n_buckets} as int)").alias("bucket"))
    answers = asked.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(look_up, "chunk long, bucket int, packed binary")
    places = rows.filter(F.col("bucket") == _PLACES).select(F.col("row").alias("chunk"), "packed")
    return places.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(add_up, "row long, score double")


def joined_log10(strings: DataFrame, table: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, lp) of distinct strings, by joins with each order's table; the distributed form of ``Trie.escaped``."""
    zero = F.lit(0).cast("long")
    now = materialize(strings.select("key", F.lit(0.0).alias("lp"), F.lit(True).alias("live"), zero.alias("gone_n"), zero.alias("gone")), "scored")
    scored = []
    for k in range(order, -1, -1):
        now = now.withColumn("own", F.col("key").bitwiseAND((1 << (8 * (k + 1))) - 1)).withColumn("ctx", F.shiftright("own", 8))
        met = materialize(table.withColumn("ctx", F.shiftright("key", 8)).join(now.select("ctx").distinct(), "ctx", "left_semi"), f"order-{k}-met")
        own, low = met, zero
        if k:
            table = materialize(table.groupBy(F.col("key").bitwiseAND((1 << (8 * k)) - 1).alias("key")).agg(F.sum("n").alias("n")), f"order-{k - 1}")
            shorter = table.select(F.col("key").alias("s_key"), F.col("n").alias("s_n"))
            own = own.withColumn("s_key", F.col("key").bitwiseAND((1 << (8 * k)) - 1)).join(shorter, "s_key")
            low = F.sum("s_n")
        contexts = own.groupBy("ctx").agg(F.sum("n").alias("occ"), F.count("*").alias("succ"), low.alias("below"))
        entries = met.select(F.col("key").alias("own"), F.col("n").alias("c"))
        now = now.join(contexts, "ctx", "left").join(entries, "own", "left")
        has = F.col("occ").isNotNull()
        seen, esc = has & F.col("c").isNotNull(), has & F.col("c").isNull()
        left, kinds = F.col("occ") - F.col("gone_n"), F.col("succ") - F.col("gone")
        step = F.when(seen, F.log10(F.col("c") / (left + kinds))).when(esc & (kinds > 0), F.log10(kinds / (left + kinds))).otherwise(0.0)
        now = now.select("key", (F.col("lp") + step).alias("lp"), (~seen).alias("live"),
                         F.when(esc, F.col("below")).otherwise(F.col("gone_n")).alias("gone_n"), F.when(esc, F.col("succ")).otherwise(F.col("gone")).alias("gone"))
        now = materialize(now, f"scored-{k}")
        scored.append(now.filter("not live").select("key", "lp"))
        now = now.filter("live")
    out = now.select("key", (F.col("lp") - F.log10(256 - F.col("gone"))).alias("lp"))
    for x in scored:
        out = out.union(x)
    return out


def score_documents(docs: DataFrame, order: int = ORDER, model_grams: int = MODEL_GRAMS, common_share: float = COMMON_SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per document."""
    counts = materialize(count_corpus(docs, order), "corpus-counts")
    words = counts.filter("kind = 1 and n > 0")
    n_train, n_words = (x or 0 for x in words.agg(F.sum("n"), F.count("*")).first())
    least = max(2, int(common_share * n_train))
    t = words.filter(F.col("n") >= least).select("key", "n").toArrow()  # at most 1 / common_share rows
    common = dict(zip(t["key"].to_pylist(), t["n"].to_pylist()))
    n_end = common.pop(END_WORD, None) or next((r["n"] for r in words.filter(F.col("key") == END_WORD).collect()), 0)
    table = counts.filter("kind = 0").select("key", "n")
    known, n_buckets = None, 1
    if table.count() <= model_grams:
        t = table.toArrow()
        model = Trie(t["key"].to_numpy().view(np.uint64), t["n"].to_numpy(), order)
    else:
        often, others, occurrences = frequent(table, model_grams)
        n_buckets += max(others, occurrences) // BUCKET
        known = materialize(known_log10(table).withColumn("often", often), "string-scores")
        t = known.filter("often").select("key", "lp").toArrow()  # at most model_grams rows
        model = Known(t["key"].to_numpy().view(np.uint64), t["lp"].to_numpy())
    held = materialize(_document_rows(docs, common, n_end, model, n_buckets, order), "document-rows")
    del t, common, model  # the driver needs them no more
    rows = held.filter("bucket is null")
    rare = rows.select("row", F.explode("rare").alias("key"))
    met = rare.join(words.filter(F.col("n") < least).select("key", "n"), "key")
    zero = F.lit(0).cast("long")
    parts = [rows.select("row", "doc_id", "held_out", "n_tokens", "known", "logs", "score"),
             met.select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"), zero.alias("n_tokens"),
                        F.lit(1).cast("long").alias("known"), F.log10(F.col("n") + 1).alias("logs"), F.lit(0.0).alias("score"))]
    if known is not None:
        asked = held.filter(F.col("bucket") == _HELD).select(F.explode("strings").alias("key")).distinct()
        new = joined_log10(asked.join(known, "key", "left_anti"), table, order)
        scores = known.filter("not often").select("key", "lp").union(new)
        parts.append(_answers(held, scores, n_buckets).select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"), zero.alias("n_tokens"),
                                                              zero.alias("known"), F.lit(0.0).alias("logs"), "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    out = out.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
                                 F.sum("known").alias("n_known"), F.sum("logs").alias("logs"), F.sum("score").alias("score"))
    z = float(np.log10(n_train + n_words + 1))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
                      (F.col("logs") - F.col("n_tokens") * F.lit(z)).alias("base_score"), "score")
