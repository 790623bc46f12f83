"""Document fingerprints of improbable features.

A feature is a window of ``WINDOW`` bytes.  Its score is its bytes' entropy,
0 to 1000; its rank says how common that score is among the windows of *all*
documents (0: the rarest), from one counting pass.  Scores below
``LEAST_SCORE`` (long runs of one byte) rank last: they are rare, yet alike
everywhere.  In every neighbourhood of ``NEIGHBOURS`` windows the first one of
least rank gets a vote; windows with ``VOTES`` votes or more are the features
selected, so a selection depends on nearby bytes only.

Distinct selected features enter Bloom filters of 2,048 bits with five bits
each, in text order; after ``CAPACITY`` features the next filter of the chain
begins.  Two chains are compared filter by filter: of the chain with fewer
features, each filter takes its best normalised overlap (common bits beyond
those expected by chance, over the most there could be) with a filter of the
other, and the mean weighs filters by their features.  Overlaps within
``SURE`` standard deviations of chance count as none.

Each task cuts texts to pieces of at most ``PIECE`` windows that overlap by
what a selection depends on, and works on arrays of many pieces at once, so
memory does not grow with a text beyond the text and its fingerprint.

Defined results: null text counts as empty; the empty text has the fingerprint
``0:`` and is like no other text but the empty one; a text shorter than the
window is one feature; equal texts have equal fingerprints whatever their
ids.  Documents in order go by falling ``doc_id``, null last, equal ids by
text.  Repeated rows stay separate.  An empty table gives no rows; one
document is its own next one.  Bytes that are no UTF-8 count as U+FFFD.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from courtside.llm.common import as_bytes, ship_code, slices
from courtside.llm.hashing import mix

WINDOW, NEIGHBOURS, VOTES = 16, 32, 8
LEAST_SCORE, SCORES = 100, 1001
FILTER_BITS, FILTER_HASHES, CAPACITY = 2048, 5, 160
#: Standard deviations by which an overlap must exceed chance.
SURE = 4.0
#: Windows of a piece; bytes after which a group of pieces is worked on (both together stay below 2^20).
PIECE, GROUP_BYTES = 1 << 17, 1 << 17

_PAD = WINDOW + NEIGHBOURS
_BITS = FILTER_BITS.bit_length() - 1
#: A key is a window's rank above _AT_BITS bits of its place; _UNRANKED is above all ranks.
_AT_BITS, _UNRANKED = 20, SCORES + 1
_FRACTION = 16
_N = np.arange(WINDOW + 1)
#: c log2 c, as thousandths of what a window of one byte value has, in units of 2^-16, and its steps: scores come from whole numbers only.
_CLOGC = np.round(np.where(_N > 0, _N * np.log2(np.maximum(_N, 1)), 0) / (WINDOW * np.log2(WINDOW)) * (1000 << _FRACTION)).astype(np.int32)
_STEP = np.concatenate([[0], np.diff(_CLOGC)]).astype(np.int32)


def entropy_scores(data: np.ndarray) -> np.ndarray:
    """Scores 0..1000 of all windows of ``data`` (bytes as an array of at least WINDOW).

    When a window moves by one byte only the counts of two byte values
    change, so all entropies follow from, for each byte, how often it occurs
    in the window that it begins and in the one that it ends.
    """
    size = len(data)
    ahead, behind, same = np.ones(size, np.uint8), np.ones(size, np.uint8), np.empty(size, bool)
    for d in range(1, WINDOW):
        found = np.equal(data[:-d], data[d:], out=same[d:]).view(np.uint8)
        ahead[:-d] += found
        behind[d:] += found
    total = np.empty(size - WINDOW + 1, np.int32)
    total[0] = _CLOGC[np.bincount(data[:WINDOW])].sum()
    np.subtract(_STEP[behind[WINDOW:]], _STEP[ahead[:size - WINDOW]], out=total[1:])
    np.cumsum(total, out=total)
    return ((1000 << _FRACTION) - total) >> _FRACTION


class Pieces(NamedTuple):
    """Pieces of texts in one array, with padding between; windows [first, last) of each are its own."""

    data: np.ndarray
    text: np.ndarray   # number of the text
    start: np.ndarray  # first byte of the piece (context included)
    end: np.ndarray    # end of the piece
    first: np.ndarray
    last: np.ndarray


def _cut(texts: list[bytes]) -> Iterator[Pieces]:
    """Groups of pieces of non-empty texts, in order; a text's windows each belong to one piece."""
    parts: list[bytes] = []
    rows: list[tuple[int, int, int, int, int]] = []
    at = _PAD

    def group() -> Pieces:
        gap = bytes(_PAD)
        data = np.frombuffer(gap + gap.join(parts) + gap, np.uint8)
        return Pieces(data, *np.array(rows, np.int64).T)

    for k, text in enumerate(texts):
        windows = max(1, len(text) - WINDOW + 1) if text else 0
        for a in range(0, windows, PIECE):
            b = min(a + PIECE, windows)
            low, high = max(0, a - NEIGHBOURS), min(len(text), b + NEIGHBOURS + WINDOW)
            parts.append(text[low:high])
            rows.append((k, at, at + high - low, at + a - low, at + b - low))
            at += high - low + _PAD
            if at > GROUP_BYTES:
                yield group()
                parts, rows, at = [], [], _PAD
    if parts:
        yield group()


def _scored(p: Pieces) -> np.ndarray:
    """The score of every window of the group; -1 between the pieces."""
    found = np.full(len(p.data), -1, np.int32)
    scores = entropy_scores(p.data)
    for a, b in zip(p.start.tolist(), np.maximum(p.end - WINDOW, p.start).tolist()):
        found[a:b + 1] = scores[a:b + 1]
    return found


def count_scores(texts: list[bytes]) -> np.ndarray:
    """How many windows of the texts have each score (texts shorter than a window have none)."""
    found = np.zeros(SCORES, np.int64)
    for p in _cut([t for t in texts if len(t) >= WINDOW]):
        scores = entropy_scores(p.data)
        for a, b in zip(p.first.tolist(), p.last.tolist()):
            found += np.bincount(scores[a:b], minlength=SCORES)
    return found


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each score: 0 for the rarest; equally rare ones by score; low scores last."""
    order = np.lexsort((np.arange(SCORES), counts, np.arange(SCORES) < LEAST_SCORE))
    rank = np.empty(SCORES, np.int64)
    rank[order] = np.arange(SCORES)
    return rank


def _feature_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of windows; zeros follow a text that is shorter, so its length counts too."""
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, WINDOW)[start]).view(np.uint64)
    h = length.astype(np.uint64)
    for j in range(words.shape[1]):
        h = mix(h * np.array([0x9E3779B97F4A7C15], np.uint64) ^ words[:, j])
    return h


def _selected(p: Pieces, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the selected features, in order.

    The windows that win successive neighbourhoods never go back, so a
    window's votes are the length of a run.
    """
    size = len(p.data)
    key = np.full(size + NEIGHBOURS, _UNRANKED << _AT_BITS, np.int32)
    key[:size] = np.append(rank, _UNRANKED).astype(np.int32)[_scored(p)] << _AT_BITS
    key[:size] |= np.arange(size, dtype=np.int32)
    best = key
    step = 1
    while step < NEIGHBOURS:  # least key of the step windows from each on
        best = np.minimum(best[:-step], best[step:])
        step *= 2
    turn = np.concatenate([[0], np.flatnonzero(best[1:] != best[:-1]) + 1, [len(best)]])
    winner, votes = best[turn[:-1]], np.diff(turn)
    at = (winner[(votes >= VOTES) & (winner < _UNRANKED << _AT_BITS)] & ((1 << _AT_BITS) - 1)).astype(np.int64)
    piece = np.searchsorted(p.start, at, "right") - 1
    own = (at >= p.first[piece]) & (at < p.last[piece])
    at, piece = at[own], piece[own]
    return p.text[piece], _feature_hashes(p.data, at, np.minimum(WINDOW, p.end[piece] - at))


def fingerprints(texts: list[bytes | None], rank: np.ndarray) -> list[str]:
    """The fingerprint of each text: ``features:filters``, the filters' bits in base64."""
    held = [t or b"" for t in texts]
    found = [_selected(p, rank) for p in _cut(held)]
    text = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
    code = np.concatenate([f[1] for f in found] or [np.zeros(0, np.uint64)])
    order = np.lexsort((np.arange(len(code)), code, text))  # first of equal features of a text
    new = np.ones(len(order), bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (code[order][1:] != code[order][:-1])
    keep = np.sort(order[new])
    text, code = text[keep], code[keep]
    features = np.bincount(text, minlength=len(held))
    filters = -(-features // CAPACITY)
    base = np.cumsum(filters) - filters
    filter_no = base[text] + (np.arange(len(text)) - (np.cumsum(features) - features)[text]) // CAPACITY
    bits = np.zeros((int(filters.sum()), FILTER_BITS), np.uint8)
    for h in range(FILTER_HASHES):
        bits[filter_no, (code >> np.uint64(h * _BITS)) & np.uint64(FILTER_BITS - 1)] = 1
    packed = np.packbits(bits, axis=1)
    return [f"{n}:{base64.b64encode(packed[b:b + f].tobytes()).decode()}" for n, b, f in zip(features.tolist(), base.tolist(), filters.tolist())]


def _parse(fingerprint: str) -> tuple[int, np.ndarray]:
    n, _, coded = fingerprint.partition(":")
    return int(n), np.frombuffer(base64.b64decode(coded), np.uint64).reshape(-1, FILTER_BITS // 64)


def _one_way(n: int, a: np.ndarray, b: np.ndarray) -> float:
    """Mean over the filters of ``a`` (of ``n`` features in all) of the best overlap with one of ``b``."""
    ones_a, ones_b = np.bitwise_count(a).sum(axis=1).astype(float), np.bitwise_count(b).sum(axis=1).astype(float)
    weight = np.full(len(a), float(CAPACITY))
    weight[-1] = n - CAPACITY * (len(a) - 1)
    best = np.zeros(len(a))
    for i in range(len(a)):  # one filter against all: memory as of one chain
        common = np.bitwise_count(a[i] & b).sum(axis=1)
        most, chance = np.minimum(ones_a[i], ones_b), ones_a[i] * ones_b / FILTER_BITS
        beyond = chance + SURE * np.sqrt(chance * (1 - np.maximum(ones_a[i], ones_b) / FILTER_BITS))
        best[i] = np.where((common > beyond) & (most > chance), (common - chance) / np.where(most > chance, most - chance, 1), 0).max()
    return float(best @ weight / n)


def likeness(one: str, other: str) -> float:
    """0 (as by chance) to 1 (the smaller one's features all in the other); 1 for equal fingerprints."""
    if one == other:
        return 1.0
    (n, a), (m, b) = _parse(one), _parse(other)
    if not n or not m:
        return 0.0
    if n == m:
        return (_one_way(n, a, b) + _one_way(m, b, a)) / 2
    return _one_way(n, a, b) if n < m else _one_way(m, b, a)


def score_ranks(docs: DataFrame) -> np.ndarray:
    """Ranks of the scores by their counts over all windows of all documents; the driver gets the 1,001 counts."""
    ship_code(docs.sparkSession)

    def run(batches):
        found = np.zeros(SCORES, np.int64)
        for b in slices(batches):
            found += count_scores([t or b"" for t in b["text"].to_pylist()])
        seen = np.nonzero(found)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(found[seen])], names=["score", "n"])

    counts = np.zeros(SCORES, np.int64)
    for score, n in docs.select(as_bytes(docs).alias("text")).mapInArrow(run, "score long, n long").groupBy("score").agg(F.sum("n")).collect():
        counts[score] = n
    return ranks_of(counts)


def fingerprint_documents(docs: DataFrame, rank: np.ndarray | None = None) -> DataFrame:
    """(doc_id, fingerprint) of every document; ``rank`` as of ``score_ranks`` (null: of these documents)."""
    ranks = score_ranks(docs) if rank is None else rank
    ship_code(docs.sparkSession)
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fingerprints(b["text"].to_pylist(), ranks), pa.string())], names=out.names)

    return docs.select("doc_id", as_bytes(docs).alias("text")).mapInArrow(run, out)


def _bounds(ids: DataFrame, parts: int) -> list[int]:
    """Ids that begin a range each (falling), about equally many rows apart, the greatest first.

    All are ids that occur: quantiles cut the ids to ranges, and each range
    gives its greatest id.  At most ``parts`` numbers reach the driver.
    """
    cuts = ids.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)] or [0.5], 10_000)).collect()[0][0] or []
    cuts = sorted(set(cuts))
    found = ids.groupBy(_passed(F.col("k"), cuts, lambda c, k: c < k).alias("r")).agg(F.max("k").alias("m")).collect()
    return sorted((r["m"] for r in found), reverse=True)


def _passed(key, bounds: list[int], holds):
    """How many leading bounds ``holds`` is true of: a binary search as a column (true for a prefix of the bounds)."""
    if not bounds:
        return F.lit(0)
    steps = [1 << s for s in range(len(bounds).bit_length() - 1, -1, -1)]
    array = F.array(*[F.lit(b).cast("long") for b in bounds])

    def step(pos, s):
        to = pos + s
        return F.when((to <= len(bounds)) & holds(F.get(array, to - 1), key), to).otherwise(pos)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def in_order(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(tail, doc_id, text) with partitions that hold consecutive documents by falling doc_id.

    Each text moves once.  The first documents of a partition also stand, as
    ``tail``, at the end of the one before (the very first ones at the end of
    the last), so every document meets its next one.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = -(1 << 63)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("k"), F.col("doc_id").alias("doc_id"), as_bytes(docs).alias("text"))
    bounds = _bounds(rows.select("k"), parts)
    if not bounds:
        return rows.select(F.lit(0).alias("tail"), "doc_id", "text")
    last = len(bounds)
    placed = rows.withColumn("p", _passed(F.col("k"), bounds, lambda b, k: b >= k) - 1)
    starts = F.get(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("p")) == F.col("k")
    before = F.struct(F.pmod(F.col("p") + last - 1, F.lit(last)).alias("p"), F.lit(1).alias("tail"))
    own = F.struct(F.col("p").alias("p"), F.lit(0).alias("tail"))
    dealt = placed.select("k", "doc_id", "text", F.explode(F.when(starts, F.array(own, before)).otherwise(F.array(own))).alias("to"))
    dealt = dealt.select("k", "doc_id", "text", F.col("to.p").alias("p"), F.col("to.tail").alias("tail"))
    return dealt.repartitionById(last, "p").sortWithinPartitions("p", "tail", F.desc("k"), F.desc_nulls_last("doc_id"), "text").select("tail", "doc_id", "text")


def replace_end(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _batches(rows: Iterable, many: int, size: int) -> Iterator[list]:
    """Lists of (doc_id, text) of at most ``many`` rows, ended once their texts have ``size`` characters."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[1])
        if len(held) >= many or n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def compare_with_next(docs: DataFrame, rank: np.ndarray | None = None, parts: int | None = None) -> DataFrame:
    """Every document beside the next one (by falling doc_id; after the last: the first) and beside its own edited text.

    Columns: doc_id, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.
    """
    ranks = score_ranks(docs) if rank is None else rank
    ship_code(docs.sparkSession)
    out = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
                        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
                        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])
    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out])

    def prints(texts):
        return fingerprints([t.encode() for t in texts], ranks)

    def run(batches):
        def rows():
            for b in slices(batches, 64):
                for tail, i, t in zip(b["tail"].to_pylist(), b["doc_id"].to_pylist(), b["text"].to_pylist()):
                    yield i, (t or b"").decode("utf-8", "replace")
                    if tail:  # the first of the next partition: nothing else is needed of it
                        return

        def result(ids, texts, own, following, after):
            edited = [replace_end(t, f) for t, f in zip(texts, following)]
            coded = prints(edited)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((
                ids, [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edited], own, coded,
                [likeness(a, b) for a, b in zip(own, coded)], [likeness(a, b) for a, b in zip(own, after)]), schema)], schema=schema)

        held = None  # the row whose next one is still to come, with its fingerprint
        for group in _batches(rows(), 512, 1 << 20):
            own = prints([t for _, t in group])
            if held:
                group, own = [held[0], *group], [held[1], *own]
            if len(group) > 1:
                texts = [t for _, t in group]
                yield result([i for i, _ in group[:-1]], texts[:-1], own[:-1], texts[1:], own[1:])
            held = group[-1], own[-1]
        for _ in batches:  # read to the end
            pass

    return in_order(docs, parts).mapInArrow(run, out)
