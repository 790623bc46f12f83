"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A text is a sequence of words (lower-cased A-Z; runs of ASCII letters, digits
and any non-ASCII character).  The patterns are all windows of ``window``
consecutive words of the benchmark items; an item with fewer words, but not
none, is one shorter window.  The search is the Wu-Manber scheme with words
as its alphabet:

* windows are kept per length ``m``, so that one short item does not shrink
  the shifts of the others;
* a *shift table* maps each block of ``B = min(3, m)`` words to how far the
  scan can move without passing the end of a window; unknown blocks move it
  by ``m - B + 1`` words;
* where the shift is 0, the block's bucket (the block is the suffix of the
  window) lists the windows to try; a differing first word rules one out and
  a direct comparison of all words confirms it.

The pattern tables are broadcast in blocks of at most ``block_bytes`` of
benchmark text each.  With more text than that, the documents pass one block
after the other and carry their hits along; a scratch table is written after
every ``blocks_per_pass`` blocks.  No shuffle is needed.

Defined results: null or empty text has no words, no hits and is not
contaminated; null benchmark text has no windows; a null ``item_id`` counts
as the empty string, and rows with one ``item_id`` count as one item;
repeated document rows are judged one by one; an empty benchmark hits
nothing, and an empty table of documents gives no rows.  Whole texts of any
length are searched.  Extra columns are kept, those named as a result column
give way to it.  No order enters the result: windows that tie count alike.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import as_bytes, hold, materialize, ship_code, slices

WINDOW = 13
BLOCK_WORDS = 3
#: Benchmark bytes per broadcast block (the tables take some 50 times as much).
BLOCK_BYTES = 1 << 21
BLOCKS_PER_PASS = 4

_KEEP = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
              for c in range(256))


def lowered(text: bytes) -> bytes:
    """``text`` with lower-cased A-Z and a space for every byte that belongs to no word."""
    return text.translate(_KEEP)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: lower-cased A-Z, runs of letters, digits and non-ASCII characters."""
    return lowered(text).split() if text else []


class WuManber:
    """Search tables for the windows of some items; ``items`` is a list of (id, words)."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        self.classes: list[tuple[int, int, dict, dict]] = []
        by_length: dict[int, list[tuple[int, int]]] = {}
        for k, words in enumerate(self.words):
            m = min(window, len(words))
            if m:
                by_length.setdefault(m, []).extend((k, at) for at in range(len(words) - m + 1))
        for m, windows in sorted(by_length.items()):
            b = min(BLOCK_WORDS, m)
            shift: dict[tuple, int] = {}
            bucket: dict[tuple, list[tuple[int, int]]] = {}
            for k, at in windows:
                words = self.words[k]
                for end in range(b, m + 1):
                    block = tuple(words[at + end - b:at + end])
                    if m - end < shift.get(block, m):
                        shift[block] = m - end
                bucket.setdefault(tuple(words[at + m - b:at + m]), []).append((k, at))
            self.classes.append((m, b, shift, bucket))

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """(start, end) of every occurrence of a window, and the items that have one."""
        spans: list[tuple[int, int]] = []
        found: set[int] = set()
        n = len(words)
        for m, b, shift, bucket in self.classes:
            far = m - b + 1
            end = m
            while end <= n:
                block = tuple(words[end - b:end])
                step = shift.get(block, far)
                if step:
                    end += step
                    continue
                start, first, hit = end - m, words[end - m], False
                for k, at in bucket[block]:
                    own = self.words[k]
                    if own[at] == first and own[at:at + m] == words[start:end]:
                        hit = True
                        found.add(k)
                if hit:
                    spans.append((start, end))
                end += 1
        return spans, found


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _blocks(benchmark: DataFrame, block_bytes: int) -> list:
    """One loader for each block of bounded size; a loader collects that block's item words."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), as_bytes(benchmark).alias("t"))
    total = items.agg(F.sum(F.length("t") + F.length("i"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("t"), F.lit(n))

    def load(k: int):
        rows = (items if n == 1 else items.filter(part == k)).collect()
        return [(r["i"], words_of(bytes(r["t"]) if r["t"] is not None else None)) for r in rows]

    return [lambda k=k: load(k) for k in range(n)]


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
NEW = ("n_words", "n_hit", "hit_spans", "item_ids", "contaminated")


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
              blocks_per_pass: int = BLOCKS_PER_PASS, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the columns n_words, n_hit, hit_spans (word ranges), item_ids and contaminated.

    Columns of ``docs`` that have one of those names give way to the new ones.
    """
    ship_code(docs.sparkSession)
    out = docs.drop(*[c for c in docs.columns if c.lower() in NEW])
    out = out.withColumn(text, F.col(text).cast("string"))
    carried = [f for f in out.schema.fields if keep_text or f.name != text]
    added = [T.StructField("n_words", T.LongType()), T.StructField("hit_spans", T.ArrayType(SPAN)),
             T.StructField("item_ids", T.ArrayType(T.StringType()))]
    loaders = _blocks(benchmark, block_bytes)
    sc = docs.sparkSession.sparkContext
    for k, load in enumerate(loaders):
        if k and k % blocks_per_pass == 0:
            out = materialize(out, "decontaminate")
        tables = sc.broadcast(WuManber(load(), window))
        last = k == len(loaders) - 1
        schema = T.StructType((carried if last else out.schema.fields[:len(docs.columns)]) + added) if k == 0 or last else out.schema
        names = schema.names

        def scan(batches, tables=tables, first=k == 0, names=names):
            t = tables.value
            for b in slices(batches):
                n_words, spans, ids = [], [], []
                empty = [[]] * b.num_rows
                for raw, s0, i0 in zip(b[text].cast(pa.binary()).to_pylist(),
                                       empty if first else b["hit_spans"].to_pylist(), empty if first else b["item_ids"].to_pylist()):
                    words = words_of(raw)
                    s, found = t.search(words)
                    n_words.append(len(words))
                    spans.append([{"start": x, "end": y} for x, y in _merge(s + [(x["start"], x["end"]) for x in s0])] if s else s0)
                    ids.append(sorted({t.ids[f] for f in found} | set(i0)) if found else i0)
                cols = {"n_words": pa.array(n_words, pa.int64()), "hit_spans": pa.array(spans, _SPANS), "item_ids": pa.array(ids, pa.list_(pa.string()))}
                yield pa.RecordBatch.from_arrays([cols[n] if n in cols else b[n] for n in names], names=names)

        out = out.mapInArrow(scan, schema)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + (s["end"] - s["start"]))
    return out.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the columns of ``docs``."""
    held, text = hold(docs)
    found = find_hits(held, benchmark, text=text, **options)
    return found.filter(~F.col("contaminated")).select(*held.columns).toDF(*docs.columns)


def digest(ids: list[str]) -> str:
    """Lowercase hex SHA-256 of the sorted ids, comma-joined."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
