"""Source divergence audit over a vocabulary held in minimal acyclic transducers.

1. *Vocabulary.*  Tasks count in how many documents each term of a language
   occurs; terms in at least ``KEEP_DOCS`` documents are kept, sorted by
   (language, bytes) over range partitions and numbered from partition sizes,
   so a language's ordinals are lexicographic without one task sorting it.
2. *Transducers.*  Each run of about ``SHARD_BYTES`` of a language's sorted
   terms becomes one minimal acyclic transducer (``llm.transducer``).  Shards
   of at most ``PASS_BYTES`` together are sent to all tasks at a time; a larger
   vocabulary takes more passes over the text, not more memory.
3. *Recount.*  All text streams through the transducers, a batch of tokens in
   step: the token's first eight bytes say which shard can hold it, the
   outputs on its path add up to its ordinal.  Tasks add up counts by (source,
   ordinal) before they are shuffled in blocks of ``BLOCK`` ordinals.
4. *Divergence.*  With a count ``c`` of a term, ``N`` the sum over its group's
   kept terms and ``V`` of them, ``p = 1 + floor(10^9 (c + 2) / (N + 2 V))``,
   and ``f(p, q) = floor((p - q)^2 / (p + q))``.  Part ``term`` ranks the terms
   that a source has more often than its language by ``f``, equal ones by
   ordinal; part ``pair`` ranks the other sources of the language by the sum
   of ``f`` over all kept terms.  Sources meet in tiles of about ``TILE`` by
   block, so no task holds more than two tiles of one block.

All arithmetic is in whole numbers.

Defined results: null text, lang and source count as ''; a group whose
documents have no terms still has its rows; a language without kept terms has
pairs of value 0 and no terms; a language with one source has no pairs.  Equal
values rank by ordinal (terms) or UTF-8 bytes (sources).  Repeated rows count
each time, as documents of their own.  An empty table gives no rows.  Long
texts are worked on in pieces that end between terms; a term takes about 300
bytes of memory per byte not shared with others while its shard is built.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtside.llm.common import as_bytes, materialize, ship_code, slices
from courtside.llm.transducer import Transducer, build, join

KEEP_DOCS, TOP = 10, 10
SHARD_BYTES, PASS_BYTES = 1 << 16, 1 << 26
BLOCK, TILE = 512, 256
#: Terms, or sums by term and source, that a task holds before it passes them on.
HELD = 1 << 19
#: Bytes of text worked on at once.
PIECE = 1 << 20

_TERM, _BETWEEN = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^A-Za-z\x80-\xff]")
_IN_TERM = np.array([bool(_TERM.fullmatch(bytes([c]))) for c in range(256)])
_UNIT = 1_000_000_000


def _rows(docs: DataFrame) -> DataFrame:
    ship_code(docs.sparkSession)
    named = {n: F.coalesce(F.col(n).cast("string"), F.lit("")) for n in ("lang", "source")}
    return docs.select(*[c.alias(n) for n, c in named.items()], as_bytes(docs).alias("text"))


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in lower case, in pieces of at least ``size`` bytes (but the last) that end between terms."""
    at = 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end].lower()
        at = end


def _batch(schema: pa.Schema, columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_DOCS = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("docs", pa.int64())])


def kept_terms(docs: DataFrame, keep_docs: int = KEEP_DOCS) -> DataFrame:
    """(lang, term) of the terms in at least ``keep_docs`` documents of the language; terms as UTF-8 bytes."""
    def run(batches):
        held: dict[str, Counter] = {}
        many = 0

        def flush():
            for lang, found in held.items():
                yield _batch(_DOCS, ([lang] * len(found), list(found), list(found.values())))
            held.clear()

        for b in slices(batches):
            for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist()):
                if text:
                    own = held.setdefault(lang, Counter())
                    many -= len(own)
                    terms: set[bytes] = set()
                    for p in pieces(text):
                        terms.update(_TERM.findall(p))
                    own.update(terms)
                    many += len(own)
            if many > HELD:
                yield from flush()
                many = 0
        yield from flush()

    found = _rows(docs).select("lang", "text").mapInArrow(run, "lang string, term binary, docs long")
    return found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= keep_docs).select("lang", "term")


_NUMBERED = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("part", pa.int32()), ("local", pa.int64()), ("size", pa.int64())])


def vocabulary(kept: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, term, ordinal, shard): ordinals of each language from 0 in byte order, shards of consecutive ones."""
    def run(batches):
        part, lang, local, size = TaskContext.get().partitionId(), None, 0, 0
        for b in slices(batches, 1 << 14):
            locals_, sizes = [], []
            langs, terms = b["lang"].to_pylist(), b["term"].to_pylist()
            for own, term in zip(langs, terms):
                if own != lang:
                    lang, local, size = own, 0, 0
                locals_.append(local)
                sizes.append(size)
                local, size = local + 1, size + len(term)
            yield _batch(_NUMBERED, (langs, terms, [part] * len(langs), locals_, sizes))

    ordered = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    numbered = materialize(ordered.mapInArrow(run, "lang string, term binary, part int, local long, size long"), "terms")
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = numbered.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("term")).alias("bytes"))
    parts = parts.select("lang", "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).cast("long").alias(f"{c}_before") for c in ("n", "bytes")])
    return numbered.join(parts, ["lang", "part"]).select(
        "lang", "term", (F.col("n_before") + F.col("local")).alias("ordinal"), F.floor((F.col("bytes_before") + F.col("size")) / shard_bytes).alias("shard"))


_SHARD = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("ordinal", pa.int64()), ("first", pa.binary()), ("transducer", pa.binary())])


def transducers(words: DataFrame) -> DataFrame:
    """(lang, shard, ordinal and bytes of its first term, transducer) of a ``vocabulary``."""
    def run(batches):
        def rows():
            for b in slices(batches, 1 << 14):
                yield from zip(*(b[n].to_pylist() for n in ("lang", "shard", "ordinal", "term")))

        for (lang, shard), own in groupby(rows(), key=lambda r: r[:2]):
            _, _, ordinal, first = next(own)

            def terms():
                yield first
                yield from (r[3] for r in own)

            yield _batch(_SHARD, ([lang], [shard], [ordinal], [first], [build(terms()).to_bytes()]))

    dealt = words.select("lang", "shard", "ordinal", "term").repartition("lang", "shard").sortWithinPartitions("lang", "shard", "ordinal")
    return dealt.mapInArrow(run, "lang string, shard long, ordinal long, first binary, transducer binary")


class Lookup:
    """Finds ordinals of tokens in the shards of one pass."""

    def __init__(self, shards: list[tuple[str, int, bytes, bytes]]):
        shards = sorted(shards, key=lambda s: (s[0], s[1]))  # language, first ordinal
        self.whole, self.start = join([Transducer.from_bytes(s[3]) for s in shards])
        self.base = np.array([s[1] for s in shards], np.int64)
        prefix = np.array([int.from_bytes(s[2][:8].ljust(8, b"\0"), "big") for s in shards], np.uint64)
        self.of = {lang: (k[0], prefix[k[0]:k[-1] + 1]) for lang, g in groupby(range(len(shards)), key=lambda i: shards[i][0]) for k in [list(g)]}

    def ordinals(self, data: np.ndarray, first: np.ndarray, last: np.ndarray, lang: list[str], which: np.ndarray) -> np.ndarray:
        """Ordinals of tokens of the languages ``lang[which]``, -1 for those not in these shards; eight bytes follow the last token."""
        words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)[first]).view(">u8").ravel().astype(np.uint64)
        beyond = (8 * np.maximum(0, 8 - (last - first))).astype(np.uint64)
        words = words >> beyond << beyond
        low, high = np.zeros(len(first), np.int64), np.full(len(first), -1, np.int64)
        for k, name in enumerate(lang):
            if name in self.of and (own := np.nonzero(which == k)[0]).size:
                base, prefix = self.of[name]
                # a shard whose first term has the same eight bytes may hold the token, and so may the one before
                low[own] = np.maximum(np.searchsorted(prefix, words[own], "left") - 1, 0) + base
                high[own] = np.searchsorted(prefix, words[own], "right") - 1 + base
        found = np.full(len(first), -1, np.int64)
        todo = np.nonzero(low <= high)[0]
        while len(todo):
            at = low[todo]
            got = self.whole.ordinals(data, first[todo], last[todo], self.start[at])
            hit = got >= 0
            found[todo[hit]] = got[hit] + self.base[at[hit]]
            todo = todo[~hit]
            low[todo] += 1
            todo = todo[low[todo] <= high[todo]]
        return found


_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("block", pa.int64()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])
_COUNTS_SQL = "lang string, source string, block long, at array<int>, n array<long>"


def _merge(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, with their counts added up."""
    code, back = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(code), np.int64)
    np.add.at(total, back, np.concatenate(counts))
    return code, total


def _recount(rows: DataFrame, shards: list, block: int) -> DataFrame:
    """Counts by (lang, source, block of ordinals) as each task found them; block -1 says that the group occurs."""
    sent = rows.sparkSession.sparkContext.broadcast(shards)
    bits = 40  # of an ordinal

    def run(batches):
        lookup = Lookup(sent.value) if sent.value else None
        number: dict[tuple[str, str], int] = {}
        names: list[tuple[str, str]] = []
        codes, counts, many = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

        def flush():
            code, total = _merge(codes, counts)
            key = (code >> bits) << bits | (code & ((1 << bits) - 1)) // block
            cut = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]) if len(key) else np.zeros(1, np.int64)
            at = ((code & ((1 << bits) - 1)) % block).astype(np.int32)
            for k in range(0, len(cut) - 1, 4096):
                edge = cut[k:k + 4097]
                own = [names[g] for g in (key[edge[:-1]] >> bits).tolist()]
                offset = pa.array(edge - edge[0], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in own], pa.string()), pa.array([x[1] for x in own], pa.string()), pa.array(key[edge[:-1]] & ((1 << bits) - 1), pa.int64()),
                    pa.ListArray.from_arrays(offset, pa.array(at[edge[0]:edge[-1]])), pa.ListArray.from_arrays(offset, pa.array(total[edge[0]:edge[-1]]))], schema=_COUNTS)

        def seen():
            yield _batch(_COUNTS, ([x[0] for x in names], [x[1] for x in names], [-1] * len(names), [[]] * len(names), [[]] * len(names)))

        def count(parts: list[bytes], owners: list[int]):
            """Adds the ordinals of some pieces of text, each of a group."""
            data = np.frombuffer(b" " + b" ".join(parts) + b" " * 9, np.uint8)
            edge = np.flatnonzero(np.diff(_IN_TERM[data].view(np.int8))) + 1
            first, last = edge[::2], edge[1::2]
            starts = np.cumsum([1] + [len(p) + 1 for p in parts[:-1]])
            owner = np.array(owners)[np.searchsorted(starts, first, "right") - 1]
            langs = sorted({names[o][0] for o in set(owners)})
            lang_of = np.zeros(len(names), np.int64)
            for o in set(owners):
                lang_of[o] = langs.index(names[o][0])
            ordinal = lookup.ordinals(data, first, last, langs, lang_of[owner])
            known = ordinal >= 0
            code, n = np.unique(owner[known] << bits | ordinal[known], return_counts=True)
            codes.append(code)
            counts.append(n)
            return len(code)

        for b in slices(batches):
            parts, owners, size = [], [], 0
            for lang, source, text in zip(b["lang"].to_pylist(), b["source"].to_pylist(), b["text"].to_pylist()):
                if (own := number.get((lang, source))) is None:
                    own = number[lang, source] = len(names)
                    names.append((lang, source))
                for p in pieces(text or b"") if lookup else ():
                    parts.append(p)
                    owners.append(own)
                    size += len(p)
                    if size >= PIECE:
                        many += count(parts, owners)
                        parts, owners, size = [], [], 0
            if parts:
                many += count(parts, owners)
            if many > 4 * HELD or len(names) > HELD:
                code, total = _merge(codes, counts)
                codes[:], counts[:], many = [code], [total], len(code)
                if many > HELD or len(names) > HELD:
                    yield from flush()
                    yield from seen()
                    codes[:], counts[:], many = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
                    number.clear()
                    names.clear()
        yield from flush()
        yield from seen()

    return rows.mapInArrow(run, _COUNTS_SQL)


_MERGED = pa.schema([*_COUNTS, pa.field("whole", pa.bool_())])
_MERGED_SQL = _COUNTS_SQL + ", whole boolean"


def _merged(counts: DataFrame, block: int) -> DataFrame:
    """Counts added up by (lang, block, source), with a further row (``whole``) for the language itself."""
    def run(batches):
        def rows():
            for b in slices(batches, 1 << 12):
                at, n = b["at"], b["n"]
                for k, key in enumerate(zip(b["lang"].to_pylist(), b["block"].to_pylist(), b["source"].to_pylist())):
                    yield *key, at[k].values.to_numpy(), n[k].values.to_numpy()

        held: list[tuple] = []

        def add(lang, number, source, total, whole):
            at = np.flatnonzero(total)
            held.append((lang, source, number, at, total[at], whole))

        def out():
            found = _batch(_MERGED, zip(*held))
            held.clear()
            return found

        for (lang, number), own in groupby(rows(), key=lambda r: r[:2]):
            every = np.zeros(block, np.int64)
            for source, parts in groupby(own, key=lambda r: r[2]):
                total = np.zeros(block, np.int64)
                for p in parts:
                    total[p[3]] += p[4]
                every += total
                add(lang, number, source, total, False)
                if len(held) >= 1024:
                    yield out()
            add(lang, number, "", every, True)
        if held:
            yield out()

    return counts.repartition("lang", "block").sortWithinPartitions("lang", "block", "source").mapInArrow(run, _MERGED_SQL)


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), exact, three decimal digits at a time."""
    whole = total + 2 * terms
    out, rest = np.zeros(counts.shape, np.int64), counts + 2
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest %= whole
    return out + 1


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _dense(at, n, total: int, terms: int, number: int, block: int) -> np.ndarray:
    """Shares of all terms of a block, most of which have no counts."""
    found = np.zeros(max(0, min(block, terms - number * block)), np.int64)
    if at is not None:
        found[at] = n
    return shares(found, total, terms) if len(found) else found


def _stream(batches, names, rows: int = 1 << 10):
    for b in slices(batches, rows):
        at, n = b["at"], b["n"]
        for k, key in enumerate(zip(*(b[c].to_pylist() for c in names))):
            yield *key, at[k].values, n[k].values


def _top_terms(blocks: DataFrame, block: int, top: int) -> DataFrame:
    """(lang, source, ordinal, value): the ``top`` terms of each group in each block."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("ordinal", pa.int64()), ("value", pa.int64())])

    def run(batches):
        for (lang, number), own in groupby(_stream(batches, ("lang", "block", "source", "total", "terms")), key=lambda r: r[:2]):
            q = None
            for _, _, source, total, terms, at, n in own:  # the language's own row comes first
                here = at.to_numpy() if at is not None else np.zeros(0, np.int32)
                p = _dense(here, n.to_numpy() if n is not None else here, total, terms, number, block)
                if q is None:
                    q = p
                    continue
                here = here[p[here] > q[here]]
                value = differences(p[here], q[here])
                best = np.lexsort((here, -value))[:top]
                yield _batch(schema, ([lang] * len(best), [source] * len(best), here[best].astype(np.int64) + number * block, value[best]))

    own = blocks.filter("whole OR size(at) > 0").repartition("lang", "block").sortWithinPartitions("lang", "block", F.desc("whole"), "source")
    return own.mapInArrow(run, "lang string, source string, ordinal long, value long")


def _pair_sums(blocks: DataFrame, groups: DataFrame, block: int, tile: int) -> DataFrame:
    """(lang, a, b, value) for the sources a < b of a language."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])

    def run(batches):
        names = ("lang", "block", "low", "high", "tile", "source", "total", "terms")
        for (lang, number, low, high), own in groupby(_stream(batches, names), key=lambda r: r[:4]):
            held = {low: ([], []), high: ([], [])}
            for _, _, _, _, t, source, total, terms, at, n in own:
                held[t][0].append(source)
                held[t][1].append(_dense(None if at is None else at.to_numpy(), None if n is None else n.to_numpy(), total, terms, number, block))
            (left, p), (right, q) = held[low], held[high]
            q = np.array(q)
            for k, source in enumerate(left):
                others, against = (right, q) if low != high else (right[k + 1:], q[k + 1:])
                if others:
                    value = differences(p[k], against).sum(axis=1)
                    swap = [o < source for o in others]
                    yield _batch(schema, ([lang] * len(others), [o if s else source for o, s in zip(others, swap)], [source if s else o for o, s in zip(others, swap)], value))

    many = groups.filter("NOT whole").groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    own = blocks.filter("NOT whole").join(many, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), "tiles"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    own = own.select("lang", "block", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "tile", "source", "total", "terms", "at", "n")
    met = own.repartition("lang", "block", "low", "high").sortWithinPartitions("lang", "block", "low", "high", "tile", "source")
    sums = met.mapInArrow(run, "lang string, a string, b string, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, keep_docs: int = KEEP_DOCS, top: int = TOP, shard_bytes: int = SHARD_BYTES, pass_bytes: int = PASS_BYTES, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` (all ranks) and ``term`` (ranks to ``top``)."""
    rows = _rows(docs)
    words = vocabulary(kept_terms(docs, keep_docs), shard_bytes)
    shards = materialize(transducers(words), "shards")
    # passes over the text: shards in order, each pass below pass_bytes or one shard
    sizes = shards.select("lang", "shard", F.length("transducer").alias("size")).orderBy("lang", "shard").collect()
    passes: list[list] = [[]]
    room = pass_bytes
    for lang, shard, size in sizes:
        if size > room and passes[-1]:
            passes.append([])
            room = pass_bytes
        passes[-1].append((lang, shard))
        room -= size
    counts = None
    for own in passes:
        (low, high) = (own[0], own[-1]) if own else (("", 0), ("", -1))
        key = F.struct("lang", "shard")
        lit = [F.struct(F.lit(x[0]).alias("lang"), F.lit(x[1]).cast("long").alias("shard")) for x in (low, high)]
        sent = [(r.lang, r.ordinal, bytes(r.first), bytes(r.transducer)) for r in shards.filter(key.between(*lit)).collect()]
        found = _recount(rows, sent, block)
        found = materialize(found, "recount") if len(passes) > 1 else found  # one pass's shards are sent at a time
        counts = found if counts is None else counts.unionByName(found)
    merged = materialize(_merged(counts, block), "counts")

    terms = words.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    added = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
    groups = merged.groupBy("lang", "source", "whole").agg(F.sum(added).alias("total")).join(terms, "lang", "left").na.fill(0, ["terms"])
    groups = materialize(groups, "groups")
    every = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("terms") / block) - 1, F.lit(0)).cast("long"))))
    blocks = every.join(merged.filter("block >= 0"), ["lang", "source", "whole", "block"], "left")
    blocks = materialize(blocks.select("lang", "source", "whole", "block", "total", "terms", "at", "n"), "blocks")

    def ranked(found: DataFrame, *ties):
        own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), *ties)
        return found.withColumn("rank", F.row_number().over(own))

    best = ranked(_top_terms(blocks, block, top), "ordinal").filter(F.col("rank") <= top)
    best = best.join(words.select("lang", "ordinal", "term"), ["lang", "ordinal"])
    sums = _pair_sums(blocks, groups, block, tile)
    both = sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    pairs = ranked(both.select("lang", "x.source", "x.item", "value"), "item")
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(
        best.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank"))
