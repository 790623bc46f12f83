"""Quality classifier by co-training of two views.

The *text* view sees which words a document has and its runs of punctuation;
the *metadata* view sees language, source, and the page's profile (length,
lines, shares of symbols, capitals and digits, in steps).  Each view is a
logistic regression over the features whose association with the label is
beyond chance (root of the likelihood ratio at least ``Z_LEAST``, the
``TERMS`` strongest ones).

The first views are fitted to a bounded sample of labelled rows.  In each of
``ROUNDS`` rounds both views score every document outside that sample; where
a view is confident (``CONFIDENT``) the document gets its label for the other
view to learn from, unless the other is more confident of the opposite.
Tasks count the features of all these documents beside their labels, Spark
sums the counts, and the log odds of the sums are the centre towards which
the next fit to the labelled sample is drawn: what the sample cannot tell
comes from the whole corpus.

In the end all documents are scored by both views, and all labelled rows that
no view was fitted to calibrate the views, combine them by a logistic
regression (both on logits in steps of 1/16) and set the thresholds (in steps
of 1/4096).  Two targets are learned alike: quality and toxicity.  A document
is kept if its quality reaches its threshold and its toxicity stays below its
own; thresholds are the best separating ones among those that reject at most
``MAX_GOOD_LOSS`` of the rows that should stay.

Tasks tell the text view's features apart by 64-bit hashes, so that arrays
hold those of many documents; tables and models have their names.

Bounds: ``LABELLED_ROWS`` labelled rows are fitted, by hash order, every
``APART``-th of them kept apart; a model has at most ``TERMS`` weights per view
and target.  Labelled rows beyond the sample are unlabelled ones to the views;
their labels calibrate.  Pseudo-labels, counts, calibration, thresholds and
scores cover all documents.  Texts are never shuffled but those of the sample.

Defined results: null or empty texts and null metadata are features of their
own kind; a very long text is one document like others (its distinct words are
held in one task; one above ``LONG_BYTES`` is parsed by itself); rows of one doc_id share its labels, and the fit takes the
least of them; null labels and labels of null ids do not count; equal scores
share a side of a threshold; a target without both kinds of labels scores its
share everywhere and rejects nothing; an empty table gives no rows; other
columns of ``docs``, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import materialize, ship_code, slices
from courtside.llm.decontaminate import lowered, words_of
from courtside.llm.hashing import mix, stretch_hashes

LABELLED_ROWS = 20_000
#: Weights of one view for one target.
TERMS = 1 << 14
#: Counted features that a task holds before it hands them on.
HELD = 1_000_000
ROUNDS = 3
CONFIDENT = 0.97
Z_LEAST = 5.0
RIDGE = 1.0
MAX_GOOD_LOSS = 0.001
#: Texts of more bytes are parsed one by one: arrays of theirs would be large.
LONG_BYTES = 1 << 23
#: Every so many labelled rows are kept apart to calibrate.
APART = 4
TARGETS = ("quality", "toxic")
VIEWS = ("text", "meta")

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_ONLY_MARKS = bytes(c if c in _PUNCTUATION else 0x20 for c in range(256))
_SINGLE = {bytes([c]) for c in _PUNCTUATION}
_UPPER, _LOWER, _DIGIT = bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789"
_SIGNS = b"#*$%&|<>!~^_=+"


def text_features(text: bytes | None) -> set[bytes]:
    """Distinct words, and runs of punctuation marks or marks that stand alone (each after a zero byte)."""
    if not text:
        return {b"\0empty"}
    found = set(words_of(text))
    found.update([b"\0" + m[:8] for m in set(text.translate(_ONLY_MARKS).split()) if len(m) > 1])
    found.update([b"\0" + m for m in _SINGLE.intersection(text.split())])
    return found


def _share(text: bytes, which: bytes) -> int:
    """Percent of the bytes in ``which``, in steps that double."""
    return int(100 * (len(text) - len(text.translate(None, which))) / max(1, len(text))).bit_length()


def _profile(lang, source, text: bytes, words: int, again: int) -> set[bytes]:
    """Metadata features of a text with ``words`` words, ``again`` of them equal to the one before."""
    lines = text.count(b"\n") + 1
    parts = {"lang": lang, "source": source, "size": len(text).bit_length(), "lines": lines.bit_length(), "line": (len(text) // lines).bit_length(),
             "word": len(text) // max(1, words), "again": int(100 * again / max(1, words)).bit_length(),
             "upper": _share(text, _UPPER), "digit": _share(text, _DIGIT), "signs": _share(text, _SIGNS)}
    return {f"{k}={v}".encode() for k, v in parts.items()}


def meta_features(lang, source, text: bytes | None) -> set[bytes]:
    words = (text or b"").split()
    return _profile(lang, source, text or b"", len(words), sum(map(bytes.__eq__, words, words[1:])))


_IS_MARK = np.array([c in _PUNCTUATION for c in range(256)])
_IS_SPACE = np.array([c in b" \t\n\r\x0b\x0c" for c in range(256)])
_MARK_KEY = np.array([0x9E3779B97F4A7C15], np.uint64)


def _stretches(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true entries; the last entry is false."""
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    return edge[::2], edge[1::2]


def keys_of(names: list[bytes]) -> np.ndarray:
    """64-bit keys of text features by their names."""
    marked = np.array([x[:1] == b"\0" for x in names], bool)
    parts = [x[1:] if m else x for x, m in zip(names, marked)]
    sizes = np.array([len(x) for x in parts], np.int64)
    ends = np.cumsum(sizes)
    h = stretch_hashes(np.frombuffer(b"".join(parts) + b" ", np.uint8), ends - sizes, ends)
    return np.where(marked, mix(h ^ _MARK_KEY), h)


class Parsed:
    """Features of some documents, the text view's by 64-bit keys: distinct ``keys``, ascending, and each
    document's distinct features as pairs of ``owner`` and ``number`` (a place in ``keys``); ``meta`` has sets."""

    def __init__(self, raw: list[bytes | None], lang: list, source: list):
        texts = [x or b"" for x in raw]
        short = [x if len(x) <= LONG_BYTES else b"" for x in texts]
        self.n, self.joined = len(texts), b" ".join(short) + b" "
        t, self.lower = np.frombuffer(self.joined, np.uint8), self.joined.lower()
        first = np.cumsum([0, *[len(x) + 1 for x in short]])[:-1]
        word, mark = _stretches(np.frombuffer(lowered(self.joined), np.uint8) != 0x20), _stretches(_IS_MARK[t])
        runs = (mark[1] - mark[0] > 1) | (_IS_SPACE[t[mark[0] - 1]] & _IS_SPACE[t[mark[1]]])  # before the first byte is the last, a space
        mark = mark[0][runs], np.minimum(mark[1], mark[0] + 8)[runs]
        rest = [(k, f) for k, x in enumerate(texts) if not x or len(x) > LONG_BYTES for f in sorted(text_features(x))]
        self.rest, self.words = [f for _, f in rest], len(word[0])
        self.start, self.end = np.concatenate([word[0], mark[0]]), np.concatenate([word[1], mark[1]])
        key = stretch_hashes(np.frombuffer(self.lower, np.uint8), self.start, self.end)
        key[self.words:] = mix(key[self.words:] ^ _MARK_KEY)
        key = np.concatenate([key, keys_of(self.rest)])
        owner = np.concatenate([np.searchsorted(first, self.start, "right") - 1, np.array([k for k, _ in rest], np.int64)])
        coded = pa.array(key).dictionary_encode()
        met, found = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        order = np.argsort(found)
        self.keys, rank = found[order], np.empty(len(found), np.int64)
        rank[order] = np.arange(len(found))
        self.example = np.empty(len(found), np.int64)  # an occurrence of each key
        self.example[rank[met]] = np.arange(len(met))
        pairs = np.sort(owner * max(1, len(found)) + rank[met])
        self.owner, self.number = np.divmod(pairs[np.diff(pairs, prepend=-1) > 0], max(1, len(found)))
        s, e = _stretches(~_IS_SPACE[t])
        of = np.searchsorted(first, s, "right") - 1
        count = np.bincount(of, minlength=self.n).tolist()
        alike = (np.diff(of) == 0) & (np.diff(e - s) == 0) & (t[s[1:]] == t[s[:-1]]) & (t[e[1:] - 1] == t[e[:-1] - 1])
        same = [k + 1 for k in np.flatnonzero(alike).tolist() if self.joined[s[k]:e[k]] == self.joined[s[k + 1]:e[k + 1]]]
        again = np.bincount(of[np.array(same, np.int64)], minlength=self.n).tolist()
        self.meta = [_profile(*row) if len(row[2]) <= LONG_BYTES else meta_features(*row[:3]) for row in zip(lang, source, texts, count, again)]

    def names(self, which: np.ndarray) -> list[bytes]:
        """Names of the keys at the places ``which``."""
        out, at = [], self.example[which].tolist()
        for k in at:
            if k < len(self.start):
                name = self.lower[self.start[k]:self.end[k]]
                out.append(name if k < self.words else b"\0" + name)
            else:
                out.append(self.rest[k - len(self.start)])
        return out


def parsed(b: pa.RecordBatch) -> Parsed:
    return Parsed(b["text"].cast(pa.binary()).to_pylist(), b["lang"].to_pylist(), b["source"].to_pylist())


@dataclass
class View:
    """Weights of one view for one target, and the line that calibrates its sum."""
    prior: float = 0.0
    weights: dict = field(default_factory=dict)
    slope: float = 1.0
    offset: float = 0.0


class Scorer:
    """All views: the text view's features by ascending keys, the other's numbered, and a row of weights per target."""

    def __init__(self, views: dict):
        self.weights, self.line = {}, {}
        names = {v: sorted({f for t in TARGETS for f in views[t, v].weights}) for v in VIEWS}
        keys = keys_of(names["text"])
        order = np.argsort(keys)
        self.keys, names["text"] = keys[order], [names["text"][k] for k in order]
        self.number = {f: k for k, f in enumerate(names["meta"])}
        for v in VIEWS:
            self.weights[v] = np.array([[*[views[t, v].weights.get(f, 0.0) for f in names[v]], 0.0] for t in TARGETS])  # last: no feature
            self.line[v] = [(views[t, v].prior, views[t, v].slope, views[t, v].offset) for t in TARGETS]

    def logits(self, docs: Parsed) -> dict[str, np.ndarray]:
        """Per view the calibrated logits of the documents, a column per target."""
        place = np.searchsorted(self.keys, docs.keys)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == docs.keys[known]
        place[~known] = len(self.keys)
        meta = [sorted([self.number[f] for f in x if f in self.number]) for x in docs.meta]
        flat = {"text": (docs.owner, place[docs.number]),
                "meta": (np.repeat(np.arange(docs.n), [len(x) for x in meta]), np.array([k for x in meta for k in x], np.int64))}
        out = {v: np.empty((docs.n, len(TARGETS))) for v in VIEWS}
        for v, (owner, at) in flat.items():
            for k, (prior, slope, offset) in enumerate(self.line[v]):
                out[v][:, k] = slope * (prior + np.bincount(owner, self.weights[v][k][at], docs.n)) + offset
        return out


def logistic(x: np.ndarray, y: np.ndarray, count: np.ndarray | None = None, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients (last: constant) of a logistic regression by Newton steps; row k counts ``count[k]`` times."""
    x = np.column_stack([x, np.ones(len(x))])
    count = np.ones(len(x)) if count is None else count
    b = np.zeros(x.shape[1])
    pull = ridge * np.eye(len(b))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (count * (p * (1 - p) + 1e-9))[:, None]) + pull, x.T @ (count * (y - p)) - pull @ b)
        b += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return b


def association(n1: str, p1: str, n: int, p: int):
    """Likelihood ratio statistic, as a column, of a feature in ``n1`` of ``n`` rows and ``p1`` of the ``p`` positive ones."""
    n1, p1 = F.col(n1).cast("double"), F.col(p1).cast("double")
    with_p, with_n = n1 * p / n, n1 * (n - p) / n
    cells = [(p1, with_p), (n1 - p1, with_n), (p - p1, p - with_p), (n - p - n1 + p1, n - p - with_n)]
    return 2 * sum(F.when((o > 0) & (e > 0), o * F.log(o / e)).otherwise(0.0) for o, e in cells)


def sparse_logistic(rows: list[np.ndarray], y: np.ndarray, n: int, centre: np.ndarray | None = None, ridge: float = RIDGE, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights, drawn towards ``centre``, and constant of a logistic regression on rows of feature numbers, by limited-memory BFGS."""
    sizes = np.array([len(r) for r in rows])
    index = np.concatenate([*rows, np.zeros(0, int)]).astype(int)
    owner = np.repeat(np.arange(len(rows)), sizes)
    centre = np.zeros(n) if centre is None else centre

    def loss(b):
        z = b[n] + np.bincount(owner, b[index], len(rows))
        g = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y
        off = b[:n] - centre
        value = np.logaddexp(0, z).sum() - (y * z).sum() + 0.5 * ridge * (off @ off)
        return value, np.append(np.bincount(index, g[owner], n) + ridge * off, g.sum())

    b = np.append(centre, 0.0)
    b[n] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    value, grad = loss(b)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        d, kept = -grad, []
        for s, t in reversed(past):
            a = (s @ d) / (s @ t)
            kept.append(a)
            d = d - a * t
        if past:
            s, t = past[-1]
            d = d * ((s @ t) / (t @ t))
        for (s, t), a in zip(past, reversed(kept)):
            d = d + s * (a - (t @ d) / (s @ t))
        step, slope = 1.0 if past else 1.0 / max(1.0, np.abs(grad).sum()), grad @ d
        while step > 1e-10:
            new_value, new_grad = loss(b + step * d)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, t = step * d, new_grad - grad
        if s @ t > 1e-12:
            past = [*past[-9:], (s, t)]
        b, done = b + s, value - new_value < 1e-6 * (1 + abs(value))
        value, grad = new_value, new_grad
        if done:
            break
    return b[:n], float(b[n])


FIT = T.StructType([T.StructField("row", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType()),
                    T.StructField("text", T.ArrayType(T.BinaryType())), T.StructField("meta", T.ArrayType(T.BinaryType()))])


def _strings(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang, source; metadata that the table lacks is null."""
    has = {c.lower() for c in docs.columns}
    return docs.select("doc_id", *[(F.col(c).cast("string") if c in has else F.lit(None).cast("string")).alias(c) for c in ("text", "lang", "source")])


def _features(b: pa.RecordBatch) -> dict[str, list[set]]:
    raw = b["text"].cast(pa.binary()).to_pylist()
    return {"text": [text_features(t) for t in raw],
            "meta": [meta_features(x, s, t) for x, s, t in zip(b["lang"].to_pylist(), b["source"].to_pylist(), raw)]}


def _marks(labels: DataFrame) -> DataFrame:
    """doc_id, quality and toxic of the labelled ids, one row each."""
    return labels.select("doc_id", *[F.col(t).cast("int").alias(t) for t in TARGETS]).filter("doc_id is not null and (quality in (0, 1) or toxic in (0, 1))") \
        .groupBy("doc_id").agg(*[F.max(F.when(F.col(t).isin(0, 1), F.col(t))).alias(t) for t in TARGETS])


def sample_rows(docs: DataFrame, labels: DataFrame, labelled_rows: int) -> tuple[DataFrame, DataFrame]:
    """Ids and labels of the labelled sample, and its rows with their features: bounded scratch tables.

    A bound on the hash that about twice as many ids pass comes from their
    count, so that no task is sent more than that, whatever the number of
    partitions.
    """
    known = _marks(labels).join(docs.select("doc_id"), "doc_id", "left_semi")
    share = 1 << 30
    bound = -(-share * 2 * labelled_rows // max(1, known.count()))
    near = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) < bound)
    wanted = materialize(near.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows), "fit-ids")  # at most labelled_rows rows
    met = _strings(docs).join(F.broadcast(wanted), "doc_id").groupBy("doc_id", *TARGETS) \
        .agg(F.min(F.struct("text", "lang", "source")).alias("row")).select("doc_id", *TARGETS, "row.*")  # of rows with one doc_id the least

    def run(batches):
        for b in slices(batches):
            found = _features(b)
            columns = [pa.array([sorted(x) for x in found[v]], pa.list_(pa.binary())) for v in VIEWS]
            yield pa.RecordBatch.from_arrays([b["doc_id"].cast(pa.int64()), b["quality"], b["toxic"], *columns], names=FIT.names)

    rows = met.select(F.col("doc_id").cast("long").alias("doc_id"), *TARGETS, "text", "lang", "source").mapInArrow(run, FIT)
    return wanted, materialize(rows, "fit-rows")


#: Counts of a feature (null: of the documents) beside the labels that 3 * quality + toxic tells: none 0, negative 1, positive 2.
COUNTED = T.StructType([T.StructField("view", T.StringType()), T.StructField("labels", T.IntegerType()), T.StructField("f", T.BinaryType()), T.StructField("n", T.LongType())])


def _code(label) -> int:
    return 0 if label is None else int(label) + 1


class _Counts:
    """Feature counts per view and labels, handed on when many are held."""

    def __init__(self):
        self.held: dict = {}
        self.docs: Counter = Counter()

    def add(self, view: str, codes: list[int], features: list) -> None:
        for code, own in zip(codes, features):
            if code:
                self.docs[view, code] += 1
                self.held.setdefault((view, code), Counter()).update(own)

    def full(self) -> bool:
        return sum(map(len, self.held.values())) > HELD

    def flush(self):
        for (view, code), found in self.held.items():
            n = len(found)
            yield pa.RecordBatch.from_arrays([pa.array([view] * n, pa.string()), pa.array([code] * n, pa.int32()), pa.array(list(found), pa.binary()),
                                              pa.array(list(found.values()), pa.int64())], names=COUNTED.names)
        for (view, code), n in self.docs.items():
            yield pa.RecordBatch.from_arrays([pa.array([view], pa.string()), pa.array([code], pa.int32()), pa.array([None], pa.binary()), pa.array([n], pa.int64())], names=COUNTED.names)
        self.held, self.docs = {}, Counter()


class _TextCounts:
    """The text view's counts per labels over parsed documents, handed on when many features are held."""

    def __init__(self):
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # known keys, ascending, and their places below
        self.names: list[bytes] = []
        self.held = np.zeros((9, 1024), np.int64)

    def _places(self, docs: Parsed) -> np.ndarray:
        where = np.searchsorted(self.keys, docs.keys)
        new = np.ones(len(where), bool)
        inside = where < len(self.keys)
        new[inside] = self.keys[where[inside]] != docs.keys[inside]
        self.at = np.insert(self.at, where[new], len(self.names) + np.arange(new.sum()))
        self.keys = np.insert(self.keys, where[new], docs.keys[new])
        self.names += docs.names(np.flatnonzero(new))
        if len(self.names) > self.held.shape[1]:
            self.held = np.pad(self.held, ((0, 0), (0, 2 * len(self.names) - self.held.shape[1])))
        return self.at[np.searchsorted(self.keys, docs.keys)]

    def add(self, codes: list[int], docs: Parsed) -> None:
        if not len(docs.keys):
            return
        place, own = self._places(docs), np.array(codes)[docs.owner]
        for code in sorted(set(codes) - {0}):
            self.held[code, place] += np.bincount(docs.number[own == code], minlength=len(place))

    def full(self) -> bool:
        return len(self.names) > HELD

    def flush(self):
        names = pa.array(self.names, pa.binary())
        for code in range(1, 9):
            which = np.flatnonzero(self.held[code])
            for k in range(0, len(which), 1 << 16):
                part = which[k:k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(["text"] * len(part), pa.string()), pa.array([code] * len(part), pa.int32()), names.take(pa.array(part)),
                                                  pa.array(self.held[code][part])], names=COUNTED.names)
        self.__init__()


def known_counts(rows: DataFrame) -> DataFrame:
    """Counts over labelled rows with their features."""
    def run(batches):
        counts = _Counts()
        for b in slices(batches):
            codes = [3 * _code(q) + _code(t) for q, t in zip(b["quality"].to_pylist(), b["toxic"].to_pylist())]
            for v in VIEWS:
                counts.add(v, codes, b[v].to_pylist())
            if counts.full():
                yield from counts.flush()
        yield from counts.flush()

    return rows.select(*TARGETS, *VIEWS).mapInArrow(run, COUNTED)


def taught(logits: dict[str, np.ndarray], pupil: str) -> list[int]:
    """What the other view teaches ``pupil`` about each row: labels as in ``COUNTED``."""
    teacher = VIEWS[1 - VIEWS.index(pupil)]
    own, other = logits[teacher], logits[pupil]
    said = (np.abs(own) >= math.log(CONFIDENT / (1 - CONFIDENT))) & ((own * other >= 0) | (np.abs(own) > np.abs(other)))
    return (np.where(said, 1 + (own > 0), 0) @ [3, 1]).tolist()


def taught_counts(docs: DataFrame, sample: DataFrame, views: dict) -> DataFrame:
    """Counts over all documents outside the sample, beside the labels that the views give each other."""
    shared = docs.sparkSession.sparkContext.broadcast(Scorer(views))

    def run(batches):
        meta, text = _Counts(), _TextCounts()
        for b in slices(batches):
            found = parsed(b)
            logits = shared.value.logits(found)
            codes = {v: taught(logits, v) for v in VIEWS}
            meta.add("meta", codes["meta"], found.meta)
            meta.add("text", codes["text"], [()] * found.n)  # the documents
            text.add(codes["text"], found)
            if text.full():
                yield from text.flush()
        yield from meta.flush()
        yield from text.flush()

    others = _strings(docs).join(F.broadcast(sample.select("doc_id")), "doc_id", "left_anti")
    return others.select("text", "lang", "source").mapInArrow(run, COUNTED)


def selected(counts: DataFrame, terms: int = TERMS) -> tuple[dict, dict]:
    """Per (target, view): rows and positive rows in all, and the selected features with theirs.

    At most ``terms`` features, those of the highest association; the level
    that so many reach comes from a histogram with steps of a 16th of a
    doubling, so no features are sorted.
    """
    label = {"quality": F.floor(F.col("labels") / 3), "toxic": F.col("labels") % 3}
    sums = [x for t in TARGETS for x in (F.sum(F.when(label[t] > 0, F.col("n")).otherwise(0)).alias(f"n_{t}"), F.sum(F.when(label[t] == 2, F.col("n")).otherwise(0)).alias(f"p_{t}"))]
    found = materialize(counts.groupBy("view", "f").agg(*sums).filter("f is null or " + " or ".join(f"n_{t} >= 5" for t in TARGETS)), "feature-counts")
    totals = {(t, r["view"]): (r[f"n_{t}"], r[f"p_{t}"]) for r in found.filter("f is null").collect() for t in TARGETS}
    usable = [(k, n, p) for k, (n, p) in totals.items() if 0 < p < n]
    if not usable:
        return totals, {}
    rated = F.array(*[F.when((F.col("view") == v) & (F.col(f"n_{t}") >= 5), F.struct(F.lit(t).alias("target"), F.col(f"n_{t}").alias("n"), F.col(f"p_{t}").alias("p"),
                                                                                   association(f"n_{t}", f"p_{t}", n, p).alias("g"))) for (t, v), n, p in usable])
    own = found.filter("f is not null").select("view", "f", F.explode(F.filter(rated, lambda x: x["g"] >= Z_LEAST ** 2)).alias("x")) \
        .select("view", "f", "x.target", "x.n", "x.p", F.floor(F.log2("x.g") * 16).alias("step"))
    steps: dict = {}
    for r in own.groupBy("target", "view", "step").count().collect():
        steps.setdefault((r["target"], r["view"]), []).append((r["step"], r["count"]))
    wanted = F.lit(False)
    for (t, v), levels in steps.items():
        levels.sort(reverse=True)
        inside = [s for (s, _), k in zip(levels, np.cumsum([c for _, c in levels])) if k <= terms]
        if inside:
            wanted = wanted | ((F.col("target") == t) & (F.col("view") == v) & (F.col("step") >= min(inside)))
    table = own.filter(wanted).toArrow()  # at most ``terms`` rows per target and view
    chosen: dict = {}
    for t, v, f, n, p in zip(*[table[c].to_pylist() for c in ("target", "view", "f", "n", "p")]):
        chosen.setdefault((t, v), {})[bytes(f)] = (n, p)
    return totals, chosen


def log_odds(counts: dict, n: int, p: int) -> np.ndarray:
    """Of each feature, how much likelier it is in positive rows than in the others, as a logarithm."""
    n1, p1 = np.array(list(counts.values()), float).reshape(-1, 2).T
    return np.log((p1 + 0.5) / (p + 1)) - np.log((n1 - p1 + 0.5) / (n - p + 1))


def fit_views(rows: DataFrame, counts: DataFrame, centred: bool) -> dict:
    """Views of both targets with features selected by ``counts``, fitted to the sample's ``rows``, drawn towards the log
    odds of ``counts`` if ``centred``, and calibrated on the sample's rows kept apart."""
    views = {(t, v): View() for t in TARGETS for v in VIEWS}
    totals, chosen = selected(counts)
    chosen = {k: dict(sorted(x.items())) for k, x in chosen.items()}
    number = {v: {f: k for k, f in enumerate(sorted({f for t in TARGETS for f in chosen.get((t, v), ())}))} for v in VIEWS}
    own = _numbered(rows, number).toArrow().sort_by("row")  # the bounded rows, with selected features only
    away = np.array(own["apart"].to_pylist(), bool)
    for v in VIEWS:
        numbers = [np.array(x, int) for x in own[v].to_pylist()]
        for t in TARGETS:
            view, marked = views[t, v], own[t].to_pylist()
            known = np.array([y is not None for y in marked], bool)
            y = np.array([y or 0 for y in marked], float)
            fitted, rest = np.flatnonzero(known & ~away), np.flatnonzero(known & away)
            view.prior = math.log((y[fitted].sum() + 0.5) / (len(fitted) - y[fitted].sum() + 0.5))
            features = chosen.get((t, v))
            if not features or not 0 < y[fitted].sum() < len(fitted):
                continue
            use = np.full(len(number[v]), -1)
            use[[number[v][f] for f in features]] = np.arange(len(features))
            held = [x[x >= 0] for x in (use[x] for x in numbers)]
            centre = None
            if centred:
                centre = log_odds(features, *totals[t, v])
                centre = centre * max(0.0, logistic(np.array([centre[held[k]].sum() for k in fitted]), y[fitted])[0])
            w, view.prior = sparse_logistic([held[k] for k in fitted], y[fitted], len(features), centre)
            view.weights = dict(zip(features, w.tolist()))
            if 0 < y[rest].sum() < len(rest):
                view.slope, view.offset = map(float, logistic(np.array([view.prior + w[held[k]].sum() for k in rest]), y[rest]))
    return views


def _numbered(rows: DataFrame, number: dict) -> DataFrame:
    """The sample's rows with their labels, whether they are kept apart, and the numbers of their selected features."""
    names = ["row", *TARGETS, "apart", *VIEWS]
    kind = T.StructType([T.StructField("row", T.LongType()), *[T.StructField(m, T.IntegerType()) for m in names[1:4]], *[T.StructField(v, T.ArrayType(T.IntegerType())) for v in VIEWS]])
    shared = rows.sparkSession.sparkContext.broadcast(number)

    def run(batches):
        for b in slices(batches):
            out = {v: [sorted([shared.value[v][f] for f in x if f in shared.value[v]]) for x in b[v].to_pylist()] for v in VIEWS}
            yield pa.RecordBatch.from_arrays([*[b[m] for m in names[:4]], *[pa.array(out[v], pa.list_(pa.int32())) for v in VIEWS]], names=names)

    return rows.select("row", *TARGETS, _kept_apart("row").cast("int").alias("apart"), *VIEWS).mapInArrow(run, kind)


def _kept_apart(row: str):
    return F.pmod(F.xxhash64(F.col(row).cast("long"), F.lit("apart")), F.lit(APART)) == 0


@dataclass
class Model:
    """Views, and per target: each view's calibration, the combination of the views' logits, and the threshold on it (a logit)."""
    views: dict
    lines: dict = field(default_factory=dict)
    combine: dict = field(default_factory=dict)
    thresholds: dict = field(default_factory=dict)

    def logit(self, target: str, view: str | None = None):
        """Column over ``view_scores``: the combined logit, or a view's."""
        if view:
            slope, offset = self.lines[target, view]
            return slope * F.col(f"{target}_{view}") + offset
        *b, constant = self.combine[target]
        return sum((x * F.col(f"{target}_{v}") for x, v in zip(b, VIEWS)), F.lit(constant))


def _threshold(score: np.ndarray, stays: np.ndarray, max_loss: float, count: np.ndarray | None = None) -> float:
    """Logits below it are rejected: 0, or what comes next to it in the gap that separates best among those that reject
    at most ``max_loss`` of the rows that stay; row k counts ``count[k]`` times."""
    order = np.argsort(score)
    s, good = score[order], stays[order]
    count = np.ones(len(s)) if count is None else count[order]
    if not good.any() or good.all():
        return -math.inf
    lost, caught = np.cumsum(good * count) / (good * count).sum(), np.cumsum(~good * count) / (~good * count).sum()
    ends = np.append(s[1:] > s[:-1], True)
    gain = np.where(ends & (lost <= max_loss), caught - lost, -1.0)
    k = int(gain.argmax())
    if gain[k] <= 0:
        return -math.inf
    low, high = s[k], s[k + 1] if k + 1 < len(s) else math.inf
    margin = min(1e-6, (high - low) / 2)
    return float(min(max(0.0, low + margin), high - margin))


def learn(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, labelled_rows: int = LABELLED_ROWS) -> tuple[dict, DataFrame]:
    """The views after all rounds, and the ids of the labelled sample."""
    ship_code(docs.sparkSession)
    sample, rows = sample_rows(docs, labels, labelled_rows)
    known = known_counts(rows.filter(~_kept_apart("row")))
    views = fit_views(rows, known, centred=False)
    for _ in range(rounds):
        views = fit_views(rows, known.union(taught_counts(docs, sample, views)), centred=True)
    return views, sample


def view_scores(docs: DataFrame, views: dict) -> DataFrame:
    """doc_id and the logits of all views for every document, in one pass without a shuffle."""
    ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Scorer(views))
    held = _strings(docs)
    names = [f"{t}_{v}" for v in VIEWS for t in TARGETS]

    def run(batches):
        for b in slices(batches):
            logits = shared.value.logits(parsed(b))
            out = np.concatenate([logits[v] for v in VIEWS], axis=1)
            yield pa.RecordBatch.from_arrays([b["doc_id"], *[pa.array(np.ascontiguousarray(out[:, k])) for k in range(len(names))]], names=["doc_id", *names])

    return held.mapInArrow(run, T.StructType([held.schema["doc_id"], *[T.StructField(c, T.DoubleType()) for c in names]]))


def _steps(column, per_one: int, most: int = 32):
    """A logit in steps, from -``most`` to ``most``."""
    return F.round(F.greatest(F.least(column, F.lit(float(most))), F.lit(float(-most))) * per_one).cast("int")


def calibrate(views: dict, scores: DataFrame, labels: DataFrame, sample: DataFrame, max_good_loss: float = MAX_GOOD_LOSS) -> Model:
    """Calibration, combination and thresholds from all labelled rows that no view was fitted to.

    Spark counts the rows per label and step of the views' logits, then of the
    combined logit; the driver gets these histograms, not rows.
    """
    fitted = sample.filter(~_kept_apart("doc_id")).select("doc_id")
    marked = materialize(scores.join(_marks(labels), "doc_id").join(F.broadcast(fitted), "doc_id", "left_anti"), "labelled-scores")
    model = Model(views)
    shares = marked.agg(*[F.avg(t).alias(t) for t in TARGETS]).first()
    for t in TARGETS:
        found = marked.filter(F.col(t).isNotNull()).groupBy(F.col(t).alias("y"), *[_steps(F.col(f"{t}_{v}"), 16).alias(v) for v in VIEWS]).count().toArrow()
        y, count = (np.array(found[c].to_pylist(), float) for c in ("y", "count"))
        z = np.stack([np.array(found[v].to_pylist(), float) / 16 for v in VIEWS], axis=1)
        order = np.lexsort((z[:, 1], z[:, 0], y))
        y, count, z = y[order], count[order], z[order]
        model.thresholds[t] = -math.inf
        if not len(y) or y.min() == y.max():
            share = shares[t]
            prior = views[t, "text"].prior if share is None else math.log((share + 1e-9) / (1 - share + 1e-9))
            model.lines |= {(t, v): (0.0, prior) for v in VIEWS}
            model.combine[t] = [0.0] * len(VIEWS) + [prior]
            continue
        for k, v in enumerate(VIEWS):
            model.lines[t, v] = tuple(logistic(z[:, k], y, count).tolist())
        model.combine[t] = logistic(z, y, count).tolist()
    wanted = [t for t in TARGETS if any(model.combine[t][:-1])]
    for t in wanted:
        sign = 1 if t == "quality" else -1  # low quality and high toxicity are rejected
        found = marked.filter(F.col(t).isNotNull()).groupBy(F.col(t).alias("y"), _steps(sign * model.logit(t), 4096).alias("s")).count().toArrow()
        y, s, count = (np.array(found[c].to_pylist(), float) for c in ("y", "s", "count"))
        model.thresholds[t] = _threshold(s / 4096, sign * y == max(0, sign), max_good_loss, count)
    return model


def fit(docs: DataFrame, labels: DataFrame, **options) -> Model:
    views, sample = learn(docs, labels, **options)
    return calibrate(views, view_scores(docs, views), labels, sample)


SCORES = ("quality_score", "toxic_score", "text_quality", "meta_quality", "text_toxic", "meta_toxic")


def combined(scores: DataFrame, model: Model) -> DataFrame:
    """doc_id, the scores, ``toxic`` and ``kept`` of every row of ``view_scores``."""
    logits = [model.logit(t) for t in TARGETS] + [model.logit(t, v) for t in TARGETS for v in VIEWS]
    stays = {t: F.lit(True) if math.isinf(model.thresholds[t]) else (1 if t == "quality" else -1) * model.logit(t) >= model.thresholds[t] for t in TARGETS}
    return scores.select("doc_id", *[F.round(1 / (1 + F.exp(-x)), 12).alias(c) for x, c in zip(logits, SCORES)], (~stays["toxic"]).alias("toxic"),
                         (stays["toxic"] & stays["quality"]).alias("kept"))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    return combined(view_scores(docs, model.views), model)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``score_documents`` by a fit to the same documents, which are scored once."""
    views, sample = learn(docs, labels, **options)
    scores = materialize(view_scores(docs, views), "view-scores")
    return combined(scores, calibrate(views, scores, labels, sample))
