"""Quality rules: isolation forests on rule statistics, their threshold calibrated from labels.

Every document's rule statistics give a vector of unrounded shares between 0
and 1: symbols, upper case, immediate repeats, digits, punctuation, duplicate
lines, words per character, words in repeated windows.  One forest per
statistic is grown on sound documents: a bounded sample (``fit_rows`` distinct
vectors, by hash) of the rows labelled good, ``tree_rows`` drawn for each
tree.  Splits are drawn from all that is left of 0 to 1, not between the
sample's extremes only, so values where no sound document lies end in empty
branches after few splits.  A row's path length for a statistic is the mean
over the trees; its path length is the shortest over the statistics, and its
anomaly score ``2 ** (-path / c(tree_rows))``.  Labels enter the score through
the choice of the sample alone; all rows go down the same trees.

The threshold comes from the scores of *all* labelled rows: the score that
best separates quality 0 from 1 (largest difference of the two rates above
it) among those that reject at most ``max_good_loss`` of the good rows.
Without labels of both kinds nothing but the base rules rejects.

A tree on one statistic is a step function of it, and so is a forest: it is
kept as that, and a row is scored by one search per statistic.

The sample bounds only what the trees are fitted on; statistics, calibration
and verdicts cover all rows, in one pass over the texts plus small tables.

Defined results: null and empty texts have no words and fail the base rules;
repeated rows are judged one by one, equal texts alike; scores that tie with
the threshold are rejected; labels may be null or repeat (each row counts; a
null label does not); no labels or no documents are fine.  A text is worked on
whole, in memory in proportion to it.  Extra columns of any name are ignored
by the statistics and kept by ``keep_good``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.llm.common import hold, materialize, ship_code, slices

TREES = 64
TREE_ROWS = 256
#: Splits on a path at most.
DEPTH = 12
#: Distinct statistic vectors of good rows that the trees draw from.
FIT_ROWS = 8192
#: Share of labelled good rows that the threshold may reject.
MAX_GOOD_LOSS = 0.005
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("symbol_share", "upper_share", "again_share", "digit_share", "punct_share", "dup_line_share", "words_per_char", "repeat_share")

_SPACE = bytes([0x20, *range(0x09, 0x0E)])
_TAIL = bytes(range(0x80, 0xC0))  # bytes of a code point after its first
_SYMBOLS = b"#*$%&|<>"
_UPPER, _LOWER, _DIGIT = bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789"
_PUNCT = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in _SYMBOLS)


def _count(text: bytes, which: bytes) -> int:
    return len(text) - len(text.translate(None, which))


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that are found twice or more, the first one included."""
    n = len(words)
    if n <= window:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    base, size = np.array([0x9E3779B97F4A7C15], np.uint64), 1
    while size < window:  # hashes of 2, 4, 8 words
        h = h[:-size] * base + h[size:]
        base, size = base * base, 2 * size
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return 0
    # some windows repeat, as their hashes say: now by the words themselves
    number: dict[bytes, int] = {}
    rank = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    size = 1
    while size < window:
        rank = np.unique(rank[:-size] * (n + 1) + rank[size:], return_inverse=True)[1]
        size *= 2
    again = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def statistics(text: bytes | None) -> tuple[int, int, int, int, int, list[float]]:
    """The five base counts and the vector of shares of one UTF-8 text."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, [0.0] * len(FEATURES)
    chars = len(text.translate(None, _SPACE + _TAIL))
    symbols = _count(text, _SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = repeat_words(words)
    upper, lower = _count(text, _UPPER), _count(text, _LOWER)
    again = sum(map(bytes.__eq__, words, words[1:]))
    return n, chars, symbols, dup, repeat, [
        symbols / chars, upper / max(1, upper + lower), again / n, _count(text, _DIGIT) / chars, _count(text, _PUNCT) / chars,
        dup / len(lines), n / chars, repeat / n]


class Forest:
    """One forest per statistic, as the step function of its mean path length.

    ``edges[f]`` are the split points of all its trees, ascending;
    ``paths[f][k]`` holds for values from ``edges[f][k - 1]`` on.
    """

    def __init__(self, sample: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, depth: int = DEPTH, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.rows = min(tree_rows, len(sample))
        self.edges, self.paths = [], []
        for f in range(sample.shape[1] if len(sample) else 0):
            starts, steps, first = [], [], 0.0
            for _ in range(trees):
                leaves = grow(np.sort(sample[rng.choice(len(sample), self.rows, replace=False), f]), depth, rng)
                at, path = np.array(leaves).T
                first += path[0]
                starts.append(at[1:])
                steps.append(np.diff(path))
            starts, steps = np.concatenate(starts), np.concatenate(steps)
            order = np.argsort(starts, kind="stable")
            self.edges.append(starts[order])
            self.paths.append(np.concatenate([[first], first + np.cumsum(steps[order])]) / trees)

    def path_lengths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of each row for each statistic."""
        return np.column_stack([p[np.searchsorted(e, x[:, f], "right")] for f, (e, p) in enumerate(zip(self.edges, self.paths))])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores from 0 to 1, by the shortest path over the statistics; 0.5 without trees."""
        if not self.edges:
            return np.full(len(x), 0.5)
        return np.round(2.0 ** (-self.path_lengths(x).min(axis=1) / max(1.0, expected_path(self.rows))), 12)


def grow(x: np.ndarray, depth: int, rng: np.random.Generator, low: float = 0.0, high: float = 1.0, level: int = 0) -> list[tuple[float, float]]:
    """The leaves (first value, path length) of one random tree over the sorted values ``x`` between ``low`` and ``high``.

    A branch ends when no value is in it or ``depth`` splits are made; values
    that a leaf still holds count as the splits that would tell them apart.
    """
    if level == depth or not len(x) or not high > low:
        return [(low, level + expected_path(len(x)))]
    at = rng.uniform(low, high)
    k = int(np.searchsorted(x, at))
    return grow(x[:k], depth, rng, low, at, level + 1) + grow(x[k:], depth, rng, at, high, level + 1)


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def _stat_columns(raw: list) -> list[pa.Array]:
    rows = [statistics(t) for t in raw]
    cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
    return [*cols, pa.array([r[5] for r in rows], pa.list_(pa.float64()))]


def rule_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and ``features`` per row of ``docs``."""
    ship_code(docs.sparkSession)
    held = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b["doc_id"], *_stat_columns(b["text"].cast(pa.binary()).to_pylist())], names=["doc_id", *BASE, "features"])

    return held.mapInArrow(run, T.StructType([held.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in BASE], T.StructField("features", T.ArrayType(T.DoubleType()))]))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def fit_forest(marked: DataFrame, fit_rows: int = FIT_ROWS) -> Forest:
    """A forest on at most ``fit_rows`` distinct vectors of the good rows of ``marked_rows``, by hash order.

    The count sets a bound on the hash that about twice as many pass, so the
    driver is sent that many whatever the number of partitions.
    """
    vectors = marked.filter("quality = 1").select("features").dropDuplicates(["features"])
    share = 1 << 20
    bound = -(-share * 2 * fit_rows // max(1, vectors.count()))
    near = vectors.filter(F.pmod(F.xxhash64("features"), F.lit(share)) < bound)
    rows = near.orderBy(F.xxhash64("features"), "features").limit(fit_rows).collect()
    return Forest(np.array([r[0] for r in rows], float).reshape(len(rows), len(FEATURES)))


def _vectors(b: pa.RecordBatch) -> np.ndarray:
    return b["features"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(FEATURES))


def scored(stats: DataFrame, forest: Forest) -> DataFrame:
    """``stats`` with its features exchanged for the anomaly score."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)
    names = [c for c in stats.columns if c != "features"]

    def run(batches):
        for b in slices(batches, 4096):
            yield pa.RecordBatch.from_arrays([*[b[n] for n in names], pa.array(shared.value.score(_vectors(b)))], names=[*names, "anomaly"])

    return stats.mapInArrow(run, T.StructType([*[stats.schema[n] for n in names], T.StructField("anomaly", T.DoubleType())]))


def marked_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality and features of all labelled rows that pass the base rules."""
    marks = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1) and doc_id is not null")
    return stats.filter(~base_failed()).join(marks, "doc_id").select("quality", "features")


def calibrate(scores: DataFrame, max_good_loss: float = MAX_GOOD_LOSS) -> float:
    """The threshold (reject above it) from the quality and score of all labelled rows; infinity without both kinds.

    The scores are grouped to four decimals, at most 10,001 groups.
    """
    rows = scores.groupBy(F.floor(F.col("anomaly") * 10000).alias("s")) \
        .agg(F.sum(1 - F.col("quality")).alias("bad"), F.sum("quality").alias("good")).collect()
    if not rows:
        return float("inf")
    rows = sorted((r["s"], r["bad"], r["good"]) for r in rows)
    s, bad, good = (np.array(c, float) for c in zip(*rows))
    if not bad.sum() or not good.sum():
        return float("inf")
    caught, lost = bad[::-1].cumsum()[::-1] / bad.sum(), good[::-1].cumsum()[::-1] / good.sum()
    gain = np.where(lost <= max_good_loss, caught - lost, -1.0)
    best = int(gain.argmax())
    if gain[best] <= 0:
        return float("inf")
    return float((s[best] + (s[best - 1] + 1 if best else s[best])) / 20000)  # midway to the next group below


def fit(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Forest, float]:
    """Statistics of all rows (a scratch table), the forest, and the threshold."""
    stats = materialize(rule_statistics(docs), "rule-statistics")
    marked = materialize(marked_rows(stats, labels), "marked-statistics")
    forest = fit_forest(marked)
    return stats, forest, calibrate(scored(marked, forest))


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed, kept and the anomaly score per row of ``docs``."""
    stats, forest, threshold = fit(docs, labels)
    out = scored(stats, forest).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < threshold)).select("doc_id", *BASE, "base_failed", "kept", "anomaly")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``; statistics are made again beside the texts, so no text is shuffled."""
    _, forest, threshold = fit(docs, labels)
    held, text = hold(docs.withColumn("text", F.col("text").cast("string")))
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches):
        for b in slices(batches):
            rows = [statistics(t) for t in b[text].cast(pa.binary()).to_pylist()]
            score = shared.value.score(np.array([r[5] for r in rows]))
            keep = [r[0] >= MIN_WORDS and 100 * r[4] <= REPEAT_PERCENT * r[0] and s < threshold for r, s in zip(rows, score)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return held.mapInArrow(run, held.schema).toDF(*docs.columns)
