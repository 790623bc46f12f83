"""Base counts against plain loops; the forest finds planted junk and keeps clean rows."""

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import quality_rules as Q
from tests.llm.helpers import documents, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    n, w = len(words), Q.WINDOW
    grams = [tuple(words[k:k + w]) for k in range(n - w + 1)]
    hit = {p for k, g in enumerate(grams) if grams.count(g) > 1 for p in range(k, k + w)}
    lines = (text or "").split("\n")
    dup = sum(bool(WORD.search(x)) and x in lines[:k] for k, x in enumerate(lines))
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é#", "x|", " ", "\n", " ", "\x0b", " ", "\x1c"]), max_size=70).map("".join))
def test_base_counts(text):
    got = Q.statistics(text.encode())
    assert got[:4] == plain(text)[:4] if not got[0] == 0 else plain(text)[0] == 0
    if got[0]:
        assert got[:5] == plain(text)


def test_repeats():
    words = [f"w{k}" for k in range(10)]
    assert Q.repeat_words([w.encode() for w in words + ["mid"] + words]) == 20
    assert Q.repeat_words([b"a"] * 9) == 9 and Q.repeat_words([b"a"] * 8) == 0 and Q.repeat_words([]) == 0


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(900)]
    texts, marks = [], []
    for k in range(n):
        words = rng.choices(vocab, k=rng.randint(30, 200))
        if k % 9 == 0:
            words = [w + rng.choice(["***", "$$$", "&&&"]) for w in words]
        elif k % 9 == 1:
            words = [w.upper() for w in words]
        texts.append(" ".join(words).capitalize() if k % 9 > 1 else " ".join(words))
        marks.append(0 if k % 9 < 2 else 1)
    return texts, marks


def test_held_out_accuracy(spark):
    texts, marks = corpus()
    df = with_clashes(documents(spark, texts), "anomaly", "features", "_0", "quality")
    labels = spark.createDataFrame([(k, m, 0) for k, m in enumerate(marks) if k % 2] + [(1, None, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in Q.verdicts(df, labels).collect()}
    held_out = [k for k in range(len(marks)) if k % 2 == 0]
    assert np.mean([got[k]["kept"] == bool(marks[k]) for k in held_out]) > 0.97
    assert all(got[k]["kept"] for k in held_out if marks[k])
    kept = Q.keep_good(df, labels)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, r in got.items() if r["kept"])


def test_awkward_rows(spark):
    texts = [None, "", " \n\t", "one", "long " * 60_000, "\n".join(["same line of words here"] * 5)] + [" ".join(f"w{k}" for k in range(30))] * 3
    df = documents(spark, texts)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in Q.verdicts(df, labels).collect()}
    assert [got[k]["base_failed"] for k in range(len(texts))] == [True] * 6 + [False] * 3
    assert [tuple(got[k][c] for c in Q.BASE) for k in range(len(texts)) if k != 4] == [plain(t) for k, t in enumerate(texts) if k != 4]
    assert got[4]["n_repeat_words"] == 60_000 and all(got[k]["kept"] for k in (6, 7, 8))
    assert Q.verdicts(df.limit(0), labels).count() == 0 and Q.keep_good(df.limit(0), labels).count() == 0


def plain_path(leaves, value):
    """The path length of a value in one tree's leaves."""
    return [path for low, path in leaves if low <= value or low == 0.0][-1]


def test_forest_equals_its_trees():
    """The step function against walking down every tree, drawn again from the same seed."""
    rng = np.random.default_rng(0)
    sample = np.concatenate([rng.random((300, 2)) ** 3, np.zeros((50, 2)), np.ones((3, 2))])
    forest = Q.Forest(sample, trees=9, tree_rows=64, depth=6, seed=5)
    again = np.random.default_rng(5)
    x = np.concatenate([rng.random((40, 2)), sample[::40], [[0.0, 1.0], [1.0, 0.0]]])
    for f in range(2):
        trees = [Q.grow(np.sort(sample[again.choice(len(sample), 64, replace=False), f]), 6, again) for _ in range(9)]
        want = [np.mean([plain_path(t, v) for t in trees]) for v in x[:, f]]
        assert np.allclose(forest.path_lengths(x)[:, f], want)
    assert np.allclose(forest.score(x), 2.0 ** (-forest.path_lengths(x).min(axis=1) / Q.expected_path(64)))


def test_a_literal_tree():
    """Splits 0.5, then 0.25 left of it; right of 0.5 nothing lies, so that branch ends at once."""
    class Half:
        def uniform(self, low, high):
            return (low + high) / 2

    assert Q.grow(np.array([0.1, 0.3, 0.3]), 2, Half()) == [(0.0, 2 + Q.expected_path(1)), (0.25, 2 + Q.expected_path(2)), (0.5, 1.0)]
    assert Q.grow(np.array([]), 5, Half()) == [(0.0, 0.0)]
    assert [Q.expected_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0] and abs(Q.expected_path(256) - 10.24) < 0.01


def test_path_lengths_decide():
    rng = np.random.default_rng(0)
    good = np.abs(rng.normal(0, 0.001, (500, 5)))
    forest = Q.Forest(good)
    far, near = forest.score(np.array([[0, 0, 0, 0, 0.3]]))[0], forest.score(good).max()
    assert far > near
    for k in range(len(forest.paths)):
        forest.paths[k][:] = 7.0
    assert len(set(forest.score(np.concatenate([good, [[0, 0, 0, 0, 0.3]]])))) == 1
    assert Q.Forest(np.zeros((0, 5))).score(np.zeros((2, 5))).tolist() == [0.5, 0.5]
    assert np.isfinite(Q.Forest(np.zeros((1, 5))).score(np.ones((1, 5)))).all()


def test_the_sample_is_bounded(spark):
    rows = [(k % 3 > 0, [k / 1000] * 8) for k in range(900)]
    marked = spark.createDataFrame([(int(g), v) for g, v in rows + rows], "quality int, features array<double>").repartition(5)
    whole, some = Q.fit_forest(marked), Q.fit_forest(marked, fit_rows=40)
    assert whole.rows == 256 and some.rows == 40
    assert some.edges[0].tolist() == Q.fit_forest(marked.repartition(2), fit_rows=40).edges[0].tolist()


def test_junk_by_small_shares_is_learned_from_labels(spark):
    """Bad rows that differ by 1.5 % symbols, by duplicate lines or by the length of their words alone."""
    rng = random.Random(4)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(900)]
    texts, marks = [], []
    for k in range(720):
        words = rng.choices(vocab, k=rng.randint(80, 200))
        lines = [" ".join(words[j:j + 7]) for j in range(0, len(words), 7)]
        if k % 12 == 0:
            lines = [x + "#" * (j % 2 == 0) for j, x in enumerate(lines)]
        elif k % 12 == 1:
            lines = [y for j, x in enumerate(lines) for y in ((x, "Read on") if j % 3 == 0 else (x,))]
        elif k % 12 == 2:
            lines = [x.replace(" ", "", 3) for x in lines]
        texts.append("\n".join(lines))
        marks.append(int(k % 12 > 2))
    labels = spark.createDataFrame([(k, m, 0) for k, m in enumerate(marks) if k // 12 % 2], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in Q.verdicts(documents(spark, texts), labels).collect()}
    held_out = [k for k in range(len(marks)) if k // 12 % 2 == 0]
    assert not any(r["base_failed"] for r in got.values())
    for kind in range(3):
        assert np.mean([not got[k]["kept"] for k in held_out if k % 12 == kind]) > 0.9
    assert np.mean([got[k]["kept"] for k in held_out if marks[k]]) > 0.98
