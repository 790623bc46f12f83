"""The n-gram join against all pairs, also with every group treated as large."""

import random

import numpy as np
import pytest

from courtside.llm import components as C
from courtside.llm import ngram_join as J
from tests.llm.helpers import documents, with_clashes


def words_of(text):
    return (text or "").encode().translate(J._LOWER).split()


def set_of(text, n=5):
    w = words_of(text)
    return {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def brute(pairs, percent=75):
    sets = [set_of(t) for _, t in pairs]
    comp = list(range(len(pairs)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(pairs)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                comp[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(pairs):
        r = root(k)
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    return sorted((str(i), len(s), str(least[root(k)] if s else i)) for k, ((i, _), s) in enumerate(zip(pairs, sets)))


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"v{k}" for k in range(300)]
    common = " ".join(rng.choices(vocab, k=60))
    texts = []
    for g in range(12):
        base = rng.choices(vocab, k=rng.choice([4, 6, 30, 80, 200]))
        if g % 3 == 0:
            base = base + common.split()
        for _ in range(rng.choice([1, 2, 5, 14])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            texts.append(" ".join(own))
    texts += [t.upper().replace(" ", "\n") for t in texts[:6]] + [common + " " + " ".join(rng.choices(vocab, k=8)) for _ in range(12)]
    texts += [None, "", " \t ", "one", "ONE", "one two", "one two three four", "a a a a a a a a", "a a a a a"]
    pairs = [(1000 - k, t) for k, t in enumerate(texts)]
    pairs += pairs[3:6] + [(pairs[0][0], "another text with the same id and some more words"), (None, pairs[8][1]), (None, "only null here with seven words")]
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("seed, small", [(1, 6), (2, 1), (3, 1)])
def test_join_equals_all_pairs(spark, monkeypatch, seed, small):
    monkeypatch.setattr(J, "CHUNK", 1 << 10)
    monkeypatch.setattr(J, "FREQUENT_LEAST", 6)
    if small == 1:
        monkeypatch.setattr(J, "candidates", lambda e, percent=75, f=J.candidates: f(e, percent, 1))
    pairs = corpus(seed)
    got = J.join_documents(with_clashes(documents(spark, pairs), "node", "comp", "key"))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got.collect()) == brute(pairs)


def _with_pivots(rest, *args):
    J.PIVOTS, kept = (8,), J.PIVOTS
    try:
        return rest(*args)
    finally:
        J.PIVOTS = kept


def test_without_pivot_rounds(spark, monkeypatch):
    """Large groups that pivots leave apart are joined by the exact rest alone."""
    monkeypatch.setattr(J, "PIVOTS", ())
    monkeypatch.setattr(J, "_rest", lambda e, c, k, f=J._rest: _with_pivots(f, e, c, k))
    monkeypatch.setattr(J, "candidates", lambda e, percent=75, f=J.candidates: f(e, percent, 1))
    pairs = corpus(4)
    got = J.join_documents(documents(spark, pairs))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got.collect()) == brute(pairs)


def test_keep_first(spark):
    pairs = corpus(5)
    df = with_clashes(documents(spark, pairs), "_d", "_h", "node", "comp")
    kept = J.keep_first(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    with_words = [(i, t) for i, t in pairs if words_of(t)]
    components = {}
    for (i, _, c) in brute(with_words):
        components.setdefault(c, set()).add(i)
    assert len([r for r in rows if words_of(r["text"])]) == len(set(c for _, _, c in brute(with_words) if c != "None")) + sum(c == "None" for c in components)
    assert sum(not words_of(r["text"]) for r in rows) == sum(not words_of(t) for _, t in pairs)
    assert J.keep_first(df.limit(0)).count() == 0 and J.join_documents(df.limit(0)).count() == 0


def test_prefixes_of_linked_sets_share_enough():
    rng = np.random.default_rng(7)
    linked = 0
    for _ in range(3000):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 200, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.choice([0.8, 0.9, 1])], rng.integers(0, 200, rng.integers(0, 12)).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if not common or 100 * common < 75 * (len(a) + len(b) - common):
            continue
        linked += 1
        assert common >= J.least_overlap(len(a), len(b))
        shared = len(set(a[:J.prefix_length(len(a))].tolist()) & set(b[:J.prefix_length(len(b))].tolist()))
        assert shared >= max(1, J.least_in_prefix(len(a), len(b)), min(len(a), len(b)) // J.MORE, )
    assert linked > 300


def test_shingles_are_distinct_and_alike_in_any_batch():
    rng = random.Random(3)
    texts = [None, "", "a", "A b", "a b c d", "a b c d e"] + [" ".join(rng.choices(["ab", "ba", "Éa", "aab", "x" * 40], k=rng.randint(0, 80))) for _ in range(60)]
    raw = [t and t.encode() for t in texts]
    alone = [next(J.shingle_sets([t])) for t in raw]
    assert [x.tolist() for x in J.shingle_sets(raw)] == [x.tolist() for x in alone]
    assert [len(x) for x in alone] == [len(set_of(t)) for t in texts]
    seen = {}
    for t, x in zip(texts, alone):
        w = words_of(t)
        for k in range(max(0, len(w) - 4)):
            seen.setdefault(tuple(w[k:k + 5]), None)
    assert len(np.unique(np.concatenate([x for x, t in zip(alone, texts) if len(words_of(t)) >= 5]))) == len(seen)


def test_long_texts_in_stretches(monkeypatch):
    text = " ".join(f"w{k % 977} v{k % 31}" for k in range(3000)).encode()
    whole = next(J.shingle_sets([text]))
    monkeypatch.setattr(J, "GROUP_BYTES", 100)
    assert next(J.shingle_sets([text])).tolist() == whole.tolist()


def test_components_of_chains_and_stars(spark):
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(0, 200)] + [(500, k) for k in range(501, 560)] + [(700, 701), (701, 700), (9, 9)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    for limit in (C.TASK_EDGES, 0):  # in one task, and by stars
        got = {r["node"]: r["comp"] for r in C.components(df, limit).collect()}
        assert got == {**{k: 0 for k in range(201)}, **{k: 500 for k in range(500, 560)}, 700: 700, 701: 700}
    assert C.components(df.limit(0)).count() == 0
