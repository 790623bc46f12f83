"""Fingerprints against a direct version, piece by piece; neighbours and edits against plain Python."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import improbable as I
from courtside.llm.queries import op11_improbable
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, with_clashes

RANK = I.ranks_of(np.array([(k * 7919) % 1000 for k in range(I.SCORES)]))


def plain_score(window: bytes) -> float:
    n = len(window)
    return 1000 * -sum(c / n * math.log2(c / n) for c in Counter(window).values()) / math.log2(n)


def plain_features(text: bytes, rank) -> list[bytes]:
    """Selected windows in order, the first of equal ones only."""
    if len(text) < I.WINDOW:
        return [text] if text else []
    ranks = [rank[s] for s in I.entropy_scores(np.frombuffer(text, np.uint8)).tolist()]
    votes = Counter()
    for first in range(1 - I.NEIGHBOURS, len(ranks)):
        near = range(max(0, first), min(len(ranks), first + I.NEIGHBOURS))
        votes[min(near, key=lambda k: (ranks[k], k))] += 1
    return list(dict.fromkeys(text[k:k + I.WINDOW] for k in sorted(votes) if votes[k] >= I.VOTES))


def plain_fingerprint(text: bytes, rank) -> str:
    features = plain_features(text, rank)
    out = b""
    for k in range(0, len(features), I.CAPACITY):
        bits = np.zeros(I.FILTER_BITS, np.uint8)
        for f in features[k:k + I.CAPACITY]:
            h = int(I._feature_hashes(np.frombuffer(f.ljust(I.WINDOW, b"\0"), np.uint8), np.array([0]), np.array([len(f)]))[0])
            for j in range(I.FILTER_HASHES):
                bits[h >> (11 * j) & 2047] = 1
        out += np.packbits(bits).tobytes()
    return f"{len(features)}:{base64.b64encode(out).decode()}"


def words(n, seed, size=500):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("etaoinshrdlu", k=r.randint(2, 9))) for _ in range(size)]
    return " ".join(r.choices(vocabulary, k=n))


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=I.WINDOW, max_size=120))
def test_scores_are_entropies(data):
    got = I.entropy_scores(np.frombuffer(data, np.uint8))
    want = [plain_score(data[k:k + I.WINDOW]) for k in range(len(data) - I.WINDOW + 1)]
    assert len(got) == len(want) and all(w - 1.001 <= g <= w + 0.001 for g, w in zip(got.tolist(), want))


TEXTS = [b"", b"a", b"short", b"x" * 15, b"x" * 16, b"x" * 400, b"ab" * 300, words(30, 1).encode(), words(900, 2).encode(), words(9000, 3).encode(), "é ü 😀 ".encode() * 40, bytes(range(256)) * 3]


@pytest.mark.parametrize("piece, group", [(I.PIECE, I.GROUP_BYTES), (50, 1), (1000, 3000)])
def test_equals_direct_version(monkeypatch, piece, group):
    monkeypatch.setattr(I, "PIECE", piece)
    monkeypatch.setattr(I, "GROUP_BYTES", group)
    assert I.fingerprints([*TEXTS, None], RANK) == [*(plain_fingerprint(t, RANK) for t in TEXTS), "0:"]
    counts = I.count_scores(TEXTS)
    assert counts.sum() == sum(max(0, len(t) - I.WINDOW + 1) for t in TEXTS)
    assert counts.tolist() == np.bincount(np.concatenate([I.entropy_scores(np.frombuffer(t, np.uint8)) for t in TEXTS if len(t) >= I.WINDOW]), minlength=I.SCORES).tolist()


def test_ranks_rare_first_and_low_scores_last():
    counts = np.ones(I.SCORES, np.int64) * 5
    counts[700], counts[800], counts[50] = 1, 90, 0
    rank = I.ranks_of(counts)
    assert rank[700] == 0 and rank[800] == I.SCORES - I.LEAST_SCORE - 1 and rank[50] == I.SCORES - I.LEAST_SCORE
    assert sorted(rank.tolist()) == list(range(I.SCORES))


def test_likeness():
    a, b, c = (words(2000, k).encode() for k in (1, 2, 3))
    fa, fb, half, inside = I.fingerprints([a, b, a[:len(a) // 2] + c[len(c) // 2:], a[5000:6500]], RANK)
    assert I.likeness(fa, fa) == 1.0 and I.likeness(fa, fb) < 0.03
    assert 0.4 < I.likeness(fa, half) < 0.65 and I.likeness(fa, half) == I.likeness(half, fa)
    assert I.likeness(inside, fa) > 0.5 and I.likeness(inside, fb) < 0.1
    assert I.likeness("0:", "0:") == 1.0 and I.likeness("0:", fa) == 0.0 == I.likeness(fa, "0:")


def plain_rows(rows):
    """(doc_id, n_chars, edited text, next text) by falling doc_id, null last, equal ids by text."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [t or "" for _, t in rows]
    for k, (i, _) in enumerate(rows):
        t, f = texts[k], texts[(k + 1) % len(rows)]
        yield i, len(t), t[:len(t) - len(t) // 2] + f[:len(t) // 2], t, f


def check(df, rows, rank):
    got = sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_chars, r.edited_sha256))
    want = sorted(((i, n, hashlib.sha256(e.encode()).hexdigest(), *I.fingerprints([t.encode(), e.encode(), f.encode()], rank)) for i, n, e, t, f in plain_rows(rows)),
                  key=lambda r: (r[0] is None, r[0] or 0, *r[1:3]))
    assert [tuple(r[:5]) for r in got] == [w[:5] for w in want]
    assert [(r.near_edited, r.near_next) for r in got] == [(I.likeness(w[3], w[4]), I.likeness(w[3], w[5])) for w in want]


ROWS = [(k * 3, words(k % 50 * 7, k) + "é") for k in range(90)] + [(None, "no id"), (None, None), (7, None), (8, ""), (30, "again"), (30, "again"), (-5, "minus 😀 five"), (1000, words(5000, 9))]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_next_documents_and_edits(spark, parts):
    df = with_clashes(documents(spark, ROWS).repartition(5), "k", "p", "tail", "to", "fingerprint", "score")
    check(I.compare_with_next(df, RANK, parts), ROWS, RANK)


@pytest.mark.parametrize("rows", [[], [(5, "only one text, its own next one")], [(1, None), (2, None)], [(None, "a"), (None, "b")], [(4, "same")] * 3])
def test_few_rows(spark, rows):
    df = documents(spark, rows)
    check(I.compare_with_next(df, parts=4), rows, I.score_ranks(df))


def test_equal_texts_have_equal_fingerprints(spark):
    got = I.fingerprint_documents(documents(spark, [words(60, 1), words(60, 2), words(60, 1), None, ""])).orderBy("doc_id").collect()
    assert got[0].fingerprint == got[2].fingerprint != got[1].fingerprint and got[3].fingerprint == got[4].fingerprint == "0:"


def test_query_over_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check(op11_improbable(spark, SF_SMALL), [(r.doc_id, r.text) for r in docs.collect()], I.score_ranks(docs))
