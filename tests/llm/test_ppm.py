"""PPM against a direct implementation of its rules, broadcast and joined; the word model against plain counts."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from urllib.parse import urlparse

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import ppm as P
from tests.llm.helpers import documents, with_clashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def stream(text):
    w = words(text)
    return ("".join(x + " " for x in w) + "\n").encode()


class Plain:
    """Contexts in dictionaries, symbols one at a time."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for t in texts:
            s = b"\n" * order + stream(t)
            for k in range(order, len(s)):
                for o in range(order + 1):
                    self.seen[s[k - o:k]][s[k]] += 1

    def log10(self, text):
        s, out = b"\n" * self.order + stream(text), 0.0
        for k in range(self.order, len(s)):
            gone = set()
            for o in range(self.order, -1, -1):
                own = self.seen.get(s[k - o:k])
                if own is None:
                    continue
                left = {c: n for c, n in own.items() if c not in gone}
                if s[k] in left:
                    out += math.log10(left[s[k]] / (sum(left.values()) + len(left)))
                    break
                if left:
                    out += math.log10(len(left) / (sum(left.values()) + len(left)))
                gone |= set(own)
            else:
                out -= math.log10(256 - len(gone))
        return out


def trie(texts, order):
    held = Counter()
    for t in texts:
        for p in P.segments(stream(t), order, 5):
            held.update(P.grams([p], order)[0].tolist())
    return P.Trie(np.array(list(held), np.uint64), np.array(list(held.values()), np.int64), order)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab C\n", max_size=25), max_size=4), st.text(alphabet="abcdé \n", max_size=30), st.integers(1, 4))
def test_probabilities(train, text, order):
    model, plain = trie(train, order), Plain(train, order)
    code, start = P.grams(list(P.segments(stream(text), order, 7)), order)
    assert model.log10(code).sum() == pytest.approx(plain.log10(text), abs=1e-9)
    assert model.escaped(code).sum() == pytest.approx(plain.log10(text), abs=1e-9)


def test_probabilities_of_all_bytes_sum_to_one():
    model = trie(["the cat sat on the mat", "the dog"], 3)
    for ctx in (b"the", b"xyz", b"at ", b"\n\n\n"):
        base = int.from_bytes(ctx, "big") << 8
        assert (10 ** model.log10(np.arange(base, base + 256, dtype=np.uint64))).sum() == pytest.approx(1)


def corpus():
    rng = random.Random(6)
    vocab = ["".join(rng.choices("abcdef", k=rng.randint(1, 7))) for _ in range(60)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(1, 60))) for _ in range(80)]
    return [None, "", " \n", "Word", "ÉCOLE école", "x" * 500, "only here once", texts[0], texts[0]] + texts


@pytest.mark.parametrize("options", [{}, {"model_grams": 0, "common_share": 0.02, "order": 3}, {"common_share": 1.0, "order": 2}])
def test_scores(spark, monkeypatch, options):
    monkeypatch.setattr(P, "SEGMENT", 64)
    texts = corpus()
    df = with_clashes(documents(spark, texts), "row", "key", "rare", "score", "n")
    got = {r["doc_id"]: r for r in P.score_documents(df, **options).collect()}
    assert len(got) == len(texts)
    out = [zlib.crc32(str(k).encode()) % 7 == 2 for k in range(len(texts))]
    train = [t for t, o in zip(texts, out) if not o]
    plain = Plain(train, options.get("order", P.ORDER))
    c = Counter(w for t in train for w in words(t))
    c["\n"] = len(train)
    n, v = sum(c.values()), len(c)
    for k, t in enumerate(texts):
        own = [*words(t), "\n"]
        r = got[k]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[k], len(own), sum(c[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own))
        assert r["score"] == pytest.approx(plain.log10(t))


@pytest.mark.parametrize("model_grams", [40, 400])
def test_scores_with_the_frequent_strings_broadcast(spark, monkeypatch, model_grams):
    for name, size in (("SEGMENT", 64), ("CHUNK", 100), ("BUCKET", 150)):
        monkeypatch.setattr(P, name, size)
    texts = [*corpus(), "held out: never seen 0123456789 \x7f" * 3] * 2
    got = {r["doc_id"]: r["score"] for r in P.score_documents(documents(spark, texts), model_grams=model_grams).collect()}
    plain = Plain([t for k, t in enumerate(texts) if zlib.crc32(str(k).encode()) % 7 != 2], P.ORDER)
    assert got == {k: pytest.approx(plain.log10(t)) for k, t in enumerate(texts)}


def test_frequent_strings_are_the_most_frequent_at_most_so_many(spark):
    n = [1, 1, 1, 2, 2, 3, 50, 1000, 1 << 40]
    table = spark.createDataFrame(list(enumerate(n)), "key long, n long")
    for most, least in ((9, 0), (8, 1), (6, 1), (5, 2), (4, 2), (0, 1 << 40), (-1, 1 << 40)):
        often, others, occurrences = P.frequent(table, most)
        rest = [x for x in n if x <= least]
        assert sorted(r["n"] for r in table.filter(~often).collect()) == rest
        assert (others, occurrences) == (len(rest), sum(rest))


def test_scratch_tables_stay_below_the_texts(spark, monkeypatch):
    """With one string too many for the broadcast table, not every string of every document goes to disk."""
    rng = random.Random(9)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(1500)]
    texts = [" ".join(rng.choices(vocab, k=150)) for _ in range(1500)]
    df = documents(spark, texts)
    n_grams = P.count_corpus(df).filter("kind = 0").count()
    paths = []

    def kept(df, name):
        out = materialize(df, name)
        paths.extend(urlparse(f).path for f in out.inputFiles())
        return out

    materialize = P.materialize
    monkeypatch.setattr(P, "materialize", kept)
    P.score_documents(df, model_grams=n_grams - 1).write.format("noop").mode("overwrite").save()
    size = defaultdict(int)
    for p in paths:
        size[p.rsplit("/", 2)[-2].rpartition("-")[0]] += os.path.getsize(p)
    assert size["document-rows"] < 0.5 * sum(map(len, texts)), dict(size)


def test_held_out_text_is_likelier_than_noise(spark):
    rng = random.Random(8)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    texts = [" ".join(rng.choices(vocab, k=50)) for _ in range(300)] + ["".join(rng.choices("abcdefgh ", k=250)) for _ in range(30)]
    rows = P.score_documents(documents(spark, texts)).filter("held_out").collect()
    bits = {kind: np.mean([r["score"] / len(stream(texts[r["doc_id"]])) for r in rows if (r["doc_id"] < 300) == kind]) for kind in (True, False)}
    assert bits[True] > bits[False] + 0.1
    good = [r for r in rows if r["doc_id"] < 300]
    assert len(good) > 20


def test_empty_tables(spark):
    df = documents(spark, ["a b", "c"])
    assert P.score_documents(df.limit(0)).count() == 0
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    for options in ({}, {"model_grams": -1}):
        rows = P.score_documents(documents(spark, [(k, "a b") for k in held]), **options).collect()
        assert all(r["held_out"] and r["train_tokens"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in rows)
        assert all(r["score"] == pytest.approx(-math.log10(256) * len(b"a b \n")) for r in rows)
