"""Cached chunk encoding, Re-Pair shards and packing: exact against the tokenizers library, and round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import packing as K
from courtside.llm import repair as R
from courtside.llm.common import scratch_path
from courtside.llm.tokens import Encoder, encoder
from tests.llm.helpers import documents, with_clashes

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["J̌x. Áb, c.", "x <|endoftext|>y<|startoftext|> <|ENDOFTEXT|>", "İ X. ǅ ﬁ", "a...b.,c. d's. D'S 'Tis x\x0by z\x1cq\x85r", "0123456789 x0 1.5 90125",
       "ΑΣ Σ. ΣΑΣ", "́a é", "x.\ny,\tz.\r", "😀. é. ü,", " wide space", "", "   ", "word " * 50]


def library(text):
    return encoder(PATH).tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(["a", "J", "̌", "́", ".", ",", "'s", "'S", " ", "\n", "0", "1", "é", "<|endoftext|>", "Σ", "…"]), max_size=30).map("".join)))
def test_chunks_equal_whole_texts(text):
    try:
        raw = text.encode()
    except UnicodeEncodeError:
        return
    assert np.frombuffer(encoder(PATH).encode([raw])[0], "<u4").tolist() == library(text)


def test_odd_texts_and_small_cache(monkeypatch):
    import courtside.llm.tokens as tokens
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 5)
    monkeypatch.setattr(tokens, "GROUP_BYTES", 30)
    own = Encoder(PATH)
    assert own.by_chunk
    got = own.encode([None] + [t.encode() for t in ODD * 2])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [[]] + [library(t) for t in ODD * 2]


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Encoder(path)
    assert not own.by_chunk
    assert np.frombuffer(own.encode([b" two  words\n"])[0], "<u4").tolist() == own.tokenizer.encode(" two  words\n", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=40), min_size=1, max_size=12), st.sampled_from([3, 70_000]))
def test_repair_round_trip(docs, scale):
    raw = [(np.array(d) * scale).astype("<u4").tobytes() for d in docs]
    shard = R.Shard(R.write_payload(raw, rounds=6, round_pairs=3, min_count=2))
    assert shard.all_ids().astype("<u4").tobytes() == b"".join(raw)
    for k, d in enumerate(docs):
        assert shard.document(k).tolist() == [x * scale for x in d]
        assert shard.ids(k, len(d) // 3, len(d)).tolist() == [x * scale for x in d][len(d) // 3:]


def test_repair_shrinks_repeats_and_replaces_the_most_frequent_pair():
    ids = np.array([1, 2, 1, 2, 1, 2, 3, 1, 1, 1, 1], "<u4")
    base, rules, seq, _ = R.compress(ids, np.array([len(ids)]), rounds=1, round_pairs=1, min_count=2)
    assert rules.tolist() == [[1, 1]] or rules.tolist() == [[1, 2]]
    big = np.tile(np.arange(50, dtype="<u4"), 2000)
    payload = R.write_payload([big.tobytes()], rounds=8, min_count=2)
    assert len(payload) < big.nbytes / 20 and (R.Shard(payload).all_ids() == big).all()


def texts(n=150):
    rng = random.Random(2)
    vocab = ["alpha", "Beta,", "gamma.", "délta", "42", "x" * 30]
    return [None, "", " "] + ODD + [" ".join(rng.choices(vocab, k=rng.randint(0, 300))) for _ in range(n)] + ["long text, " * 9000]


def test_shards_against_plain_encoding(spark):
    pairs = [(1000 - 7 * k, t) for k, t in enumerate(texts())]
    pairs += [pairs[20], pairs[21], (pairs[5][0], "twice the id"), (None, "no id")]
    df = with_clashes(documents(spark, pairs), "part", "shard", "payload")
    path = scratch_path(spark, "test-shards")
    R.write_shards(df.repartition(5), path, PATH, end_id=1, shard_ids=2000, min_count=3)
    got = R.read_documents(spark, path).collect()
    want, at = [], 0
    for i, t in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, (p[1] or "").encode())):
        ids = library(t or "") + [1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=lambda r: r[1]) == want
    assert R.read_shards(spark, path).count() > 5
    assert R.encode_and_read_back(df.limit(0), PATH).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_windows_hold_each_item_once_within_capacity(sizes):
    windows = K.pack(sizes, 64)
    assert sorted(n for w in windows for n in w) == list(range(len(sizes)))
    assert all(sum(sizes[n] for n in w) <= 64 for w in windows)


def test_differencing_is_the_largest_differencing_method():
    # the classic example: 8, 7, 6, 5, 4 into two gives 16 and 14
    windows = K.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][n] for n in w) for w in windows) == [14, 16]
    rng = random.Random(1)
    sizes = [rng.randint(1, 1000) for _ in range(900)]
    sums = [sum(sizes[n] for n in w) for w in K.differencing(sizes, 60)]
    assert len(sums) == 60 and max(sums) - min(sums) < 60


@given(st.integers(0, 20_000))
def test_cuts_cover_a_document(n):
    own = K.cuts(n)
    assert [s for s, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))] and sum(x for _, x in own) == n
    assert all(x == K.CAPACITY or 0 < x <= K.PIECE for _, x in own)


def test_packed_pieces(spark):
    pairs = list(enumerate(texts())) + [(3, "again"), (9, ODD[2]), (9, ODD[2]), (None, "no id")]
    df = with_clashes(documents(spark, pairs), "start", "group", "offset", "ids")
    rows = K.pack_documents(df, PATH, end_id=2, group_windows=4, with_ids=True).collect()
    windows = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in windows.values():
        own.sort()
        assert [o for o, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))] and sum(x for _, x in own) <= K.CAPACITY
    total = sum(r["length"] for r in rows)
    assert total == sum(len(library(t or "")) + 1 for _, t in pairs)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(str(r["doc_id"]), []).append((r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]))
    for i, t in pairs:
        if sum(j == i for j, _ in pairs) == 1:
            own = sorted(by_doc[str(i)])
            ids = library(t or "") + [2]
            assert b"".join(x[2] for x in own) == np.array(ids, "<u4").tobytes() and all(x[3] == len(ids) for x in own)
    assert K.pack_documents(df.limit(0), PATH).count() == 0


def test_little_padding(spark):
    rng = random.Random(4)
    df = documents(spark, [" ".join(rng.choices(["one", "two", "three"], k=int(rng.lognormvariate(5.5, 1)))) for _ in range(4000)])
    rows = K.pack_documents(df, PATH).groupBy("sequence_id").sum("length").collect()
    assert sum(r[1] for r in rows) / (len(rows) * K.CAPACITY) > 0.985


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097])
def test_cut_edges(n):
    assert sum(x for _, x in K.cuts(n)) == n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "é", "İ", "ŉ", "×", "÷", "ß", "à", "í", "ż", "Ž", "'", "’", ".", "***", "re", "s", "1", "=", "<", "\x7f", " ", "ñ", "\u0338", "ё"]), max_size=25).map("".join))
def test_runs_of_letters_and_signs_equal_whole_texts(text):
    assert np.frombuffer(encoder(PATH).encode([text.encode()])[0], "<u4").tolist() == library(text)


def test_words_with_signs_are_learned_once():
    own = Encoder(PATH)
    own.encode(["señor señor. señor,,, ¿señor? (señor) señor's".encode()])
    known = len(own.keys)
    own.encode(["(señor señor. señor,,, (señor,,, 's".encode()])
    assert len(own.keys) == known
