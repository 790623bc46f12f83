"""Transducers against sorted lists, the audit against plain Python and its SQL."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import divergence as D
from courtside.llm.queries import ORACLE_SQL, op13_divergence
from courtside.llm.transducer import Transducer, build, join
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOC_SCHEMA, with_clashes
from tests.oracle_harness import compare

_words = st.lists(st.binary(min_size=1, max_size=6).map(lambda b: bytes(97 + x % 3 if x < 250 else x for x in b)), max_size=40)


def look_up(t, tokens, start=None):
    data = np.frombuffer(b"".join(tokens), np.uint8)
    last = np.cumsum([len(x) for x in tokens], dtype=np.int64)
    return t.ordinals(data, last - [len(x) for x in tokens], last, start).tolist()


@settings(max_examples=150, deadline=None)
@given(_words, _words)
def test_ordinals_are_places_in_the_sorted_list(terms, others):
    terms = sorted(set(terms))
    t = Transducer.from_bytes(build(terms).to_bytes())
    assert t.terms == len(terms) and [t.term(k) for k in range(len(terms))] == terms
    tokens = terms + others
    if tokens:
        assert look_up(t, tokens) == [terms.index(x) if x in terms else -1 for x in tokens]


@settings(max_examples=100, deadline=None)
@given(_words)
def test_automaton_is_minimal(terms):
    """As many states as there are different sets of endings."""
    terms = sorted(set(terms))
    endings = defaultdict(set)
    for x in terms:
        for k in range(len(x) + 1):
            endings[x[:k]].add(x[k:])
    assert len(build(terms).final) == max(1, len({frozenset(e) for e in endings.values()}))


def test_terms_must_ascend():
    for bad in ([b"b", b"a"], [b"a", b"a"], [b""]):
        with pytest.raises(ValueError):
            build(bad)


def test_joined_transducers():
    lists = [[b"a", b"ab"], [b"b"], [b"ab", b"b", b"c"]]
    whole, start = join([build(x) for x in lists])
    for k, terms in enumerate(lists):
        assert look_up(whole, [b"a", b"ab", b"b", b"c", b"d"], np.full(5, start[k])) == [terms.index(x) if x in terms else -1 for x in (b"a", b"ab", b"b", b"c", b"d")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=14).map(str.encode), min_size=1, max_size=60), st.lists(st.text("abc", min_size=1, max_size=14).map(str.encode), max_size=20), st.integers(1, 7))
def test_shards_are_found_by_first_bytes(terms, others, per_shard):
    terms = sorted(set(terms))
    shards = [("x", k, terms[k], build(terms[k:k + per_shard]).to_bytes()) for k in range(0, len(terms), per_shard)]
    random.Random(1).shuffle(shards)
    tokens = terms + others
    data = np.frombuffer(b" ".join(tokens) + b" " * 9, np.uint8)
    last = np.cumsum([len(x) + 1 for x in tokens]) - 1
    first = last - [len(x) for x in tokens]
    found = D.Lookup(shards).ordinals(data, first, last, ["x", "y"], np.zeros(len(tokens), np.int64))
    assert found.tolist() == [terms.index(x) if x in terms else -1 for x in tokens]
    assert set(D.Lookup(shards).ordinals(data, first, last, ["x", "y"], np.ones(len(tokens), np.int64)).tolist()) == {-1}


def test_shares_are_exact():
    for total, terms in ((0, 1), (5, 3), (10**12, 10**7), (9 * 10**15, 1)):
        counts = [0, total // 3, total]
        assert D.shares(np.array(counts, np.int64), total, terms).tolist() == [1 + 10**9 * (c + 2) // (total + 2 * terms) for c in counts]


def test_pieces_end_between_terms():
    text = "Aé bb  ccc.D".encode() * 7
    for size in (1, 2, 5, 100):
        own = list(D.pieces(text, size))
        assert b"".join(own) == text.lower() and [t for p in own for t in D._TERM.findall(p)] == D._TERM.findall(text.lower())
    assert list(D.pieces(b"", 5)) == [] and list(D.pieces(b"abc" * 9, 4)) == [b"abc" * 9]


def plain(rows, keep=10, top=10):
    """The contract's rows, word by word."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for x in docs if x[0] == lang for t in set(x[2]))
        kept = sorted((t for t in df if df[t] >= keep), key=str.encode)
        counts = {s: Counter() for x, s, _ in docs if x == lang}
        for x, s, w in docs:
            if x == lang:
                counts[s].update(w)

        def p(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (n + 2 * len(kept)) for t in kept}

        whole = p(sum(counts.values(), Counter()))
        shares = {s: p(c) for s, c in counts.items()}

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s, own in shares.items():
            pairs = [(sum(f(own[t], q[t]) for t in kept), o) for o, q in shares.items() if o != s]
            terms = [(f(own[t], whole[t]), t) for t in kept if counts[s][t] and own[t] > whole[t]]
            for part, found, last in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:last])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(k, *r, 0) for k, r in enumerate(rows)], DOC_SCHEMA)


def some(n, seed, langs=("en", "de", None), sources=("a", "b", "c", None, "é", "")):
    r = random.Random(seed)
    words = ["the", "The", "of", "Éa", "éa", "x1y", "and", "zebra", "zeb", "z", "naïve", "it's", "a" * 40, "日本", "日本語"] + [f"w{''.join(r.choices('abc', k=5))}" for _ in range(60)]
    return [(" ".join(r.choices(words, k=r.randint(0, 60))), r.choice(langs), r.choice(sources)) for _ in range(n)]


ROWS = some(150, 1) + [(None, "en", "silent"), ("", "xx", "a"), ("12 34", "xx", "b"), ("!", "xx", None), ("lonely", "one", "s")] + [("twice the same text", "en", "a")] * 12


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 30, "pass_bytes": 1, "block": 7, "tile": 1}, {"shard_bytes": 100, "block": 3, "tile": 2, "keep_docs": 2, "top": 3}])
def test_audit_equals_plain(spark, sizes):
    df = with_clashes(frame(spark, ROWS).repartition(4), "term", "item", "value", "rank", "block", "whole", "part", "shard")
    got = sorted(tuple(r) for r in D.audit(df, **sizes).collect())
    assert got == plain(ROWS, sizes.get("keep_docs", 10), sizes.get("top", 10))


def test_small_tables_of_a_task(spark, monkeypatch):
    """Tasks that pass on what they hold after every batch give the same rows."""
    monkeypatch.setattr(D, "HELD", 0)
    monkeypatch.setattr(D, "PIECE", 50)
    rows = some(60, 2)
    assert sorted(tuple(r) for r in D.audit(frame(spark, rows), keep_docs=2).collect()) == plain(rows, 2)


def test_no_rows_and_no_kept_terms(spark):
    assert D.audit(frame(spark, [])).collect() == []
    rows = [("one text", "en", "a"), (None, None, None), ("two", "en", "b")]
    assert sorted(tuple(r) for r in D.audit(frame(spark, rows)).collect()) == plain(rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_query_equals_sql(spark):
    assert compare(spark, "op13_divergence", op13_divergence, ORACLE_SQL["op13_divergence"], SF_SMALL)["status"] == "match"
