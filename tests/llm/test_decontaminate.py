"""Wu-Manber search against brute force, on its own and as a Spark operator."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import decontaminate as D
from tests.llm.helpers import documents, with_clashes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(words, items, window=D.WINDOW):
    hit, found = set(), set()
    for item, own in items:
        m = min(window, len(own))
        grams = {tuple(own[k:k + m]) for k in range(len(own) - m + 1)} if m else set()
        for k in range(len(words) - m + 1 if m else 0):
            if tuple(words[k:k + m]) in grams:
                hit.update(range(k, k + m))
                found.add(item)
    return len(hit), sorted(found)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=9), max_size=4), st.lists(st.sampled_from("abc"), max_size=60), st.integers(1, 5))
def test_search_equals_brute_force(items, words, window):
    items = [(str(k), [w.encode() for w in own]) for k, own in enumerate(items)]
    words = [w.encode() for w in words]
    spans, found = D.WuManber(items, window).search(words)
    t = D.WuManber(items, window)
    assert (len({p for s, e in spans for p in range(s, e)}), sorted(t.ids[k] for k in found)) == brute(words, items, window)


@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=80))
def test_words_follow_the_pattern(text):
    assert [w.decode() for w in D.words_of(text.encode())] == plain_words(text)


def fixture(spark):
    rng = random.Random(3)
    vocab = [f"w{k}" for k in range(40)] + ["Ünï", "Çe"]
    items = [(f"it{k}", " ".join(rng.choices(vocab, k=rng.choice([1, 5, 12, 13, 14, 40])))) for k in range(30)]
    items += [("it0", items[0][1]), (None, "null item words that are thirteen and more of them in one long row here"), ("nul", None), ("emp", "")]
    docs = [" ".join(rng.choices(vocab, k=rng.randint(0, 90))) for _ in range(40)]
    for k in range(30):
        docs.append(f"{docs[k]} {items[k][1].upper()}, {docs[k + 1]}")
    docs += [None, "", "   ", items[5][1] * 1, docs[7], docs[7], "Null item words that are thirteen and more of them in one long row here!"]
    return docs, items, spark.createDataFrame(items, "item_id string, text string")


def test_operator_equals_brute_force_in_one_and_many_blocks(spark):
    docs, items, bench = fixture(spark)
    words = [(i or "", plain_words(t)) for i, t in items]
    want = []
    for k, t in enumerate(docs):
        own = plain_words(t)
        n_hit, found = brute(own, words)
        want.append((k, len(own), n_hit, sorted(set(found)), n_hit > 0 and 20 * n_hit >= len(own)))
    df = documents(spark, docs)
    for options in ({}, {"block_bytes": 300, "blocks_per_pass": 3}):
        got = D.find_hits(with_clashes(df, "n_hit", "item_ids", "start"), bench, **options)
        assert set(df.columns) <= set(got.columns)
        rows = sorted((r["doc_id"], r["n_words"], r["n_hit"], list(r["item_ids"]), r["contaminated"]) for r in got.collect())
        assert rows == want


def test_filter_keeps_the_columns_and_clean_rows(spark):
    docs, _, bench = fixture(spark)
    df = with_clashes(documents(spark, docs), "n_words", "contaminated", "_1")
    kept = D.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    judged = {r["doc_id"]: r["contaminated"] for r in D.find_hits(documents(spark, docs), bench).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, c in judged.items() if not c)


def test_empty_tables(spark):
    docs, _, bench = fixture(spark)
    df = documents(spark, docs)
    assert D.find_hits(df.limit(0), bench).count() == 0
    assert D.find_hits(df, bench.limit(0)).filter("n_hit > 0 or contaminated").count() == 0
