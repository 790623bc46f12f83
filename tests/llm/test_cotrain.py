"""Co-training: held-out accuracy with few labels, the fitted pieces, and awkward rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from courtside.llm import cotrain as C
from tests.llm.helpers import documents, with_clashes

TOXIC = ["vilea", "vileb", "vilec", "viled"]


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(500)]
    rows, marks = [], []
    for k in range(n):
        words = rng.choices(vocab, k=rng.randint(20, 120))
        bad, toxic = rng.random() < 0.25, rng.random() < 0.2
        if bad:
            words = [w + rng.choice(["***", "%%%"]) for w in words]
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(TOXIC)
        rows.append((k, " ".join(words), "en", "junk" if bad and rng.random() < 0.8 else f"src{rng.randint(0, 4)}", 1))
        marks.append((k, 0 if bad else 1, int(toxic)))
    return rows, marks


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_held_out_accuracy(spark):
    rows, marks = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([m for m in marks if m[0] % 3 == 0], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in C.classify(with_clashes(df, "quality_score", "kept", "features", "row"), labels).collect()}
    assert len(got) == len(rows)
    held_out = [m for m in marks if m[0] % 3]
    assert np.mean([got[k]["toxic"] == bool(t) for k, _, t in held_out]) > 0.96  # 300 labels, each mark in a dozen of them
    assert np.mean([got[k]["kept"] == (q == 1 and t == 0) for k, q, t in held_out]) > 0.96
    assert np.mean([got[k]["kept"] for k, q, t in held_out if q == 1 and t == 0]) > 0.98
    for c in C.SCORES:
        assert all(0 <= r[c] <= 1 for r in got.values())
    # calibrated: the mean score is near the share of good rows
    assert np.mean([got[k]["quality_score"] for k, _, _ in held_out]) == pytest.approx(np.mean([q for _, q, _ in held_out]), abs=0.05)


def test_views_teach_each_other_what_the_sample_lacks(spark):
    """Marks that no labelled row has are learned from rows that the metadata view is sure of."""
    rows, marks = corpus(1500, 11)
    late = {k for k, q, _ in marks if q == 0 and k % 5}
    rows = [(k, t + " ^^^" if k in late else t, lang, "junk" if q == 0 else s, n) for (k, t, lang, s, n), (_, q, _) in zip(rows, marks)]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([m for m in marks if m[0] % 5 == 0], "doc_id long, quality int, toxic int")
    assert C.fit(df, labels, rounds=0).views["quality", "text"].weights.get(b"\0^^^", 0) == 0
    assert C.fit(df, labels).views["quality", "text"].weights.get(b"\0^^^", 0) < 0


def test_awkward_rows(spark):
    df = documents(spark, [None, "", "a", (7, "same"), (7, "same"), (None, "no id"), "long " * 50_000])
    labels = spark.createDataFrame([(0, None, None), (None, 1, 1), (7, 1, 0), (7, 1, 0), (99, 0, 0)], "doc_id long, quality int, toxic int")
    rows = C.classify(df, labels).collect()
    assert len(rows) == 7 and all(r["kept"] and not r["toxic"] for r in rows)
    none = labels.limit(0)
    assert C.classify(df, none).filter("kept").count() == 7
    assert C.classify(df.limit(0), labels).count() == 0
    assert C.classify(df.select("doc_id", "text"), none).count() == 7


def test_association_and_regression(spark):
    df = spark.createDataFrame([(10, 5), (50, 50), (50, 0), (30, 30)], "n1 long, p1 long")
    g = [r[0] for r in df.select(C.association("n1", "p1", 1000, 500)).collect()]
    assert g[0] == 0 and g[1] == pytest.approx(2 * (50 * np.log(2) + 450 * np.log(450 / 475) + 500 * np.log(500 / 475))) and g[2] == pytest.approx(g[1]) and g[3] >= C.Z_LEAST ** 2
    rng = np.random.default_rng(0)
    rows = [np.flatnonzero(rng.random(4) < 0.5) for _ in range(2000)]
    z = np.array([1.5 * (0 in r) - 2.0 * (1 in r) + 0.3 for r in rows])
    y = (rng.random(2000) < 1 / (1 + np.exp(-z))).astype(float)
    w, c = C.sparse_logistic(rows, y, 4)
    assert w[0] == pytest.approx(1.5, abs=0.4) and w[1] == pytest.approx(-2.0, abs=0.4) and abs(w[2]) < 0.3 and c == pytest.approx(0.3, abs=0.3)
    b = C.logistic(z, y)
    assert b[0] == pytest.approx(1.0, abs=0.2)
    assert C.logistic(z[:50], y[:50], np.full(50, 3.0)) == pytest.approx(C.logistic(np.tile(z[:50], 3), np.tile(y[:50], 3)))
    assert C.sparse_logistic([np.array([0])] * 4, np.ones(4), 2, np.array([0.0, 2.5]))[0][1] == pytest.approx(2.5)


def test_threshold_rejects_few_good_rows():
    score = np.array([-4, -3, -2, -1, 4, 5.0])
    good = np.array([False, False, True, False, True, True])
    assert -3 < C._threshold(score, good, 0.0) < -2
    assert C._threshold(score, good, 0.5) == 0
    assert C._threshold(score, np.ones(6, bool), 0.5) == -np.inf
    assert C._threshold(score, good, 0.0, np.array([9, 1, 5, 2, 1, 1.0])) == C._threshold(np.repeat(score, [9, 1, 5, 2, 1, 1]), np.repeat(good, [9, 1, 5, 2, 1, 1]), 0.0)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB7 \t\n.,*é%", max_size=40))
def test_marks_against_patterns(text):
    raw = text.encode()
    found = re.findall(rb"[!-/:-@\[-`{-~]{2,}|(?<!\S)[!-/:-@\[-`{-~](?!\S)", raw)
    want = {b"\0" + m[:8] for m in found} | set(C.words_of(raw)) if raw else {b"\0empty"}
    assert C.text_features(raw) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB7 \t\n.,*é%\x0b\x1c", max_size=40)), max_size=6), st.sampled_from([C.LONG_BYTES, 12]))
def test_parsed_batches_against_single_texts(texts, long_bytes):
    """Features of documents parsed together equal those of each text by itself, short or long."""
    raw = [x if x is None else x.encode() for x in texts]
    langs, sources = [None, "en"] * 3, ["s", None, "t"] * 2
    with pytest.MonkeyPatch.context() as m:
        m.setattr(C, "LONG_BYTES", long_bytes)
        docs = C.Parsed(raw, langs, sources)
    names = docs.names(np.arange(len(docs.keys)))
    assert len(set(names)) == len(names) and C.keys_of(names).tolist() == docs.keys.tolist() == sorted(docs.keys.tolist())
    found = [set() for _ in raw]
    for k, i in zip(docs.owner.tolist(), docs.number.tolist()):
        assert names[i] not in found[k]
        found[k].add(names[i])
    assert found == [C.text_features(x) for x in raw]
    assert docs.meta == [C.meta_features(x, s, t) for x, s, t in zip(langs, sources, raw)]
    some = names[::2]
    views = {(t, v): C.View(0.5, {f: 1.0 + k for k, f in enumerate(some)} if v == "text" and t == "toxic" else {b"lang=en": 2.0}) for t in C.TARGETS for v in C.VIEWS}
    z = C.Scorer(views).logits(docs)
    assert z["text"][:, 1].tolist() == pytest.approx([0.5 + sum(1.0 + some.index(f) for f in x if f in some) for x in found])
    assert z["meta"][:, 0].tolist() == [0.5 + 2 * (x == "en") for x, _ in zip(langs, raw)]


def plain_counts(rows, views, sample):
    """Counts of features beside the labels that the other view gives, row by row from the views' weights."""
    sure, found = math.log(C.CONFIDENT / (1 - C.CONFIDENT)), Counter()
    for k, text, lang, source, _ in rows:
        if k in sample:
            continue
        seen = {"text": C.text_features(text.encode()), "meta": C.meta_features(lang, source, text.encode())}
        z = {(t, v): x.slope * (x.prior + sum(x.weights.get(f, 0) for f in seen[v])) + x.offset for (t, v), x in views.items()}
        for pupil, teacher in (("text", "meta"), ("meta", "text")):
            code = 0
            for t, scale in (("quality", 3), ("toxic", 1)):
                own, other = z[t, teacher], z[t, pupil]
                if abs(own) >= sure and (own * other >= 0 or abs(own) > abs(other)):
                    code += scale * (2 if own > 0 else 1)
            if code:
                found.update((pupil, code, f) for f in [*seen[pupil], None])
    return found


def test_every_unlabelled_document_teaches(spark, monkeypatch):
    """Counts over all rows outside the sample equal a plain recount, also with few counts held at once."""
    monkeypatch.setattr(C, "HELD", 300)
    rows, marks = corpus(700, 5)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = spark.createDataFrame([m for m in marks if m[0] % 3 == 0], "doc_id long, quality int, toxic int")
    views, sample = C.learn(df, labels, rounds=0, labelled_rows=150)
    ids = {r[0] for r in sample.collect()}
    assert len(ids) == 150 and ids <= {m[0] for m in marks if m[0] % 3 == 0}
    got = Counter()
    for r in C.taught_counts(df, sample, views).collect():
        got[r["view"], r["labels"], None if r["f"] is None else bytes(r["f"])] += r["n"]
    want = plain_counts(rows, views, ids)
    assert got == want and sum(n for (v, _, f), n in want.items() if f is None and v == "text") > 100


def test_selection_keeps_the_strongest(spark):
    """Features, counts and the bound of the selection against a plain version."""
    rng = random.Random(2)
    rows = []
    for k in range(60):
        rows += [("text", 6, f"w{k}".encode(), rng.randint(0, 200)), ("text", 3, f"w{k}".encode(), rng.randint(0, 200))]
    rows += [("text", 6, None, 400), ("text", 3, None, 500)]
    df = spark.createDataFrame(rows, C.COUNTED)
    totals, chosen = C.selected(df)
    assert totals["quality", "text"] == (900, 400) and totals["toxic", "text"] == (0, 0)

    def g(n1, p1, n=900, p=400):
        cells = ((p1, n1 * p / n), (n1 - p1, n1 * (n - p) / n), (p - p1, p - n1 * p / n), (n - p - n1 + p1, (n - p) - n1 * (n - p) / n))
        return 2 * sum(o * math.log(o / e) for o, e in cells if o > 0 and e > 0)

    count = {}
    for _, code, f, n in rows[:-2]:
        a, b = count.get(f, (0, 0))
        count[f] = (a + n, b + n * (code == 6))
    strong = {f: c for f, c in count.items() if c[0] >= 5 and g(*c) >= C.Z_LEAST ** 2}
    assert chosen == {("quality", "text"): strong} and 5 < len(strong) < 60
    few = C.selected(df, terms=5)[1]["quality", "text"]
    assert 0 < len(few) <= 5 and min(g(*c) for c in few.values()) >= max(g(*c) for f, c in strong.items() if f not in few)


def test_calibration_takes_all_labelled_rows_that_were_not_fitted(spark):
    rows, marks = corpus(900, 7)
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    views, sample = C.learn(df, labels, rounds=1, labelled_rows=200)
    scores = C.view_scores(df, views)
    model = C.calibrate(views, scores, labels, sample)
    fitted = {r[0] for r in sample.filter(~C._kept_apart("doc_id")).collect()}
    assert 100 < len(fitted) < 200
    z = {r["doc_id"]: r for r in scores.collect()}
    for t, at in (("quality", 1), ("toxic", 2)):
        used = [m for m in marks if m[0] not in fitted]
        x = np.round(np.array([[z[m[0]][f"{t}_{v}"] for v in C.VIEWS] for m in used]).clip(-32, 32) * 16) / 16
        assert model.combine[t] == pytest.approx(C.logistic(x, np.array([m[at] for m in used], float)).tolist(), rel=1e-6)
    got = {r["doc_id"]: r["kept"] for r in C.combined(scores, model).collect()}
    lost = [k for k, q, t in marks if k not in fitted and q == 1 and t == 0 and not got[k]]
    assert len(lost) <= 2 * C.MAX_GOOD_LOSS * len(marks) + 1
