"""Whitening against a dense eigendecomposition and exact integer deviations."""

import math

import numpy as np
import pytest

from courtside.llm import cholesky_whitening as W
from courtside.llm.queries import op12_cholesky_whitening
from tests.conftest import SF_SMALL
from tests.llm.helpers import with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"
INF, NAN = float("inf"), float("nan")


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in rows], SCHEMA)


def plain(rows, top=8):
    """{(row, component): (deviation, |whitened|, explained)} by numpy's eigensolver; rows are kept ones."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    a = np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in x])
    values, turn = np.linalg.eigh(a.T @ a / n)
    order = [k for k in np.argsort(-values) if values[k] > 1e-12 * values.max() and values.max() > 0][:top]
    return {(i, j + 1): (sum((n * c - s) ** 2 for c, s in zip(x[i], sums)), abs(a[i] @ turn[:, k]) / math.sqrt(values[k]), values[k] / values.sum())
            for i in range(n) for j, k in enumerate(order)}


def check(df, rows, top=8):
    got = df.collect()
    want = plain(rows, top)
    assert len(got) == len(want)
    for r in got:
        deviation, whitened, explained = want[r.vec_id, r.component]
        assert r.n == len(rows) and r.deviation == deviation
        assert abs(abs(r.whitened) - whitened) < 1e-7 * max(1, whitened)
        assert abs(r.explained - explained) < 1e-9 and r.identity_error < 1e-9


def some(n, dim, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, dim)) * np.geomspace(1, spread, dim) @ np.linalg.qr(rng.normal(size=(dim, dim)))[0]).tolist()


@pytest.mark.parametrize("n, dim, spread", [(40, 5, 1.0), (60, 12, 0.05), (6, 12, 1.0), (2, 3, 1.0), (30, 1, 1.0)])
def test_equals_eigenvectors(spark, n, dim, spread):
    rows = some(n, dim, n, spread)
    check(W.whiten(vectors(spark, enumerate(rows)).repartition(3)), rows)


def test_dependent_and_constant_columns(spark):
    rows = [[a, a, 1.0, b, 0.0] for a, b, *_ in some(25, 2, 7)]
    check(W.whiten(vectors(spark, enumerate(rows))), rows)


def test_signs_are_the_same_for_all_rows(spark):
    rows = some(30, 4, 3)
    got = {(r.vec_id, r.component): r.whitened for r in W.whiten(vectors(spark, enumerate(rows))).collect()}
    y = np.array([[got[i, k] for k in range(1, 5)] for i in range(30)])
    assert np.allclose(y.T @ y / 30, np.eye(4), atol=1e-10)


def test_awkward_rows(spark):
    rows = some(12, 3, 5)
    bad = [(20, None), (21, [1, None, 2]), (22, [1, NAN, 2]), (23, [INF, 0, 0]), (24, []), (25, [1, 2]), (26, [-INF, 1, 1])]
    df = vectors(spark, [*enumerate(rows), *bad])
    check(W.whiten(with_clashes(df, "component", "n", "v", "id", "whitened", "dim")), rows)
    twice = W.whiten(vectors(spark, [(None, rows[0]), (1, rows[1]), (1, rows[1]), (3, rows[2])])).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in twice if r.component == 1) == [(False, 1), (False, 1), (False, 3), (True, 0)]


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [])], [(0, [1, 2])], [(0, [1, 2]), (1, [1, 2])]])
def test_nothing_to_whiten(spark, rows):
    assert W.whiten(vectors(spark, rows)).collect() == []


def test_near_singular_needs_the_shift(spark):
    """Variances that differ by 1e10, where a plain Cholesky of the Gram matrix loses half the digits."""
    rng = np.random.default_rng(1)
    wide = rng.normal(size=200) * 200
    rows = np.stack([wide, wide + rng.integers(0, 3, 200) / 1024, rng.normal(size=200)], axis=1).astype(np.float32).astype(float).tolist()
    got = W.whiten(vectors(spark, enumerate(rows)).repartition(4)).collect()
    assert {r.component for r in got} == {1, 2, 3} and all(r.identity_error < 1e-7 for r in got)


def test_large_deviations():
    y = np.array([[3, -4], [1 << 40, 5]])
    centre = W.Centre(1 << 33, np.zeros(2, np.int64), np.array([1.0, 2.0]))
    assert W._deviations(y, centre).to_pylist() == [None, None]
    centre = W.Centre(1 << 20, np.zeros(2, np.int64), np.array([1.0, 2.0]))
    assert W._deviations(y, centre).to_pylist() == [(3 * 2**20 - 1) ** 2 + (-4 * 2**20 - 2) ** 2, None]


def test_query_over_the_table(spark):
    rows = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    assert sorted(rows) == list(range(len(rows)))
    check(op12_cholesky_whitening(spark, SF_SMALL), [rows[i] for i in range(len(rows))])
