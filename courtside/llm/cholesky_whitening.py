"""Embedding whitening by shifted CholeskyQR.

Entries become integers ``x = floor(1024 * c) + 100000``; ``A`` holds the
centred rows ``x - S / n`` and is never written.  Each pass streams ``A``,
orthogonalises its rows by triangular solves with the factors found so far
and sums the Gram matrix of the result: one small matrix per task, added up
by matrix row in a shuffle, so that the driver gets ``dim`` rows of ``dim``
numbers whatever the number of vectors.

* Pass 1 factors ``A'A + sI`` with the shift ``s = 11 (n d + d (d + 1)) u |A|^2``
  (u: the unit roundoff), which Cholesky survives also when ``A'A`` is
  singular to double precision.
* Later passes factor the Gram matrix of ``Q = A / R``, shifted again while
  it is near singular, and compose ``R`` of the factors, until every
  eigenvalue of the last Gram matrix ``H`` is 1, or is 0 because the vectors
  lie in fewer dimensions.
* ``A'A = R' H R`` then; the SVD of ``H^(1/2) R`` (of ``R`` itself, as ``H`` is
  the identity, when the rank is full) gives components and variances without
  forming ``A'A`` to half the digits.

Every pass rereads the input; nothing but matrices of the dimension is kept,
so a lost executor costs its own tasks only.

Defined results: rows whose vector is null, or holds a null or a non-finite
entry, are dropped.  The dimension is that of most remaining rows (the larger
of equally frequent ones; empty vectors never count); rows of another length
are dropped.  Repeated rows and ids count as often as they stand; a null id
stays null.  No rows, or rows that are all equal, give an empty result;
components without variance (beyond the rank) are not returned.  Equal
variances are told apart in the order of the SVD.  Entries beyond 2^42 count
as 2^42.  ``deviation`` is exact, and null where it exceeds a long.  Other
columns, whatever their names, are ignored.  There is no text: a very long
vector costs ``dim^2`` numbers a task.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from courtside.llm.common import ship_code, slices

SCALE, OFFSET = 1024, 100_000
#: Passes after which the factorisation is given up with an error.
MAX_PASSES = 12
#: Eigenvalues of the last Gram matrix at most so far from 1 (full rank), at most so large (no variance there).
ONE, NONE = 1e-12, 1e-8
#: Entries of a slice of vectors.
SLICE_ENTRIES = 1 << 18

_UNIT = np.finfo(float).eps / 2
_LARGEST = float(1 << 52)


class Centre(NamedTuple):
    """Number of rows and the means S / n as whole part and remainder / n."""

    n: int
    whole: np.ndarray
    rest: np.ndarray


class Components(NamedTuple):
    """Unit eigenvectors of the covariance as columns, their variances (falling) and the covariance's trace."""

    vectors: np.ndarray
    variances: np.ndarray
    trace: float


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the kept rows of a list column, and their x-vectors (int64)."""
    size = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    held = np.maximum(size, 0)
    rows = np.nonzero(size == dim)[0]
    c = flat[(np.cumsum(held) - held)[rows][:, None] + np.arange(dim)]
    fine = np.isfinite(c).all(axis=1)
    return rows[fine], np.clip(np.floor(SCALE * c[fine]), -_LARGEST, _LARGEST).astype(np.int64) + OFFSET


def _vectors(df: DataFrame, column: str) -> DataFrame:
    ship_code(df.sparkSession)
    return df.select(F.col(column).cast("array<double>").alias("v"))


def _solve(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """q with q r = a, r upper triangular, column by column."""
    q = np.empty_like(a)
    for j in range(a.shape[1]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _centred(x: np.ndarray, centre: Centre) -> np.ndarray:
    return (x - centre.whole) - centre.rest / centre.n


def dimension(df: DataFrame, column: str) -> int:
    """The length of most vectors without null or non-finite entries; 0 without any."""
    v = F.col("v")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    found = _vectors(df, column).filter(v.isNotNull() & (F.size(v) > 0) & ~bad).groupBy(F.size(v).alias("dim")).count()
    top = found.orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    return top[0]["dim"] if top else 0


def centre_of(df: DataFrame, column: str, dim: int) -> Centre:
    """Exact sums in two halves of 26 bits each, which no number of rows below 2^36 overflows."""
    def run(batches):
        n, high, low = 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
        for b in slices(batches, max(1, SLICE_ENTRIES // dim)):
            _, x = _matrix(b["v"], dim)
            n += len(x)
            high += (x >> 26).sum(axis=0)
            low += (x & ((1 << 26) - 1)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, n)), pa.array(high), pa.array(low)], names=["i", "n", "high", "low"])

    sums = _vectors(df, column).mapInArrow(run, "i int, n long, high long, low long").groupBy("i").agg(F.sum("n"), F.sum("high"), F.sum("low")).orderBy("i").collect()
    n = sums[0][1]
    parts = [divmod((s[2] << 26) + s[3], n) for s in sums]
    return Centre(n, np.array([p[0] for p in parts], np.int64), np.array([p[1] for p in parts], np.float64))


def _gram(df: DataFrame, column: str, dim: int, centre: Centre, to_rows, width: int) -> np.ndarray:
    """The Gram matrix (width x width) of ``to_rows(A)`` over all rows."""
    def run(batches):
        total = np.zeros((width, width))
        for b in slices(batches, max(1, SLICE_ENTRIES // dim)):
            q = to_rows(_centred(_matrix(b["v"], dim)[1], centre))
            total += q.T @ q
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "g"])

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for b in slices(batches, 64):
            for i, row in zip(b["i"].to_pylist(), b["g"]):
                held[i] = held.get(i, 0.0) + row.values.to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(list(held.values()), pa.list_(pa.float64()))], names=["i", "g"])

    schema = "i int, g array<double>"
    rows = _vectors(df, column).mapInArrow(run, schema).repartition("i").mapInArrow(add, schema).collect()
    g = np.zeros((width, width))
    for i, row in rows:
        g[i] = row
    return (g + g.T) / 2


def fit_components(df: DataFrame, column: str, dim: int, centre: Centre) -> Components:
    """Components of the covariance of the x-vectors, by shifted CholeskyQR and the SVD of R."""
    factors: list[np.ndarray] = []
    r = np.eye(dim)
    trace = 0.0
    for k in range(MAX_PASSES):
        def to_q(a, factors=tuple(factors)):
            for f in factors:
                a = _solve(a, f)
            return a

        gram = _gram(df, column, dim, centre, to_q, dim)
        values, turn = np.linalg.eigh(gram)
        if k == 0:
            trace = float(np.trace(gram))
            if not trace:
                return Components(np.zeros((dim, 0)), np.zeros(0), 0.0)
        elif np.abs(values - 1).max() <= ONE * dim or values[0] < NONE and ((values > 0.9) | (values < NONE)).all():
            rank = int((values > 0.5).sum())
            root = (turn * np.sqrt(np.where(values > 0.5, values, 0))) @ turn.T
            _, sigma, w = np.linalg.svd(root @ r)
            return Components(w[:rank].T, sigma[:rank] ** 2 / centre.n, trace / centre.n)
        shift = 11 * (centre.n * dim + dim * (dim + 1)) * _UNIT * values[-1] if k == 0 or values[0] < 1e-3 else 0.0
        factors.append(np.linalg.cholesky(gram + shift * np.eye(dim)).T)
        r = factors[-1] @ r
    raise RuntimeError(f"no orthogonal rows after {MAX_PASSES} passes")


def identity_error(df: DataFrame, column: str, dim: int, centre: Centre, weights: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    width = weights.shape[1]
    mean = _gram(df, column, dim, centre, lambda a: np.hstack([np.ones((len(a), 1)), a @ weights]), width + 1)[0, 1:] / centre.n
    covariance = _gram(df, column, dim, centre, lambda a: a @ weights - mean, width) / centre.n
    return float(np.abs(covariance - np.eye(width)).max())


def _deviations(y: np.ndarray, centre: Centre) -> pa.Array:
    """Sum over dimensions of (n x - S)^2 = (n y - rest)^2, exact; null beyond a long."""
    rest = centre.rest.astype(np.int64)
    if y.size == 0 or (centre.n * (int(np.abs(y).max()) + 1)) ** 2 * y.shape[1] < 1 << 62:
        return pa.array(((centre.n * y - rest) ** 2).sum(axis=1), pa.int64())
    rest = [int(v) for v in rest]
    exact = (sum((centre.n * a - s) ** 2 for a, s in zip(row, rest)) for row in y.tolist())
    return pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())


def whiten(df: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = 8) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) per kept row and component.

    ``component`` counts from 1 by falling variance; ``whitened`` is the
    centred row projected on it over its standard deviation; ``explained`` its
    share of the total variance.
    """
    kind = df.schema[id_column].dataType
    out = T.StructType([T.StructField("vec_id", kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
                        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    nothing = df.sparkSession.createDataFrame([], out)
    dim = dimension(df, column)
    if not dim:
        return nothing
    centre = centre_of(df, column, dim)
    found = fit_components(df, column, dim, centre)
    many = min(components, len(found.variances))
    if not many:
        return nothing
    weights = found.vectors[:, :many] / np.sqrt(found.variances[:many])
    error, share = identity_error(df, column, dim, centre, weights), found.variances[:many] / found.trace

    def run(batches):
        for b in slices(batches, max(1, SLICE_ENTRIES // dim)):
            rows, x = _matrix(b["v"], dim)
            each = np.repeat(np.arange(len(rows)), many)
            yield pa.RecordBatch.from_arrays([
                b["id"].take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(rows))), pa.array(np.full(len(each), centre.n)),
                _deviations(x - centre.whole, centre).take(pa.array(each)), pa.array((_centred(x, centre) @ weights).ravel()),
                pa.array(np.tile(share, len(rows))), pa.array(np.full(len(each), error))], schema=schema)

    schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out])
    return df.select(F.col(id_column).alias("id"), F.col(column).cast("array<double>").alias("v")).mapInArrow(run, out)
