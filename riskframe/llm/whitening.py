"""Whitening of embeddings by the leading eigenvectors of their covariance.

Two passes over the vectors give exact sums and the centred covariance: every task adds the
outer products of its centred vectors and sends one row per matrix entry, which Spark sums. What
reaches the driver is one d x d matrix. There it is brought to tridiagonal form by Householder
reflections, Sturm counts and bisection find its leading eigenvalues, and inverse iteration finds
their vectors, made orthogonal again inside clusters of close eigenvalues. The d x k projection
goes to the tasks; a third pass measures how far the whitened covariance is from the identity.

Entries are integers (``floor(scale * c) + offset``), so sums and deviations are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.tables import map_arrow

_LONG = np.iinfo(np.int64)
CHUNK = 4096  # vectors multiplied at a time


# --- eigenvectors of a symmetric matrix -------------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the Householder vectors of a symmetric matrix.

    Reflection ``j`` acts on the coordinates after ``j`` and clears column ``j`` below the
    subdiagonal; each is a rank-two update of what is left of the matrix.
    """
    a = np.array(a, np.float64)
    d = len(a)
    mirrors = []
    for j in range(d - 2):
        x = a[j + 1:, j]
        v = x.copy()
        size = np.linalg.norm(x)
        v[0] += np.copysign(size, x[0])
        length = np.linalg.norm(v)
        if length == 0:
            mirrors.append(np.zeros(d - j - 1))
            continue
        v /= length
        rest = a[j + 1:, j + 1:]
        p = 2.0 * (rest @ v)
        p -= (p @ v) * v
        rest -= np.outer(v, p) + np.outer(p, v)
        a[j + 1, j] = a[j, j + 1] = -np.copysign(size, x[0])
        a[j + 2:, j] = a[j, j + 2:] = 0.0
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def from_tridiagonal(mirrors: list[np.ndarray], z: np.ndarray) -> np.ndarray:
    """Vectors (columns) of the tridiagonal matrix in the coordinates of the first one."""
    z = z.copy()
    for j in range(len(mirrors) - 1, -1, -1):
        v = mirrors[j]
        z[j + 1:] -= 2.0 * np.outer(v, v @ z[j + 1:])
    return z


def sturm_counts(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of ``at``: negative pivots of T - at I."""
    floor = np.finfo(float).tiny / np.finfo(float).eps + np.finfo(float).eps ** 2 * (
        np.abs(diag).max() + (np.abs(off).max() if len(off) else 0.0))
    below = np.zeros(len(at), np.int64)
    pivot = np.ones(len(at))
    for i, a in enumerate(diag):
        pivot = a - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < floor, -floor, pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection on Sturm counts (all at once)."""
    d = len(diag)
    reach = np.zeros(d)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    pad = np.finfo(float).eps * 4 * (np.abs(diag) + reach).max() + np.finfo(float).tiny
    low = np.full(k, (diag - reach).min() - pad)
    high = np.full(k, (diag + reach).max() + pad)
    want = d - 1 - np.arange(k)  # eigenvalues that lie below the one searched for
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        above = sturm_counts(diag, off, middle) <= want
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _solve_shifted(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray,
                   least: float) -> np.ndarray:
    """x of (T - shift I) x = b by elimination with row exchanges; tiny pivots become ``least``."""
    d = len(diag)
    up = np.zeros((d, 3))  # rows of the upper triangle: columns i, i + 1, i + 2
    x = b.copy()
    row = np.array([diag[0] - shift, off[0] if d > 1 else 0.0, 0.0])
    for i in range(d - 1):
        below = np.array([off[i], diag[i + 1] - shift, off[i + 1] if i + 2 < d else 0.0])
        if abs(below[0]) > abs(row[0]):
            row, below = below, row
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(row[0]) < least:
            row[0] = least
        up[i] = row
        factor = below[0] / row[0]
        x[i + 1] -= factor * x[i]
        row = np.array([below[1] - factor * row[1], below[2] - factor * row[2], 0.0])
    if abs(row[0]) < least:
        row[0] = least
    up[d - 1] = row
    for i in range(d - 1, -1, -1):
        x[i] -= up[i, 1] * (x[i + 1] if i + 1 < d else 0.0)
        x[i] -= up[i, 2] * (x[i + 2] if i + 2 < d else 0.0)
        x[i] /= up[i, 0]
    return x


def tridiagonal_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray,
                        rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors (columns) of falling ``values`` by inverse iteration.

    Neighbours closer than a thousandth of the matrix's size form a cluster; inside it each
    iterate is made orthogonal to the vectors already found, so equal eigenvalues get different
    vectors. The shifts of equal values are set apart by a few units of rounding.
    """
    d, eps = len(diag), np.finfo(float).eps
    size = max((np.abs(diag) + np.append(np.abs(off), 0) + np.append(0, np.abs(off))).max(),
               np.finfo(float).tiny)
    z = np.zeros((d, len(values)))
    random = np.random.default_rng(d)
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * size:
            first = j
        shift = min(value, shift - 4 * eps * size) if j > first else value
        x = random.standard_normal(d)
        x /= np.linalg.norm(x)
        for _ in range(rounds):
            x = _solve_shifted(diag, off, shift, x, eps * size)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= z[:, first:j] @ (z[:, first:j].T @ x)
            x /= np.linalg.norm(x)
        z[:, j] = x
    return z


def leading_eigenvectors(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit vectors (columns)."""
    k = min(k, len(a))
    if not k:
        return np.zeros(0), np.zeros((len(a), 0))
    diag, off, mirrors = tridiagonal(a)
    values = leading_eigenvalues(diag, off, k)
    return values, from_tridiagonal(mirrors, tridiagonal_vectors(diag, off, values))


# --- passes over the vectors ------------------------------------------------------------

@dataclass(frozen=True)
class Whitener:
    """What a fit gives; ``base`` and ``shift`` are whole and broken part of the means."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray      # d x k, unit columns
    trace: float
    scale: int
    offset: int

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the means, without the rounding of large means."""
        base, shift = _means(self.n, self.sums)
        return (x - base).astype(np.float64) - shift

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.eigenvalues))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over the dimensions of (n x - S)^2; None where a long cannot hold it."""
        base, _ = _means(self.n, self.sums)
        left = [s - self.n * int(b) for s, b in zip(self.sums, base)]
        most = max((abs(int(e)) for e in (x - base).ravel()[[np.abs(x - base).argmax()]]),
                   default=0) if x.size else 0
        if (self.n * (most + 1)) ** 2 * max(1, self.dimensions) < _LONG.max:
            z = self.n * (x - base) - np.array(left, np.int64)
            return (z * z).sum(1).tolist()
        out = []
        for row in x.tolist():
            z = sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums))
            out.append(z if z <= _LONG.max else None)
        return out


def _means(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    base = [s // n for s in sums]
    return (np.array(base, np.int64),
            np.array([(s - n * b) / n for s, b in zip(sums, base)], np.float64))


def usable(col: str) -> Column:
    """Vectors with at least one entry, none of them null, NaN or infinite."""
    bad = F.exists(col, lambda c: c.isNull() | F.isnan(c.cast("double")) |
                   (F.abs(c.cast("double")) == float("inf")))
    return F.col(col).isNotNull() & (F.size(col) > 0) & ~bad


def _integers(column: pa.Array, scale: int, offset: int) -> np.ndarray:
    """(rows, d) of floor(scale * c) + offset."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    low, high = float(_LONG.min // 4), float(_LONG.max // 4)
    x = np.clip(np.floor(flat * scale), low, high).astype(np.int64) + offset
    return x.reshape(len(column), -1)


def _moved(vectors: DataFrame, emit) -> DataFrame:
    """(i, j, value) rows of every task, summed by (i, j); a few rows per task are shuffled."""
    parts = map_arrow(vectors, emit, "i int, j int, value double")
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


def _products(centre, scale: int, offset: int):
    """Task function: upper triangle of the summed outer products of ``centre(x)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if not b.num_rows:
                continue
            x = _integers(b.column("v"), scale, offset)
            for at in range(0, len(x), CHUNK):
                y = centre(x[at:at + CHUNK])
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                ["i", "j", "value"])

    return run


def _matrix(rows: DataFrame, d: int) -> np.ndarray:
    """d (d + 1) / 2 summed entries as a symmetric matrix."""
    out = np.zeros((d, d))
    for r in rows.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def _inputs(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.filter(usable(vector_col)).select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))


def _totals(rows: DataFrame, scale: int, offset: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for b in batches:
            if not b.num_rows:
                continue
            sizes = np.unique(np.diff(b.column("v").offsets.to_numpy()))
            if len(sizes) > 1 or (sums is not None and len(sums) != sizes[0]):
                raise ValueError("vectors must have one length")
            x = _integers(b.column("v"), scale, offset)
            if int(np.abs(x).max()) * len(x) < _LONG.max:
                part = [int(s) for s in x.sum(0)]
            else:
                part = [sum(c) for c in zip(*x.tolist())]
            n += len(x)
            sums = part if sums is None else [a + p for a, p in zip(sums, part)]
        for i, s in enumerate(sums or []):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([n], pa.int64()), pa.array([str(s)])],
                ["i", "n", "s"])

    got = (map_arrow(rows, run, "i int, n bigint, s string").groupBy("i")
           .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
           .orderBy("i").collect())  # a row per dimension
    if len({r["n"] for r in got}) > 1:
        raise ValueError("vectors must have one length")
    return (got[0]["n"], [int(r["s"]) for r in got]) if got else (0, [])


def fit(vectors: DataFrame, components: int = 32, vector_col: str = "embedding", scale: int = 64,
        offset: int = 1_000_000) -> Whitener | None:
    """Whitener of all usable vectors, or None where there are none.

    Directions whose variance is nothing but rounding (below 1e-12 of the largest) cannot be
    brought to variance 1: they are left out, so there may be fewer than ``components``.
    """
    rows = _inputs(vectors, vector_col, vector_col)
    n, sums = _totals(rows, scale, offset)
    if not n:
        return None
    base, shift = _means(n, sums)
    products = _products(lambda x: (x - base).astype(np.float64) - shift, scale, offset)
    covariance = _matrix(_moved(rows, products), len(sums)) / n
    values, axes = leading_eigenvectors(covariance, components)
    real = values > 1e-12 * max(values[0], np.finfo(float).tiny)
    return Whitener(n, sums, values[real], axes[:, real], float(np.trace(covariance)), scale,
                    offset)


def identity_error(vectors: DataFrame, model: Whitener, vector_col: str = "embedding") -> float:
    """Largest entry of |covariance of the whitened vectors - identity| over all vectors.

    Their mean is 0 by construction up to rounding; what it is exactly is taken off as well.
    """
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def with_one(x: np.ndarray) -> np.ndarray:
        return np.hstack((model.whitened(x), np.ones((len(x), 1))))

    rows = _inputs(vectors, vector_col, vector_col)
    sums = _matrix(_moved(rows, _products(with_one, model.scale, model.offset)), k + 1)
    mean = sums[:k, k] / model.n
    return float(np.abs(sums[:k, :k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 32, id_col: str = "vec_id",
           vector_col: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """One row per usable vector and component: ``vec_id``, ``component`` (from 1, by falling
    eigenvalue), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``,
    ``eigenvalue``.

    Vectors that are null, empty, or hold a null or non-finite entry are left out of the fit
    and of the result; all others must have one length (else ``ValueError``). Null or repeated
    ids and repeated vectors are rows like any other; extra columns are ignored. Without a
    usable vector, or when all are equal, the result has no rows. ``deviation`` is null where
    a long cannot hold it; entries beyond a quarter of the range of a long count as that.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
              "explained double, identity_error double, eigenvalue double")
    model = fit(vectors, components, vector_col, scale, offset)
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, model, vector_col)
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                part = b.slice(at, CHUNK)
                x = _integers(part.column("v"), scale, offset)
                rows = np.repeat(np.arange(len(x)), k)
                each = [np.arange(1, k + 1, dtype=np.int32), model.eigenvalues / model.trace,
                        model.eigenvalues]
                number, explained, values = (pa.array(np.tile(e, len(x))) for e in each)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(rows)), number,
                     pa.array(np.full(len(rows), model.n)),
                     pa.array(model.deviations(x), pa.int64()).take(pa.array(rows)),
                     pa.array(model.whitened(x).ravel()), explained,
                     pa.array(np.full(len(rows), error)), values],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained",
                     "identity_error", "eigenvalue"])

    return map_arrow(_inputs(vectors, id_col, vector_col), run, schema)
