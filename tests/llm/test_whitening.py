"""Whitening against numpy's eigenvectors and exact integer sums."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import queries as Q
from riskframe.llm import whitening as W

from helpers import SMALL


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
def test_eigenvectors_of_random_matrices(d):
    x = np.random.default_rng(d).standard_normal((3 * d + 2, d)) * np.arange(1, d + 1)
    a = np.cov(x.T).reshape(d, d)
    values, axes = W.leading_eigenvectors(a, 32)
    want = np.linalg.eigvalsh(a)[::-1][:32]
    assert np.allclose(values, want, rtol=1e-12, atol=1e-13 * want[0])
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ axes - axes * values).max() < 1e-12 * want[0]


@pytest.mark.parametrize("a", [
    np.eye(6), np.zeros((4, 4)), np.diag([5., 5, 5, 1, 1, 0]),
    np.kron(np.eye(3), [[2., 1], [1, 2]]),
    np.diag([1., 1, 1, 1]) + 1e-14 * np.ones((4, 4))])
def test_equal_eigenvalues_get_orthogonal_vectors(a):
    values, axes = W.leading_eigenvectors(a, len(a))
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], atol=1e-13)
    assert np.abs(axes.T @ axes - np.eye(len(a))).max() < 1e-12
    assert np.abs(a @ axes - axes * values).max() < 1e-12


def test_sturm_counts():
    diag, off = np.array([2., 2, 2]), np.array([1., 1])
    at = np.array([0., 1, 2.1, 5])
    assert W.sturm_counts(diag, off, at).tolist() == [0, 1, 2, 3]


def brute(rows, k=32):
    """vec_id -> (deviation, whitened), explained and eigenvectors, from plain numpy and ints."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    z = np.array([[n * a - s for a, s in zip(r, sums)] for r in x], float) / n
    cov = z.T @ z / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    dev = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    return dev, (z @ v) / np.sqrt(e), e / np.trace(cov)


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(
        f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()]
    dev, white, explained = brute(rows)
    got = {}
    for r in Q.op11_whitening(spark, SMALL).collect():
        got[r.vec_id, r.component] = r
    k = white.shape[1]
    assert len(got) == len(rows) * k
    y = np.array([[got[i, c + 1].whitened for c in range(k)] for i, _ in rows])
    sign = np.sign((y * white).sum(0))
    assert np.abs(y * sign - white).max() < 1e-8
    for (i, _), d in zip(rows, dev):
        assert got[i, 1].deviation == d and got[i, 1].n == len(rows)
    first = [got[rows[0][0], c + 1] for c in range(k)]
    assert np.allclose([r.explained for r in first], explained, rtol=1e-10)
    assert {r.identity_error for r in got.values()} == {first[0].identity_error}
    assert first[0].identity_error < 1e-9


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, -1.0]), (2, [2.0, 3.0]), (2, [2.0, 3.0]), (None, [-1.0, 7.25])]
    bad = [(3, None), (4, []), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [1.0, -inf])]
    df = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<float>").repartition(3)
    for name in ("v", "i", "j", "n", "value", "component"):
        df = df.withColumn(name, F.lit(name))
    got = W.whiten(df).collect()
    dev, white, _ = brute(good, 2)
    assert sorted((r.vec_id or 0, r.deviation, r.component) for r in got) == sorted(
        (i or 0, d, c) for (i, _), d in zip(good, dev) for c in (1, 2))
    assert sorted(abs(r.whitened) for r in got) == pytest.approx(sorted(np.abs(white).ravel()))


def test_no_rows_no_variance_and_one_direction(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).count() == 0
    line = W.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], schema))
    assert {r.component for r in line.collect()} == {1}  # the other has no variance
    with pytest.raises(Exception, match="one length"):
        W.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema)).count()


def test_deviation_beyond_a_long_is_null(spark):
    df = spark.createDataFrame([(1, [1e9]), (2, [0.0]), (3, [1e17])],
                               "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.deviation for r in W.whiten(df).collect()}
    x = [math.floor(64 * c) + 1_000_000 for c in (1e9, 0.0, 1e17)]
    x[2] = min(x[2], 2 ** 63 // 4 - 1 + 1_000_000)
    want = {i + 1: (3 * a - sum(x)) ** 2 for i, a in enumerate(x)}
    assert got == {i: w if w < 2 ** 63 else None for i, w in want.items()}
