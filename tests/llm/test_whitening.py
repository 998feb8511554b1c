"""Whitening against dense eigenvectors, and the rows and directions that drop out."""

import math

import numpy as np
import pytest

from pairprep.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, row string, x string"


def table(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "r", "x") for i, v in enumerate(vectors)], schema)


def run(spark, vectors, k, schema=SCHEMA):
    rows = W.usable_rows(table(spark, vectors, schema), "embedding")
    model = W.fit(rows, k)
    return rows, model, sorted(W.whiten(rows, model).collect(), key=lambda r: r.row.vec_id)


def dense(vectors):
    x = np.floor(64 * np.array(vectors, np.float64)) + 1_000_000
    centred = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / len(x))
    return x.astype(int).tolist(), centred, values[::-1], directions[:, ::-1]


@pytest.mark.parametrize("k", [3, 12, 40])
def test_equals_dense_eigenvectors(spark, k):
    rnd = np.random.default_rng(3)
    vectors = (rnd.standard_normal((300, 12)) * np.linspace(5, 1, 12) @ rnd.standard_normal((12, 12))).astype(np.float32)
    vectors = vectors.tolist() + vectors[:40].tolist()  # repeated rows
    rows, model, got = run(spark, vectors, k)
    x, centred, values, directions = dense(vectors)
    k = min(k, 12)
    want = centred @ directions[:, :k] / np.sqrt(values[:k])
    found = np.array([r.whitened for r in got])
    assert np.abs(np.abs((want * found).mean(axis=0)) - 1).max() < 1e-9
    assert np.abs(want - found * np.sign((want * found).sum(axis=0))).max() < 1e-8
    assert np.allclose(model.explained, values[:k] / values.sum(), rtol=1e-10)
    assert W.identity_error(rows, model) < 1e-9
    n, sums = len(x), [sum(c) for c in zip(*x)]
    assert [r.deviation for r in got] == [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]


def test_equal_deviations_and_missing_directions(spark):
    """A square's corners have one deviation twice; two dimensions never change."""
    corners = [[a, b, 7.0, -1.0] for a in (1.0, -1.0) for b in (1.0, -1.0)] * 3
    rows, model, got = run(spark, corners, 32)
    assert len(model.variances) == 2 and np.allclose(model.variances, 64.0**2)
    assert W.identity_error(rows, model) < 1e-12
    assert all(math.isclose(sum(w * w for w in r.whitened), 2.0) for r in got)


def test_rows_that_drop_out(spark):
    nan, inf = float("nan"), float("inf")
    good = [[float(i), float(i * i % 7), 1.0] for i in range(20)]
    bad = [None, [1.0, None, 2.0], [nan, 1.0, 1.0], [1.0, -inf, 1.0], [], [1.0], [1.0, 2.0, 3.0, 4.0]]
    rows, model, got = run(spark, good + bad, 32)
    assert model.n == 20 and [r.row.vec_id for r in got] == list(range(20))
    assert got[0].row.row == "r" and len(got[0].whitened) == 2


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[]] * 3, [None]])
def test_tables_without_variance(spark, vectors):
    rows, model, got = run(spark, vectors, 32)
    assert len(model.variances) == 0 and W.identity_error(rows, model) == 0.0
    assert all(r.whitened == [] for r in got)


def test_very_large_entries(spark):
    vectors = [[1e300, 0.5], [-1e300, 0.25], [3.0, 1.0]]
    rows, model, got = run(spark, vectors, 2, "vec_id long, embedding array<double>, row string, x string")
    x = [[min(max(64 * c, -W.BOUND), W.BOUND) for c in v] for v in vectors]
    x = [[math.floor(c) + 1_000_000 for c in v] for v in x]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((3 * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert list(model.sums) == sums
    assert [r.deviation for r in got] == [v if v < 1 << 63 else None for v in exact]
    assert W.identity_error(rows, model) < 1e-6


def test_integers_beyond_64_bits():
    x = np.array([[5_000_000_000, -3], [4, 2_000_000_000]], np.int64)
    n, sums = 3_000_000_000, (7_000_000_001, 12)
    exact = [[n * int(a) - s for a, s in zip(row, sums)] for row in x]
    assert np.allclose(W.centred(x, n, sums), np.array(exact, float) / n)
    small = np.array([[1, 2], [3, 5]], np.int64)
    assert W.deviations(small, 2, (4, 7)) == [13, 13]
    assert W.deviations(x, n, sums) == [None, None]
