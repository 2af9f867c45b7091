"""The qd solver against a library SVD, and the operator against a dense version."""

import math

import numpy as np
import pytest
from conftest import SF_SMALL

from txrisk.llm.queries import QUERIES
from txrisk.llm.whitening import bidiagonalise, directions, singular_values, triangle, twisted_vector, whiten

SCHEMA = "vec_id long, embedding array<float>, component string"


def _matrices():
    rng = np.random.default_rng(2)
    wide = np.diag(np.abs(np.arange(21) - 10.)) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    yield from (rng.normal(size=(300, d)) for d in (1, 2, 3, 17, 64))
    yield from (np.eye(12), np.diag([1., 1, 1, 2, 2, 2, 3, 3, 3]), wide, rng.normal(size=(7, 20)))
    yield rng.normal(size=(200, 4)) @ rng.normal(size=(4, 25))                  # rank 4
    yield rng.normal(size=(90, 20)) * np.logspace(0, -11, 20)                   # graded
    yield np.linalg.qr(rng.normal(size=(30, 30)))[0]                            # all values equal


@pytest.mark.parametrize("m", list(_matrices()), ids=lambda m: "x".join(map(str, m.shape)))
def test_values_and_vectors(m):
    r = triangle(m)
    values, axes = directions(r)
    want = np.linalg.svd(m, compute_uv=False)
    want = np.concatenate([want, np.zeros(r.shape[1] - min(len(want), r.shape[1]))])[:r.shape[1]]
    assert np.abs(values - want).max() <= 1e-13 * want[0]
    k = axes.shape[1]
    assert k == min(16, (want > len(want) * np.finfo(float).eps * want[0]).sum())
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-11
    assert np.abs(m.T @ (m @ axes) - axes * values[:k] ** 2).max() < 1e-12 * want[0] ** 2


def test_dqds_keeps_relative_accuracy():
    """A graded bidiagonal: tiny values to full relative precision, from exact products."""
    n = 8
    diag, off = 10.0 ** -(3 * np.arange(n)), 10.0 ** -(3 * np.arange(n - 1) + 1)
    got = singular_values(diag, off)
    assert math.isclose(np.prod(got), np.prod(diag), rel_tol=1e-13)             # the determinant
    # The smallest value through the inverse's largest: B^-1 has positive graded entries too.
    smallest = 1 / np.linalg.svd(np.linalg.inv(np.diag(diag) + np.diag(off, 1)), compute_uv=False)[0]
    assert math.isclose(got[-1], smallest, rel_tol=1e-10)


def test_bidiagonal_form_and_twisted_vector():
    r = triangle(np.random.default_rng(4).normal(size=(50, 9)))
    diag, off, p = bidiagonalise(r)
    b = np.diag(diag) + np.diag(off, 1)
    assert np.allclose(p.T @ p, np.eye(9), atol=1e-14) and np.allclose(p @ b.T @ b @ p.T, r.T @ r, atol=1e-11)
    s = singular_values(diag, off)[3]
    z = twisted_vector(diag, off, s)
    assert np.abs(b.T @ (b @ z) - s * s * z).max() < 1e-12 * s * s


def _dense(vectors):
    """id, x rows by the contract, and eigenvectors of an explicit covariance."""
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - b) / n for a, b in zip(x, s)] for x in fit])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, s, e[::-1], v[:, ::-1]


def _compare(rows, vectors):
    kept, n, s, e, v = _dense(vectors)
    k = min(16, (e > 1e-10 * e[0]).sum())
    want = {}
    for i, x in kept:
        whole = [n * a - b for a, b in zip(x, s)]
        want.setdefault(i, []).append((sum(w * w for w in whole), np.array(whole) / n @ v[:, :k] / np.sqrt(e[:k])))
    assert len(rows) == len(kept) * k
    signs = {}
    for r in rows:
        near = [w for w in want[r.vec_id] if w[0] == r.deviation]
        assert r.n == n and near and r.identity_error <= 1e-8
        assert math.isclose(r.explained, e[r.component - 1] / e.sum(), rel_tol=1e-9)
        value = near[0][1][r.component - 1]
        if abs(value) > 1e-3:
            sign = signs.setdefault(r.component, np.sign(value * r.whitened))
            assert math.isclose(r.whitened, sign * value, rel_tol=1e-5, abs_tol=1e-7)
    assert set(signs) == set(range(1, k + 1))


def test_query_against_dense_version(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    _compare(QUERIES["op12_whitening"](spark, SF_SMALL).collect(), [tuple(r)[:2] for r in table.collect()])


def test_edges(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(40)]
    vectors += [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 0.0, 0.0]),
                (7, vectors[5][1]), (7, vectors[5][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors] + [(104, [], "x"), (105, [1.0, 2.0], "x")], SCHEMA)
    _compare(whiten(df.repartition(7)).collect(), vectors)


def test_large_entries_are_exact(spark):
    vectors = [(i, [float(2.0**40 * (i % 5)), float(i)]) for i in range(20)]
    rows = whiten(spark.createDataFrame([(i, v, "x") for i, v in vectors], SCHEMA)).collect()
    kept, n, s, *_ = _dense(vectors)
    exact = {i: sum((n * a - b) ** 2 for a, b in zip(x, s)) for i, x in kept}
    assert {r.vec_id: r.deviation for r in rows} == {i: d if d < 2**63 else None for i, d in exact.items()}


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_without_variance_there_is_no_row(spark, vectors):
    assert whiten(spark.createDataFrame([(i, v, "x") for i, v in vectors], SCHEMA)).count() == 0


def test_few_vectors_have_few_components(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0, 0.0], ""), (None, [0.0, 1.0, 0.0], ""), (3, [0.0, 0.0, 1.0], "")], SCHEMA)
    rows = whiten(df).collect()
    assert sorted({r.component for r in rows}) == [1, 2] and len(rows) == 6
    z = np.array([[r.whitened for r in rows if r.component == c] for c in (1, 2)])
    assert np.allclose(z @ z.T / 3, np.eye(2), atol=1e-12)      # equal eigenvalues: any basis, but whitened
