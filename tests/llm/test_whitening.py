"""Whitening against plain arithmetic."""

import decimal
import math
from fractions import Fraction

import numpy as np
import pytest

from cdclake.llm import whitening


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)


def polynomial(matrix):
    """The characteristic polynomial by repeated multiplication, in fractions."""
    size = len(matrix)
    a = np.array([[Fraction(int(v)) for v in row] for row in matrix], object)
    found, m = [Fraction(1)], np.zeros((size, size), object)
    for k in range(1, size + 1):
        m = a @ m + found[-1] * np.eye(size, dtype=int).astype(object)
        found.append(-sum((a @ m)[i, i] for i in range(size)) / k)
    return [int(v) for v in found]


@pytest.mark.parametrize("size,spread", [(1, 5), (2, 5), (7, 3), (12, 1000)])
def test_polynomial(spark, size, spread):
    x = np.random.default_rng(size).integers(-spread, spread + 1, (30, size)).astype(object)
    matrix = x.T @ x
    assert whitening.characteristic_polynomial(spark, matrix) == polynomial(matrix)


def test_polynomial_needs_pivots(spark):
    matrix = np.array([[2, 0, 1, 0], [0, 2, 0, 0], [1, 0, 2, 1], [0, 0, 1, 2]], object)
    assert whitening.characteristic_polynomial(spark, matrix) == polynomial(matrix)
    assert whitening.characteristic_polynomial(spark, np.diag([3, 3, 0]).astype(object)) == [1, -6, 9, 0]


def test_primes():
    found = whitening.primes(5)
    assert found[0] == 2**31 - 1 and all(all(p % d for d in range(2, math.isqrt(p) + 1)) for p in found)


def test_roots():
    poly = [1, -22, 195, -884, 2135, -2550, 1125, 0, 0]  # 5, 5, 5, 3, 3, 1, 0, 0
    found = whitening.largest_roots(poly, 16)
    assert [times for _, times in found] == [3, 2, 1]
    assert all(abs(root - want) < decimal.Decimal("1e-55") for (root, _), want in zip(found, (5, 3, 1)))
    assert [times for _, times in whitening.largest_roots(poly, 2)] == [3]
    near = [1, -(2 * 10**20 + 1), 10**20 * (10**20 + 1)]  # 10**20 and 10**20 + 1
    assert [(int(r.to_integral_value()), t) for r, t in whitening.largest_roots(near, 5)] == [(10**20 + 1, 1), (10**20, 1)]
    assert whitening.largest_roots([1, 0, 0], 5) == []


def test_components_of_a_multiple_root():
    rng = np.random.default_rng(3)
    reflect = np.eye(6) - 2 * np.ones((6, 6)) / 6
    matrix = np.rint(reflect @ np.diag([9, 9, 9, 4, 1, 1]) @ reflect * 36).astype(int)
    vectors = np.array([v.astype(float) for v in whitening.null_vectors(matrix.tolist(), decimal.Decimal(9 * 36), 3)])
    assert np.abs(vectors @ vectors.T - np.eye(3)).max() < 1e-14
    assert np.abs(matrix @ vectors.T - 9 * 36 * vectors.T).max() < 1e-10


def test_products_are_exact():
    rng = np.random.default_rng(4)
    for most in (10, 1 << 22, 1 << 40, 1 << 62):
        rows = rng.integers(-most, most, (50, 3))
        x = rows.astype(object)
        assert (whitening.exact_product(rows) == x.T @ x).all()


def expected(vectors, count=16):
    """Deviation, whitened values and shares in doubles, components up to their sign."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    fit = np.unique(x.astype(np.int64), axis=0)
    n, sums = len(fit), fit.sum(axis=0).astype(object)
    deviation = [int(sum((n * v - s) ** 2 for v, s in zip(row, sums))) for row in x]
    centred = fit - fit.mean(axis=0)
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    order = [k for k in np.argsort(-values)[:count] if values[k] > 1e-9]
    z = (x.astype(float) - fit.mean(axis=0)) @ parts[:, order] / np.sqrt(values[order])
    return n, deviation, z, values[order] / values.sum()


@pytest.mark.parametrize("size", [3, 20])
def test_rows_equal_plain_arithmetic(spark, size):
    rng = np.random.default_rng(size)
    vectors = rng.normal(0, 0.4, (200, size)) @ np.diag(np.linspace(1, 3, size))
    vectors = np.vstack([vectors, vectors[:20]]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    odd = [(900, None, 1), (901, [None] + [0.0] * (size - 1), 1), (902, [math.inf] * size, 1), (903, [math.nan] * size, 1),
           (904, [0.5], 1), (905, [], 1), (906, [3e38] * size, 1)]
    found = whitening.whitened_rows(frame(spark, rows + odd)).orderBy("vec_id", "component").collect()
    n, deviation, z, shares = expected(vectors)
    count = min(16, size)
    assert len(found) == len(vectors) * count
    got = np.array([r["whitened"] for r in found]).reshape(-1, count)
    sign = np.sign((got * z).sum(axis=0))
    assert np.abs(got * sign - z).max() < 1e-9
    assert [r["deviation"] for r in found[::count]] == deviation
    assert [r["component"] for r in found[:count]] == list(range(1, count + 1))
    assert {r["n"] for r in found} == {n}
    assert np.allclose([r["explained"] for r in found[:count]], shares, rtol=1e-10)
    assert all(r["identity_error"] < 1e-12 for r in found)


def test_fewer_dimensions_than_components_and_none(spark):
    """A constant dimension has no variance; one distinct vector has none at all."""
    rows = [(i, [0.5, i / 64.0], 0) for i in range(10)]
    assert {r["component"] for r in whitening.whitened_rows(frame(spark, rows)).collect()} == {1}
    assert whitening.whitened_rows(frame(spark, [(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)])).count() == 0
    assert whitening.whitened_rows(frame(spark, [])).count() == 0
    assert whitening.whitened_rows(frame(spark, [(1, None, 0), (2, [], 0)])).count() == 0


def test_large_numbers(spark):
    """Deviations beyond a long are NULL; no row is lost."""
    rows = [(i, [float(i) * 1e15, float(i % 3)], 0) for i in range(20)] + [(99, [0.0, 0.0], 0)]
    found = whitening.whitened_rows(frame(spark, rows)).collect()
    assert len(found) == 21 * 2 and any(r["deviation"] is None for r in found)
    assert all(r["identity_error"] < 1e-6 for r in found)


def test_query(spark, tmp_path):
    rng = np.random.default_rng(8)
    vectors = rng.normal(0, 0.2, (60, 5)).astype(np.float32)
    frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(vectors)]).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = whitening.op12_whitening(spark, str(tmp_path))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert found.count() == 300
