"""Whitening against numpy's eigenvectors of the exact covariance."""

import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from formfold.llm import queries, whitening
from tests.conftest import SMALL

DDL = "vec_id long, embedding array<float>, n int, y int, component int"


def plain_rows(vectors, scale=64, shift=1_000_000):
    """(vec_id, x) of the rows that take part, x as Python integers."""
    out, dims = [], max((len(v) for _, v in vectors if v is not None), default=0)
    for i, v in vectors:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            entries = [float(np.float32(c)) for c in v] + [0.0] * (dims - len(v))
            out.append((i, tuple(math.floor(c * scale) + shift for c in entries)))
    return out


def plain(vectors, components=16):
    """n, sums, covariance (exactly rounded) and the deviation of each row."""
    rows = plain_rows(vectors)
    fit = sorted({x for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = [[n * a - s for a, s in zip(x, sums)] for x in fit]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in z), n ** 3)) for j in range(len(sums))] for i in range(len(sums))])
    deviations = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in rows]
    return n, sums, v, rows, deviations


def agrees(out, vectors, components=16):
    n, sums, v, rows, deviations = plain(vectors)
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(components, int((values > values[0] * 1e-10).sum()))
    assert len(out) == len(rows) * k and {r.n for r in out} == {n}
    assert sorted((r.vec_id or -1, int(r.deviation)) for r in out if r.component == 1) == sorted((i or -1, d) for i, d in deviations)
    for j in range(1, k + 1):
        some = [r for r in out if r.component == j]
        assert np.allclose([r.explained for r in some], values[j - 1] / np.trace(v), rtol=1e-7)
    assert {r.identity_error for r in out} and max(r.identity_error for r in out) < 1e-9
    return values


def matched(out, vectors):
    """Whitened coordinates against eigh, up to a sign, where eigenvalues are apart."""
    n, sums, v, rows, _ = plain(vectors)
    values, basis = np.linalg.eigh(v)
    z = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for _, x in rows])
    for j in range(1, max(r.component for r in out) + 1):
        expected = np.sort(z @ basis[:, -j] / math.sqrt(values[-j]))
        got = np.sort([r.whitened for r in out if r.component == j])
        assert np.allclose(got, expected, atol=1e-6) or np.allclose(got, np.sort(-expected), atol=1e-6)


def frame(spark, rows):
    floats = [(i, v and [c if c is None else float(c) for c in v], 1, 2, 3) for i, v in rows]
    return spark.createDataFrame(floats, DDL).repartition(4)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    some = [(i, [float(x) for x in rng.normal(size=5) * [1, 2, 3, 4, 5]]) for i in range(60)]
    odd = [(100, None), (101, [1.0, None, 0, 0, 0]), (102, [float("nan")] * 5), (103, [float("inf"), 0, 0, 0, 0]),
           (104, [0.0] * 5), (None, [1.0, 2.0, 3.0, 4.0, 5.0]), (105, [1.0, 2.0, 3.0]), (106, []), (107, [1e4, -3e5, 1.0, 0.0, 2.0])]
    vectors = some + odd + some[:7] + [(200 + i, some[0][1]) for i in range(80)]
    out = whitening.whiten(frame(spark, vectors)).collect()
    agrees(out, vectors)
    matched(out, vectors)


def test_tables_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(frame(spark, rows)).collect() == []


def test_fewer_vectors_than_dimensions(spark):
    rng = np.random.default_rng(8)
    vectors = [(i, [float(x) for x in rng.normal(size=7)] + [0.5]) for i in range(4)]
    out = whitening.whiten(frame(spark, vectors)).collect()
    assert max(r.component for r in out) == 3
    agrees(out, vectors)
    matched(out, vectors)


def test_equal_eigenvalues(spark):
    """Corners of a box with two equal pairs of sides: every basis of their planes is right."""
    vectors = [(i, [2.0 * (1 if i & 1 else -1), 2.0 * (1 if i & 2 else -1), 1.0 * (1 if i & 4 else -1), 1.0 * (1 if i & 8 else -1)])
               for i in range(16)]
    out = whitening.whiten(frame(spark, vectors), components=3).collect()
    values = agrees(out, vectors, 3)
    assert np.allclose(values[:2], values[0])


def test_large_entries(spark):
    """Products beyond 64 bits stay exact."""
    vectors = [(i, [float(np.float32(1e15 * (i % 3))), float(i), float(np.float32(-7e12 * (i % 5)))]) for i in range(12)]
    out = whitening.whiten(frame(spark, vectors)).collect()
    n, _, _, _, deviations = plain(vectors)
    assert sorted((r.vec_id, int(r.deviation)) for r in out if r.component == 1) == sorted(deviations)


@pytest.mark.parametrize("d", [1, 2, 3, 8])
def test_characteristic_polynomial(spark, d):
    rng = np.random.default_rng(d)
    a = rng.integers(-9, 9, (d, d + 2)).astype(object)
    c = a @ a.T
    exact, m = [1], np.zeros((d, d), object)
    for k in range(1, d + 1):  # Faddeev and LeVerrier, in integers
        m = c @ m + exact[-1] * np.eye(d, dtype=int).astype(object)
        exact.append(-int(np.trace(c @ m)) // k)
    found = whitening.characteristic(spark, c)
    assert found == exact
    roots = whitening.largest_roots(found, int(np.trace(c)), d, 100)
    assert np.allclose([float(r) for r, m in roots for _ in range(m)], np.sort(np.linalg.eigvalsh(c.astype(float)))[::-1])


def test_zeros_below_the_diagonal(spark):
    c = np.diag([5, 5, 0, 2, 5]).astype(object)
    found = whitening.characteristic(spark, c)
    assert found == [1, -17, 105, -275, 250, 0]
    assert [(float(r), m) for r, m in whitening.largest_roots(found, 17, 5, 60)] == [(5.0, 3), (2.0, 1)]


def test_roots_that_nearly_meet():
    """(t - 3)(t - 3 - 2 ** -90)(t - 1), scaled to integers, and a root that is met exactly."""
    one = 1 << 90
    a, b, c = 3 * one, 3 * one + 1, one
    coefficients = [1, -(a + b + c), a * b + a * c + b * c, -a * b * c]
    assert whitening.largest_roots(coefficients, a + b + c, 3, 120) == [(Fraction(b), 1), (Fraction(a), 1), (Fraction(c), 1)]
    near = whitening.largest_roots(coefficients, a + b + c, 3, 60)
    assert [m for _, m in near] == [2, 1]


def test_query(spark):
    vectors = duckdb.sql(f"SELECT vec_id, embedding FROM '{SMALL}/embeddings.parquet'").fetchall()
    out = queries.queries()["op11_whitening"](spark, SMALL).collect()
    agrees(out, vectors)
    matched(out, vectors)
    assert out[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
