"""Whitening: exact sums and polynomials, roots, components and whole results against numpy and plain integers."""

import random
from fractions import Fraction

import numpy as np
import pytest

from shelfwise.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def _scatter(rows):
    x = [[int(np.floor(64 * float(c))) for c in r] for r in rows]
    n, width = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(width)]
    return n, sums, [[n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(width)] for i in range(width)]


def _determinant(m):
    m, out = [[Fraction(v) for v in r] for r in m], Fraction(1)
    for k in range(len(m)):
        best = next((i for i in range(k, len(m)) if m[i][k]), None)
        if best is None:
            return Fraction(0)
        if best != k:
            m[k], m[best], out = m[best], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k])]
    return out


def test_scatter_is_exact(spark):
    draw = random.Random(1)
    for scale in (1.0, 1e9, 1e14):
        rows = [[draw.gauss(3, 1) * scale for _ in range(4)] for _ in range(60)]
        frame = spark.createDataFrame([(r,) for r in rows], "vector array<double>").repartition(5)
        assert whitening.exact_scatter(frame, 4) == _scatter(rows)


def test_polynomial_equals_determinants(spark):
    draw = random.Random(4)
    for width, rank in ((1, 1), (2, 2), (5, 5), (6, 3), (7, 1)):
        half = [[draw.randint(-900, 900) for _ in range(width)] for _ in range(rank)]
        a = [[sum(r[i] * r[j] for r in half) for j in range(width)] for i in range(width)]
        found = whitening.characteristic_polynomial(spark, a)
        assert found[0] == 1 and len(found) == width + 1
        for at in range(-3, width):
            value = sum(c * at ** (width - k) for k, c in enumerate(found))
            assert value == _determinant([[at * (i == j) - a[i][j] for j in range(width)] for i in range(width)])
    # A matrix that needs row swaps on the way.
    swap = np.array([[2, 0, 5, 1], [0, 3, 0, 7], [5, 0, 4, 0], [1, 7, 0, 6]], np.int64)
    p = (1 << 31) - 1
    want = np.round(np.poly(swap.astype(float))).astype(int).tolist()
    assert whitening.polynomial_modulo(swap, p).tolist() == [c % p for c in want]


def _from_roots(roots):
    out = [1]
    for r in roots:
        out = [a - r * b for a, b in zip([*out, 0], [0, *out])]
    return out


def test_roots_are_counted_isolated_and_merged():
    roots = [10**12, 10**12 - 1, 500, 500, 500, 7, 0, 0]
    poly = _from_roots(roots)
    assert [whitening.roots_above(poly, t, 0) for t in (-1, 0, 6, 7, 499, 500, 10**12 - 1, 10**12)] == [8, 6, 6, 5, 5, 2, 1, 0]
    assert whitening.roots_above(poly, 13, 1) == 6 and whitening.roots_above(poly, 15, 1) == 5
    found = [whitening.isolated_root(poly, k, sum(roots) + 1) for k in range(1, 9)]
    assert [f[2:] for f in found] == [(1, 1), (2, 2), (3, 5), (3, 5), (3, 5), (6, 6), (7, 8), (7, 8)]
    for (numerator, bits, _, _), root in zip(found, roots):
        assert abs(Fraction(numerator, 1 << bits) - root) <= Fraction(1, 1 << 200)


def test_null_space_of_close_and_equal_roots():
    # Two roots a few parts in 10^40 apart: double precision cannot tell them, the components still are the axes' mix.
    big = 10**40
    a = [[big, 1, 0], [1, big, 0], [0, 0, 5]]
    poly = _from_roots([big + 1, big - 1, 5])
    for k, want in ((1, [1, 1, 0]), (2, [1, -1, 0]), (3, [0, 0, 1])):
        numerator, bits, first, last = whitening.isolated_root(poly, k, 2 * big + 6)
        [v] = whitening.null_space(a, numerator, bits, last - first + 1)
        assert min(np.abs(v - s * np.array(want) / np.linalg.norm(want)).max() for s in (1, -1)) < 1e-15
    same = whitening.null_space([[4, 0, 0], [0, 4, 0], [0, 0, 1]], 4, 0, 2)
    assert np.allclose(same @ same.T, np.eye(2), atol=1e-15) and np.abs(same[:, 2]).max() < 1e-15


def _check(out, rows, most=32):
    """Whole results against numpy's eigenvectors."""
    n, sums, a = _scatter([r for _, r in rows])
    width, exact = len(sums), np.array(a, object)
    values, vectors = np.linalg.eigh(exact.astype(float))
    order = np.argsort(-values)[:most]
    x = np.array([[np.floor(64 * float(c)) for c in r] for _, r in rows])
    centred = x - np.array(sums) / n
    by = {}
    for r in out:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(out) == n * min(width, most) and {r.n for r in out} == {n}
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9
    trace = sum(a[i][i] for i in range(width))
    for c, k in enumerate(order, start=1):
        if values[k] < 1e-9 * values[order[0]]:
            assert all(by[i][c].whitened is None for i, _ in rows)
            continue
        want = centred @ vectors[:, k] / np.sqrt(values[k]) * n
        got = np.array([by[i][c].whitened for i, _ in rows])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-7
        assert abs(by[rows[0][0]][c].explained / (values[k] / trace) - 1) < 1e-9
    for (i, r) in rows:
        gap = [n * int(np.floor(64 * float(c))) - s for c, s in zip(r, sums)]
        assert by[i][1].deviation == sum(g * g for g in gap)


@pytest.mark.parametrize("width,count", [(1, 5), (3, 40), (40, 300)])
def test_whitening_equals_numpy(spark, width, count):
    draw = np.random.default_rng(width)
    rows = [(i, [float(np.float32(v)) for v in draw.normal(size=width) * np.linspace(1, 3, width)]) for i in range(count)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    _check(out, rows)


def test_query_on_a_table(spark, folder):
    from shelfwise.llm.queries import QUERIES

    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    _check(QUERIES["op12_whitening"](spark, folder).collect(), [(r.vec_id, list(r.embedding)) for r in table])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (None, [0.5, -2.0, 9.0]), (4, [7.0, 1.0, 3.0])]
    bad = [(5, None), (6, [1.0, None, 2.0]), (7, [nan, 1.0, 2.0]), (8, [1.0, inf, 2.0]), (9, [1.0]), (10, [])]
    frame = spark.createDataFrame([(*r, "x", 9) for r in good + bad], SCHEMA + ", component string, n int")
    out = whitening.whiten(frame).collect()
    assert sorted((r.vec_id or 0, r.component) for r in out) == sorted((i or 0, c) for i, _ in good for c in (1, 2, 3))
    # Three different rows span two dimensions; the third component has no variance.
    assert {r.component: r.whitened is None for r in out} == {1: False, 2: False, 3: True}
    assert max(abs(r.explained) for r in out if r.component == 3) == 0 and out[0].identity_error < 1e-12
    alone = whitening.whiten(spark.createDataFrame([(3, [1.0, 2.0])], SCHEMA)).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alone] == [
        (1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
    for none in (frame.limit(0), spark.createDataFrame(bad[:1] + bad[-1:], SCHEMA)):
        assert whitening.whiten(none).collect() == []
    huge = whitening.whiten(spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [5.0, 4.0])], SCHEMA)).collect()
    assert {r.vec_id for r in huge if r.deviation is None} == {1, 2} and huge[0].identity_error < 1e-6
