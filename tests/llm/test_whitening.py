"""Whitening against numpy, and the exact steps against direct computation."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from tallyforge.llm import exact_spectrum, whitening
from tallyforge.llm.exact_spectrum import FRACTION_BITS, characteristic_polynomial, largest_roots, null_vectors
from tallyforge.llm.tables import table
from tallyforge.llm.whitening import exact_products, limbs, whiten
from tests.conftest import DATA

SCHEMA = "vec_id long, embedding array<float>, label int, key string, x string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 0, "clash", "clash") for i, v in zip(ids, vectors)], SCHEMA).repartition(3)


def expected(vectors, components=16):
    """Deviation, whitened values and explained shares by numpy."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, base = np.linalg.eigh(centred.T @ centred / n)
    values, base = values[::-1][:components], base[:, ::-1][:, :components]
    return n, ((n * x - sums) ** 2).sum(1), (x - sums / n) @ base / np.sqrt(values), values / np.var(fit, 0).sum()


def compare(rows, vectors):
    n, deviation, white, explained = expected(vectors)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == white.size
    found = np.array([[got[i, c + 1]["whitened"] for c in range(white.shape[1])] for i in range(len(vectors))])
    signs = np.sign((found * white).sum(0))
    assert np.abs(found * signs - white).max() < 1e-9
    assert all(got[i, 1]["deviation"] == deviation[i] for i in range(len(vectors)))
    assert np.allclose([got[0, c + 1]["explained"] for c in range(white.shape[1])], explained, rtol=1e-10)
    assert {r["n"] for r in rows} == {n} and max(r["identity_error"] for r in rows) < 1e-9


def test_embeddings_against_numpy(spark):
    given = table(spark, DATA, "embeddings")
    vectors = [r["embedding"] for r in given.orderBy("vec_id").collect()]
    rows = whiten(given).collect()
    assert [r["vec_id"] for r in given.orderBy("vec_id").collect()] == list(range(len(vectors)))
    compare(rows, vectors)


def test_odd_rows_are_left_out_and_copies_count_once(spark):
    draw = np.random.default_rng(3)
    vectors = [[float(np.float32(v)) for v in row] for row in draw.normal(0, 3, (60, 5))]
    vectors += [vectors[0]] * 40
    odd = [None, [], [1.0] * 4, [None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0],
           [3e38, 0.0, 0.0, 0.0, 0.0]]
    ids = [*range(len(vectors)), *range(1000, 1000 + len(odd))]
    compare(whiten(frame(spark, vectors + odd, ids)).collect(), vectors)


def test_repeated_roots_give_an_orthonormal_basis(spark):
    """Corners of a box: all variances agree."""
    corners = [[float(i >> b & 1) for b in range(4)] for i in range(16)]
    rows = whiten(frame(spark, corners)).collect()
    assert max(r["identity_error"] for r in rows) < 1e-12
    assert {round(r["explained"], 12) for r in rows} == {0.25}
    lengths = {i: sum(r["whitened"] ** 2 for r in rows if r["vec_id"] == i) for i in range(16)}
    assert all(abs(v - 4) < 1e-9 for v in lengths.values())


def test_no_variance_single_and_empty(spark):
    one = whiten(frame(spark, [[1.0, 2.0]] * 3, [5, 5, None])).collect()
    assert len(one) == 6 and all(r["whitened"] is None and r["explained"] is None and r["n"] == 1 for r in one)
    assert {r["deviation"] for r in one} == {0}
    flat = whiten(frame(spark, [[0.0, 1.0], [1.0, 1.0], [2.0, 1.0]])).collect()
    assert {(r["component"], r["whitened"] is None, r["explained"]) for r in flat} == {(1, False, 1.0), (2, True, 0.0)}
    for nothing in ([], [None], [[]]):
        empty = whiten(frame(spark, nothing) if nothing else frame(spark, [[1.0]]).limit(0))
        assert empty.collect() == [] and empty.columns[0] == "vec_id"
    with pytest.raises(ValueError, match="at most"):
        exact_spectrum.largest_components(spark, [[0] * 513] * 513, 1)


def test_large_entries_stay_exact(spark):
    draw = np.random.default_rng(4)
    x = draw.integers(-(1 << 61), 1 << 61, (37, 3))
    wide = x.astype(object)
    assert (exact_products(x) == wide.T @ wide).all()
    for value in (0, -1, 5, -(1 << 40), (1 << 40) - 1, 1 << 40, -(1 << 130) + 7):
        assert sum(part << (40 * place) for place, part in limbs(value)) == value
    vectors = [[float(v) for v in np.float32(row)] for row in draw.normal(0, 1e12, (20, 3))]
    rows = whiten(frame(spark, vectors)).collect()
    assert max(r["identity_error"] for r in rows) < 1e-9
    exact = [[int(np.floor(64 * v)) for v in row] for row in vectors]
    sums = [sum(c) for c in zip(*exact)]
    deviation = {i: sum((20 * v - s) ** 2 for v, s in zip(row, sums)) for i, row in enumerate(exact)}
    assert all(r["deviation"] is None and deviation[r["vec_id"]] >= 1 << 63 for r in rows)


def test_polynomial_and_roots(spark):
    # Blocks with known roots: 1 and 3, 5 twice, 0.
    matrix = [[2, 1, 0, 0, 0], [1, 2, 0, 0, 0], [0, 0, 5, 0, 0], [0, 0, 0, 5, 0], [0, 0, 0, 0, 0]]
    polynomial = characteristic_polynomial(spark, matrix)
    want = [1]
    for root in (1, 3, 5, 5, 0):
        want = [a - root * b for a, b in zip([0, *want], [*want, 0])]
    assert polynomial == want
    scale = 1 << FRACTION_BITS
    assert largest_roots(polynomial, 5) == [(5 * scale, 2), (3 * scale, 1), (scale, 1), (0, 1)]
    assert largest_roots(polynomial, 1) == [(5 * scale, 2)]
    vectors = np.array(null_vectors(matrix, 5 * scale, FRACTION_BITS, 2))
    assert np.allclose(vectors @ vectors.T, np.eye(2)) and np.allclose(vectors @ np.array(matrix), 5 * vectors)


def test_close_roots_are_told_apart(spark):
    """Two roots that agree in the first 50 bits."""
    big = 1 << 60
    matrix = [[big, 0, 0], [0, big + 512, 3], [0, 3, 7]]
    found = exact_spectrum.largest_components(spark, matrix, 3)
    assert np.allclose(np.abs([v for _, v in found]), [[0, 1, 0], [1, 0, 0], [0, 0, 1]], atol=1e-12)
    assert sum(Fraction(r, 1 << FRACTION_BITS) for r, _ in found) == pytest.approx(2 * big + 519)
    assert whitening.GRID == 64
