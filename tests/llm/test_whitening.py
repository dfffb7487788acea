"""Whitening beside numpy, and its exact parts beside plain integer arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from advertlake.llm import whitening
from advertlake.llm.queries import prepared

VECTORS = "vec_id bigint, embedding array<double>, label int, d int, packed string, vector string"


@pytest.fixture(scope="module")
def llm(spark):
    return prepared(spark)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x", "y") for i, v in rows], VECTORS).repartition(3)


def test_whitened_beside_numpy(llm):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 0.2, (300, 6)) @ rng.normal(0, 1, (6, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(400 + i, base[7].tolist()) for i in range(150)]  # a third of all rows are copies
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] + [0.0] * 5),
             (904, [1.0, 2.0]), (905, [1e300] + [0.0] * 5), (None, base[3].tolist())]
    got = whitening.whiten(frame(llm, rows)).toPandas()
    x = np.floor(64 * base).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T, bias=True)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    assert len(got) == (300 + 150 + 1) * 6 and set(got["component"]) == set(range(1, 7))
    kept = got[got["vec_id"] < 300]
    for c in range(6):
        part = kept[kept["component"] == c + 1].sort_values("vec_id")
        assert np.allclose(part["explained"], values[c] / np.trace(v), rtol=1e-12)
        want = (x - s / n) @ vectors[:, c] / math.sqrt(values[c])
        have = part["whitened"].to_numpy()
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-7
        assert (part["deviation"].to_numpy() == ((n * x - s) ** 2).sum(axis=1)).all()
    copies = got[(got["vec_id"] >= 400) & (got["component"] == 1)]["whitened"]
    assert copies.nunique() == 1 and len(copies) == 150


def test_repeated_and_missing_variance(llm):
    # two directions of equal variance, one of none: fewer components, and still the identity
    rows = [(k, [a / 64, b / 64, 0.5]) for k, (a, b) in enumerate([(10, 0), (-10, 0), (0, 10), (0, -10)])]
    got = whitening.whiten(frame(llm, rows)).toPandas()
    assert len(got) == 8 and got["identity_error"].max() < 1e-12 and np.allclose(got["explained"], 0.5)
    for rows in ([], [(1, [0.5, 0.25])], [(1, [0.5]), (2, [0.5])], [(1, [])], [(1, None)]):
        assert whitening.whiten(frame(llm, rows)).count() == 0


def test_very_large_entries_stay_exact(llm):
    rows = [(1, [2.0**50, 3.0]), (2, [-(2.0**50), 5.0]), (3, [7.0, -(2.0**49)])]
    got = whitening.whiten(frame(llm, rows)).toPandas()
    assert len(got) == 6 and got["deviation"].isna().all() and got["identity_error"].max() < 1e-9


@pytest.mark.parametrize("top", [3, 1 << 26, 1 << 61])
def test_gram_is_exact(top):
    rows = np.random.default_rng(top % 97).integers(-top, top, (5000 if top == 3 else 50, 4))
    plain = rows.astype(object)
    assert (whitening.exact_gram(rows) == plain.T @ plain).all()
    parts = [whitening._limbs(int(x)) for x in whitening.exact_gram(rows).ravel()]
    assert [sum(v << (40 * k) for k, v in enumerate(p)) for p in parts] == list(whitening.exact_gram(rows).ravel())


def test_polynomial_and_roots(llm):
    rng = np.random.default_rng(5)
    a = rng.integers(-50, 50, (7, 5)).astype(object)
    matrix = a.T @ a
    poly = whitening.characteristic_polynomial(llm, matrix)
    # Faddeev and LeVerrier with fractions
    m, c = np.zeros((5, 5), object), [0] * 5 + [1]
    for k in range(1, 6):
        m = matrix.dot(m) + c[5 - k + 1] * np.eye(5, dtype=int).astype(object)
        c[5 - k] = Fraction(-int(np.trace(matrix.dot(m))), k)
    assert poly == [int(x) for x in c]
    found = whitening.largest_roots(poly, 5)
    assert np.allclose([float(r) for r, _ in found], np.linalg.eigvalsh(matrix.astype(float))[::-1], rtol=1e-12)
    # (x - 5)^2 (x - 5 - 1/2^40 scaled) is told apart, equal roots are counted
    close = 5 * (1 << 40)
    product = np.array([1], object)
    for r in (close, close, close + 1, 3):
        product = np.convolve(product, np.array([1, -r], object))
    roots = whitening.largest_roots([int(x) for x in product[::-1]], 4)
    assert [m for _, m in roots] == [1, 2, 1] and [round(r) for r, _ in roots] == [close + 1, close, 3]
