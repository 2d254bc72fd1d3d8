"""Whitening against a dense eigendecomposition of the exact covariance."""
import math
from fractions import Fraction

import numpy as np
import pytest

from panelforge.llm import whitening

VECTORS = "vec_id long, embedding array<float>, label int, x string, rows long, n long"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, 2) for i, v in rows], VECTORS).repartition(5)


def dense(rows, dim, count):
    """Expected n, sums, eigenvalues and whitened values by numpy on the whole table."""
    usable = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in usable], dtype=np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = (n * fit - sums) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    white = ((n * x - sums) / n) @ (axes / np.sqrt(values))
    return n, sums, values, white, [i for i, _ in usable], x, np.trace(c.T @ c / n)


def random_rows(rng, n, dim, decay):
    base = rng.standard_normal((n, dim)) * decay ** np.arange(dim) @ np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    return [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(base)]


@pytest.mark.parametrize("dim,decay,count", [(64, 0.97, 16), (50, 1.0, 16), (8, 0.9, 16)])
def test_equals_dense_eigenvectors(spark, dim, decay, count):
    rng = np.random.default_rng(dim)
    rows = random_rows(rng, 600, dim, decay)
    rows += [(9000 + k, rows[k % 3][1]) for k in range(300)]   # copies count once in the fit
    rows += [(9500, None), (9501, [float("nan")] * dim), (9502, [None] * dim), (9503, []), (9504, [1.0] * (dim + 1)),
             (9505, [float("inf")] + [0.0] * (dim - 1)), (None, rows[5][1]), (7, rows[7][1])]
    n, sums, values, white, ids, x, trace = dense(rows, dim, count)
    got = whitening.whitened_vectors(table_of(spark, rows), count).toPandas()
    count = min(count, dim)
    assert len(got) == len(ids) * count and set(got["n"]) == {n} and got["identity_error"].max() < 1e-10
    assert got.groupby("component").size().tolist() == [len(ids)] * count
    by_id = {}
    for i, w, row in zip(ids, white, x):
        by_id[i] = (w, sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)))
    signs = {}
    for r in got.itertuples():
        w, deviation = by_id[None if math.isnan(r.vec_id) else int(r.vec_id)]
        k = r.component - 1
        assert r.deviation == deviation and r.explained == pytest.approx(values[k] / trace, rel=1e-10)
        sign = signs.setdefault(k, 1 if abs(r.whitened - w[k]) <= abs(r.whitened + w[k]) else -1)
        assert r.whitened == pytest.approx(sign * w[k], abs=1e-8)


def test_leading_pairs_of_repeated_and_missed_values():
    rng = np.random.default_rng(2)
    axes = np.linalg.qr(rng.standard_normal((80, 80)))[0]
    values = np.sort(np.concatenate([[9.0, 9.0, 5.0], rng.random(77)]))[::-1]
    v = (axes * values) @ axes.T
    found, q, residual = whitening.leading_pairs(lambda y: v @ y, 80, 10)
    assert np.allclose(found, values[:10], rtol=1e-12) and residual < 1e-12
    assert np.abs(v @ q - q * found).max() < 1e-11
    probe = whitening._missed(lambda y: v @ y, axes[:, 3:30], values[3:30], 10, rng)
    assert probe is not None   # a block without the leading vectors is found out


def test_fewer_components_than_wanted_and_no_rows(spark):
    flat = [(k, [float(k), 1.0, 2.0 * k]) for k in range(20)]
    got = whitening.whitened_vectors(table_of(spark, flat)).toPandas()
    assert set(got["component"]) == {1} and len(got) == 20 and got["identity_error"].max() < 1e-10
    assert got["explained"].iloc[0] == pytest.approx(1.0)
    assert whitening.whitened_vectors(table_of(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whitened_vectors(table_of(spark, [])).count() == 0
    assert whitening.whitened_vectors(table_of(spark, [(1, None)])).count() == 0


def test_centring_and_deviation_of_large_values():
    x = np.array([[2 ** 40, 5], [2 ** 40 + 1, 7]], np.int64)
    n, sums = 2 ** 24, x.sum(axis=0)
    exact = [[float(Fraction(n * int(a) - int(s), n)) for a, s in zip(r, sums)] for r in x]
    assert np.array_equal(whitening.centred(x, n, sums), exact)
    with pytest.raises(OverflowError):
        whitening.deviations(x, n, sums)
