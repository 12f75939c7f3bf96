from __future__ import annotations

from fractions import Fraction

import numpy as np

from snapfold.llm import whitening as wh
from snapfold.llm.queries import op12_whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n long, x string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, "y") for i, v in rows], SCHEMA)


def ints(v):
    return [int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v]


def check(out, rows, components=16, close=1e-7):
    """Every row against an eigendecomposition of the exact covariance."""
    good = [(i, ints(v)) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n))
    good = [(i, x) for i, x in good if len(x) == dim]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    e, vectors = e[::-1], vectors[:, ::-1]
    k = min(components, dim, int((e > 1e-18 * e[0]).sum()))
    while k and e[k - 1] <= 1e-13 * e[0]:
        k -= 1
    got = {}
    for r in out.collect():
        got.setdefault(r.vec_id, []).append(r)
    want = {}
    for i, x in good:
        want.setdefault(i, []).append(x)
    assert set(got) == set(want)
    signs = np.zeros(k)
    for i, xs in want.items():
        assert sorted(r.component for r in got[i]) == sorted(list(range(1, k + 1)) * len(xs))
        exact = sorted(sum((n * c - s) ** 2 for c, s in zip(x, sums)) for x in xs for _ in range(k))
        assert sorted(r.deviation for r in got[i]) == exact
        if len(xs) > 1:
            continue
        y = np.array([float(Fraction(n * c - s, n)) for c, s in zip(xs[0], sums)]) @ vectors[:, :k] / np.sqrt(e[:k])
        for r in got[i]:
            j = r.component - 1
            if signs[j] == 0 and abs(y[j]) > 1e-3:
                signs[j] = np.sign(r.whitened * y[j])
            assert abs(r.whitened * (signs[j] or 1) - y[j]) <= close * max(1, abs(y[j])) or abs(y[j]) <= 1e-3
            assert r.n == n and abs(r.explained / (e[j] / e.sum()) - 1) < 1e-9 and r.identity_error < 1e-8
    return n


def test_against_an_eigendecomposition(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.standard_normal(24) * np.linspace(0.2, 3, 24)).astype(np.float32).tolist()) for k in range(400)]
    rows += [(1000 + k, rows[7][1]) for k in range(200)]                      # one common vector: once in the fit list
    rows += [(5, rows[5][1]), (None, rows[6][1]), (2000, None), (2001, [float("nan")] * 24), (2002, [None] * 24),
             (2003, [float("inf")] * 24), (2004, [1.0] * 7), (2005, [])]
    assert check(wh.whiten(frame(spark, rows)), rows) == 400


def test_low_rank_and_repeated_deviations(spark):
    """Fewer distinct directions than dimensions; and a cube's corners, whose deviations are all equal."""
    rng = np.random.default_rng(3)
    base = rng.integers(-3, 4, (3, 20))
    rows = [(k, (rng.integers(-4, 5, 3) @ base / 4).astype(np.float32).tolist()) for k in range(60)]
    out = wh.whiten(frame(spark, rows))
    assert {r.component for r in out.collect()} == {1, 2, 3}
    check(out, rows)
    cube = [(k, [float(k >> b & 1) for b in range(5)]) for k in range(32)]
    got = wh.whiten(frame(spark, cube)).collect()
    assert len(got) == 32 * 5 and all(abs(r.explained - 0.2) < 1e-12 and r.identity_error < 1e-12 for r in got)
    squares = {}
    for r in got:
        squares[r.vec_id] = squares.get(r.vec_id, 0) + r.whitened ** 2
    assert all(abs(s - 5) < 1e-9 for s in squares.values())


def test_tables_without_components(spark):
    assert wh.whiten(frame(spark, [])).count() == 0
    assert wh.whiten(frame(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert wh.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(op12_whitening(spark, sf), rows, close=1e-5)


def test_deviations_beyond_a_long():
    whole, r = np.array([[3, -4], [1 << 40, 0]]), np.array([1, 0])
    assert wh.squared_deviation(whole, r, 10).tolist() == [29 ** 2 + 40 ** 2, wh.LONG]
    assert wh.squared_deviation(whole[:1], r, 10).tolist() == [29 ** 2 + 40 ** 2]


def test_bidiagonalisation_alone():
    """Beyond FULL dimensions it stops once the wanted ones have settled."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 60)) * 0.7 ** np.arange(60)
    scans = []

    def there_and_back(h):
        scans.append(1)
        p = x @ h
        return x.T @ p, float(p @ p)
    _, exact, right = np.linalg.svd(x)
    for full in (60, 10):
        scans.clear()
        sigma, vectors = wh.bidiagonalise(there_and_back, 60, 4, full)
        assert np.allclose(sigma[:4], exact[:4], rtol=1e-12)
        assert np.allclose(np.abs((vectors[:, :4] * right[:4].T).sum(axis=0)), 1, atol=1e-12)
    assert len(scans) < 60
