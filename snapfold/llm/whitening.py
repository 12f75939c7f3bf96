"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The fit list X (distinct vectors in whole numbers, centred) stays distributed. Each step
multiplies it by a short vector and its transpose by the long result: one scan, in which
a task takes its rows' Xh and adds up their XᵀXh, so that only short vectors reach the
driver. The steps build X V = U B with V and U orthonormal and B upper bidiagonal; both
sides are fully reorthogonalised, twice: V directly, U through its generators (u = X g,
so Uᵀ(Xh) = Gᵀ(XᵀXh), all short). The singular values and right vectors of the small B then
give the components and their deviations.

Where the Krylov space closes before all dimensions are found (repeated or zero
deviations), it goes on from a new vector orthogonal to V. Vectors of at most FULL
dimensions are taken to the end; longer ones until the residuals of the components asked
for are below double precision, which can miss a component whose deviation is repeated
exactly.

Defined results: rows whose vector is null or holds null or non-finite entries are
dropped; so are vectors of another length than the commonest. Scaled entries are held to
+-2^40. Components without deviation (of fewer distinct vectors than dimensions) are left
out. A squared deviation that doesn't fit a long is the largest long. Repeated rows give
repeated rows; null ids are kept; other columns are ignored. Signs are chosen so that a
component's largest entry is positive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import commonest_length, finite, matrix_of, store

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
HELD = float(1 << 40)           # scaled entries beyond are held there
FULL = 128                      # dimensions that are always bidiagonalised to the end
CLOSED = 1e-12                  # of the largest step: where the Krylov space closes
NONE = 1e-10                    # of the largest deviation: what counts as none
LONG = (1 << 63) - 1
ROWS = 4096                     # rows multiplied at once


class FitList:
    """The distinct vectors, stored, with what centring them takes: n, the sums S = n q + r."""

    def __init__(self, rows: DataFrame, dim: int):
        self.dim = dim
        self.rows = store(rows.select("x").distinct(), "fit-list")
        sc = rows.sparkSession.sparkContext
        # a task for each of a few times the cluster's cores: each gives one short row
        self.dealt = self.rows.coalesce(max(4 * sc.defaultParallelism, 8))

        def run(batches):
            n, total = 0, [0] * dim
            for batch in batches:
                x = matrix_ints(batch.column("x"), dim)
                n += len(x)
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([list(map(str, total))])], names=["n", "total"])
        got = self.dealt.mapInArrow(run, "n long, total array<string>").collect()
        self.n = sum(r["n"] for r in got)
        self.sums = [sum(int(r["total"][k]) for r in got) for k in range(dim)]
        self.q = np.array([s // max(1, self.n) for s in self.sums], dtype=np.int64)
        self.r = np.array([s % max(1, self.n) for s in self.sums], dtype=np.int64)

    def centre(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part exactly, then the rest."""
        return (x - self.q) - self.r / self.n

    def added(self, f, size: int) -> np.ndarray:
        """The sum over all rows of ``f(centred rows) -> size numbers``, one scan."""
        dim, q, rest = self.dim, self.q, self.r / self.n

        def run(batches):
            total = np.zeros(size)
            for batch in batches:
                x = (matrix_ints(batch.column("x"), dim) - q) - rest
                for at in range(0, len(x), ROWS):
                    total += f(x[at:at + ROWS])
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])
        parts = self.dealt.mapInArrow(run, "total binary").collect()
        return np.sum([np.frombuffer(r["total"]) for r in parts], axis=0)

    def there_and_back(self, h: np.ndarray) -> tuple[np.ndarray, float]:
        """(XᵀXh, the squared length of Xh)."""
        dim = self.dim

        def f(x):
            p = x @ h
            return np.append(x.T @ p, p @ p)
        got = self.added(f, dim + 1)
        return got[:dim], float(got[dim])


def matrix_ints(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _orthogonal(w: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    if basis:
        b = np.array(basis)
        for _ in range(2):
            w = w - b.T @ (b @ w)
    return w


def _fresh(basis: list[np.ndarray], dim: int, rng) -> np.ndarray:
    w = _orthogonal(rng.standard_normal(dim), basis)
    return w / np.linalg.norm(w)


def bidiagonalise(there_and_back, dim: int, wanted: int, full: int = FULL) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, falling; right singular vectors as columns) of the matrix behind
    ``there_and_back``: all of them, or at least the ``wanted`` first."""
    rng = np.random.default_rng(dim)
    v, g, beta, scale = _fresh([], dim, rng), np.zeros(dim), 0.0, 0.0
    vs: list[np.ndarray] = []
    gs: list[np.ndarray] = []                       # of each u there is: u = X g
    ts: list[np.ndarray] = []                       # and its Xᵀu
    alphas: list[float] = []
    betas: list[float] = []
    while True:
        h = v - beta * g
        back, length = there_and_back(h)
        if gs:                                      # u against all before it, through G and XᵀU
            made, seen, before = np.array(gs), np.array(ts), length
            for _ in range(2):
                off = made @ back
                h, back, length = h - off @ made, back - off @ seen, length - off @ off
            if length < before / 2:                 # much was taken off: measured anew
                back, length = there_and_back(h)
        alpha = float(np.sqrt(max(length, 0.0)))
        scale = max(scale, alpha)
        vs.append(v)
        if alpha <= CLOSED * scale:                 # no u of its own: a row of zeros
            alpha, g, w = 0.0, np.zeros(dim), np.zeros(dim)
        else:
            g, w = h / alpha, back / alpha
            gs.append(g)
            ts.append(w)
        alphas.append(alpha)
        w = _orthogonal(w - alpha * v, vs)
        beta = float(np.linalg.norm(w))
        b = np.diag(alphas) + np.diag(betas, 1)
        if len(vs) == dim:
            break
        if beta <= CLOSED * scale:
            beta, v = 0.0, _fresh(vs, dim, rng)
        else:
            v = w / beta
            if dim > full and len(vs) >= 2 * wanted and _settled(b, beta, wanted):
                break
        betas.append(beta)
    _, sigma, right = np.linalg.svd(b)
    return sigma, np.array(vs).T @ right.T


def _settled(b: np.ndarray, beta: float, wanted: int) -> bool:
    left, sigma, _ = np.linalg.svd(b)
    e = sigma * sigma
    gaps = np.minimum(np.append(np.inf, -np.diff(e)), np.append(-np.diff(e), np.inf))[:wanted]
    return bool((beta * np.abs(left[-1, :wanted]) * sigma[:wanted] <= 1e-15 * np.maximum(gaps, CLOSED * e[0])).all())


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each
    kept vector and each of the first ``components`` components."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(finite(F.col("vec")))
    dim = commonest_length(rows, "vec")
    out = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if not dim:
        return spark.createDataFrame([], out)
    held = lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(HELD)), F.lit(-HELD))).cast("long") + OFFSET
    rows = rows.filter(F.size("vec") == dim).select("vec_id", F.transform("vec", held).alias("x"))
    fit = FitList(rows, dim)
    sigma, right = bidiagonalise(fit.there_and_back, dim, components)
    trace = float(fit.added(lambda x: np.array([(x * x).sum()]), 1)[0])
    there = int((sigma > NONE * sigma[0]).sum()) if sigma[0] > 0 else 0
    k = min(components, there, dim)
    if not k:
        return spark.createDataFrame([], out)
    right = right[:, :k] * np.sign(right[np.abs(right[:, :k]).argmax(axis=0), np.arange(k)])
    white = right / (sigma[:k] / np.sqrt(fit.n))                   # a centred row times this is whitened
    explained = sigma[:k] ** 2 / trace

    def products(x):
        y = x @ white
        return np.append((y.T @ y).ravel(), y.sum(axis=0))
    got = fit.added(products, k * k + k) / fit.n
    mean = got[k * k:]
    error = float(np.abs(got[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
    n, q, r = fit.n, fit.q, fit.r

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                x = matrix_ints(some.column("x"), dim)
                m = len(x)
                y = ((x - q) - r / n) @ white
                yield pa.RecordBatch.from_arrays(
                    [some.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     pa.array(np.repeat(squared_deviation(x - q, r, n), k)), pa.array(y.ravel()),
                     pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, out)


def squared_deviation(whole: np.ndarray, r: np.ndarray, n: int) -> np.ndarray:
    """The sum over dimensions of (n x - S)^2 = (n (x - q) - r)^2, exact; at most LONG."""
    most = n * (int(np.abs(whole).max(initial=0)) + 1)
    if most * most * whole.shape[1] <= LONG:
        off = n * whole - r
        return (off * off).sum(axis=1)
    rest = [int(x) for x in r]
    return np.array([min(LONG, sum((n * int(a) - b) ** 2 for a, b in zip(row, rest))) for row in whole], dtype=np.int64)
