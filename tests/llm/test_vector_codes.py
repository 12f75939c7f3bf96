from __future__ import annotations

import hashlib

import numpy as np
import pytest

from snapfold.llm import vector_codes as vc
from snapfold.llm.queries import op11_vector_codes

SCHEMA = "vec_id long, embedding array<float>, label string, code string, error long, n long, p int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2, 3) for i, v, label in rows], SCHEMA)


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """((vec_id, code, error, label_error) sorted, digest) with Python's integers."""
    good = [(i, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    lengths = [len(v) for _, v, _ in good if v and len(v) % parts == 0]
    dim = max(set(lengths), key=lambda n: (lengths.count(n), n))
    good = sorted((r for r in good if len(r[1]) == dim), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = dim // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in good]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, g in zip(cut, got) if g[p][1] == k]
                if mine:
                    books[p][k] = tuple(sum(x) // len(mine) for x in zip(*mine))
    last = assign()
    out = [(r[0], "".join(f"{k:02x}" for _, k in g), sum(d for d, _ in g), r[2]) for r, g in zip(good, last)]
    of = {}
    for _, _, e, label in out:
        of[label] = of.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, of[label]) for i, c, e, label in out), key=str), digest


def shown(found):
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in found.collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vc, "SLICE_VALUES", 32 * 70)            # several slices, with blocks that aren't full
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((7, 32)) * 0.3
    rows = [(int(i), (centres[i % 7] + 0.1 * rng.standard_normal(32)).astype(np.float32).tolist(), None if i % 5 == 0 else f"l{i % 3}")
            for i in rng.permutation(300)]
    rows += [(k, rows[3][1], "l1") for k in range(900, 960)]    # one common vector
    rows += [(5, rows[9][1], "l0"), (5, rows[9][1], "l0"), (None, rows[1][1], None), (None, rows[2][1], "l2"), (-3, [0.0] * 32, "l1"),
             (700, None, "l0"), (701, [float("nan")] + [0.0] * 31, "l0"), (702, [None] * 32, "l0"),
             (703, [float("inf")] + [0.0] * 31, "l0"), (704, [1.0] * 16, "l0"), (705, [], "l0"), (706, [1.0] * 5, "l0")]
    found, books = vc.compress(frame(spark, rows))
    want, digest = brute(rows)
    assert shown(found) == want and vc.books_sha256(books) == digest
    assert found.columns == ["vec_id", "label", "code", "error", "label_error"]


def test_few_vectors_and_other_parameters(spark):
    rows = [(k, [k * 0.25, -k * 0.5, 1.0, 3.0, -0.001, 0.001], None) for k in range(5)]
    found, books = vc.compress(frame(spark, rows), parts=2, entries=3, rounds=1, scale=10)
    assert books.shape == (2, 3, 3) and (shown(found), vc.books_sha256(books)) == brute(rows, 2, 3, 1, 10)


def test_empty_table(spark):
    found, books = vc.compress(frame(spark, []))
    assert found.count() == 0 and books.size == 0 and "label" in found.columns
    assert vc.compress(frame(spark, [(1, None, "a"), (2, [1.0], "b")]))[0].count() == 0


def test_huge_components_are_held(spark):
    found, _ = vc.compress(frame(spark, [(1, [3e38] * 16, "a"), (2, [-3e38] * 16, "a"), (3, [0.0] * 16, "a")]))
    assert [r.error for r in found.collect()] == [0, 0, 0]      # each is an entry of its own
    most = vc.limit(16)
    assert 16 * (2 * most) ** 2 <= vc.LONG < 16 * (2 * most + 4) ** 2


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    out = op11_vector_codes(spark, sf)
    want, digest = brute(rows)
    assert shown(out) == want and {r.codebooks_sha256 for r in out.collect()} == {digest}


def test_shortlists_lose_no_nearest_entry():
    rng = np.random.default_rng(3)
    for width in (1, 4, 9):
        parts = rng.integers(-40, 40, (500, width))
        entries = rng.integers(-40, 40, (30, width))
        s = vc.Slice.of(parts, 1)
        assert sorted(map(tuple, s.parts[0])) == sorted(map(tuple, parts))
        chosen, far, alone = vc.nearest(entries, s.parts[0], s.low[0], s.high[0], settle=False)
        all_far = ((s.parts[0][:, None] - entries[None]) ** 2).sum(axis=2)
        assert (chosen == all_far.argmin(axis=1)).all() and (far == all_far.min(axis=1)).all()
        count, total = np.zeros((1, 30), dtype=np.int64), np.zeros((1, 30, width), dtype=np.int64)
        vc.tally(s, entries[None], count, total)
        assert (count[0] == np.bincount(chosen, minlength=30)).all()
        for k in range(30):
            assert (total[0, k] == s.parts[0][chosen == k].sum(axis=0)).all()


@pytest.mark.parametrize("width, bits", [(1, 5), (2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_goes_by_neighbours(width, bits):
    points = np.array(np.meshgrid(*[np.arange(1 << bits)] * width)).reshape(width, -1).T
    keys = vc.hilbert_keys(points, bits)
    assert sorted(keys.tolist()) == list(range(len(points)))
    along = points[np.argsort(keys)]
    assert (np.abs(np.diff(along, axis=0)).sum(axis=1) == 1).all()
