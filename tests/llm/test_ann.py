from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from snapfold.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, cid long, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 0.5) for i, v in rows], SCHEMA)


def brute(rows, k=5, every=50):
    good = {i: np.array(v, dtype=np.float64) for i, v in rows if i is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in good.items():
        if q % every:
            continue
        near = sorted((-float(a @ b) / float(np.sqrt(a @ a) * np.sqrt(b @ b)), i) for i, b in good.items()
                      if i != q and len(b) == len(a))
        out[q] = [(i, -s) for s, i in near[:k]]
    return out


def found(out):
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [x[k] for k in sorted(x)] for q, x in got.items()}


def recall(got, want):
    assert set(got) == {q for q, x in want.items() if x}
    hits = 0
    for q, x in got.items():
        assert len(x) == len(want[q]) and [s for _, s in x] == sorted((s for _, s in x), reverse=True)
        scores = dict(x)
        hits += len({i for i, _ in x} & {i for i, _ in want[q]})
        for i, s in want[q]:
            assert i not in scores or abs(scores[i] - s) < 1e-9
    return hits / max(1, sum(map(len, want.values())))


def test_random_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 60)
    monkeypatch.setattr(ann, "LEAF", 8)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((10, 16))
    rows = [(k, (centres[k % 10] + 0.5 * rng.standard_normal(16)).astype(np.float32).tolist()) for k in range(600)]
    rows += [(k, rows[50][1]) for k in range(2000, 2120)]                     # one common vector
    rows += [(700, None), (750, []), (800, [0.0] * 16), (850, [float("nan")] * 16), (900, [None] * 16),
             (950, [float("inf")] + [1.0] * 15), (None, rows[0][1]), (1000, [1.0, 2.0]), (1001, [2.0, 1.0])]
    rows += rows[:3]
    got, want = found(ann.search(frame(spark, rows), F.col("id") % 50 == 0)), brute(rows)
    assert recall(got, want) >= 0.95
    assert [i for i, _ in got[2000]] == [50, 2001, 2002, 2003, 2004]          # ties to the smaller id


def test_fewer_candidates_than_asked(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 1.0])]
    assert recall(found(ann.search(frame(spark, rows), F.col("id") % 50 == 0)), brute(rows)) == 1


def test_empty_table(spark):
    assert ann.search(frame(spark, []), F.col("id") % 50 == 0).count() == 0


def test_query_recall(spark):
    from snapfold.llm.queries import op5_nearest_neighbours
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert recall(found(op5_nearest_neighbours(spark, sf)), brute(rows)) >= 0.95


def test_chi_square_quantile():
    assert abs(ann.chi2_quantile(0.95, 8) - 15.507) < 1e-3 and abs(ann.chi2_quantile(0.99, 8) - 20.090) < 1e-3
