from __future__ import annotations

import zlib

import numpy as np

from snapfold.llm import quality
from tests.llm import cases


def test_held_out_accuracy_on_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    model = quality.fit(docs, labels, "quality", 4, 2)
    assert 0 < len(model.rules) < 100
    score = {r.doc_id: r.score for r in quality.classify(docs, model).collect()}
    kept = np.mean([score[i] >= 0.7 for i, y in truth.items() if y == 1])
    wrong = np.mean([score[i] >= 0.7 for i, y in truth.items() if y == 0])
    assert len(score) == docs.count() and kept > 0.98 and wrong < 0.05


def sample(n=600, seed=7):
    rng = np.random.default_rng(seed)
    x = rng.random((n, len(quality.STATS)))
    y = ((x[:, 2] > 0.5) & (x[:, 5] <= 0.6)).astype(float)
    return x, y


def test_rules_find_a_conjunction():
    x, y = sample()
    rules = quality.extract_rules(x, y)
    assert all(len({j for j, _, _ in r}) <= quality.DEPTH for r in rules)
    a = np.stack([quality.holds(r, x) for r in rules], axis=1).astype(float)
    b, w = quality.lasso_logistic(a, y)
    assert 0 < (np.abs(w) > 1e-6).sum() < len(rules) / 2                     # sparse
    model = quality.RuleEnsemble(b, [(r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6])
    fresh, truth = sample(seed=8)
    assert ((model.score(fresh) >= 0.5) == truth).mean() > 0.95


def test_lasso_satisfies_its_optimality_conditions():
    x, y = sample(300)
    a = (x[:, :8] > 0.5).astype(float)
    b, w = quality.lasso_logistic(a, y, strength=0.02, steps=4000)
    p = 1 / (1 + np.exp(-(a @ w + b)))
    slope = a.T @ (p - y) / len(y)
    for g, v in zip(slope, w):
        assert abs(g + 0.02 * np.sign(v)) < 2e-3 if abs(v) > 1e-6 else abs(g) <= 0.02 + 2e-3


def test_column_is_the_ensemble(spark):
    model = quality.RuleEnsemble(-0.25, [(((0, True, 3.0), (3, False, 0.01)), 1.5), (((9, True, 0.5),), -2.0)])
    texts = [t or "" for _, t in cases.texts()]
    want = model.score(np.array([quality.statistics_of(t) for t in texts]))
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.classify(df, model).collect()}
    assert all(abs(got[k] - s) < 1e-12 for k, s in enumerate(want))


def test_odd_rows(spark):
    docs = cases.docs(spark)
    ids = [i for i, _ in cases.texts()][:60]
    labels = cases.labels(spark, [(i, k % 2, 0) for k, i in enumerate(ids)] + [(None, 1, 1), (5, None, 1), (6, 9, 1)])
    model = quality.fit(docs, labels, "quality", 4, 2)
    out = quality.classify(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert quality.scored(docs, model).columns == [*docs.columns, quality.SCORE]
    assert quality.classify(cases.empty(spark), model).count() == 0


def test_without_labels(spark):
    docs = cases.docs(spark)
    for rows, want in (([], 0.5), ([(0, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)], 1.0)):
        model = quality.fit(docs, cases.labels(spark, rows), "quality", 4, 2)
        assert all(abs(r.score - want) < 1e-3 for r in quality.classify(docs, model).collect())
    assert quality.fit(cases.empty(spark), cases.labels(spark, []), "quality", 4, 2).rules == []


def test_one_training_row_an_id(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    seen = [r.doc_id for r in labels.filter("quality = 0").orderBy("doc_id").limit(5).collect()]
    hot = docs.filter(docs.doc_id.isin(seen)).crossJoin(spark.range(400)).select(docs.columns)
    a, b = (quality.fit(d, labels, "quality", 4, 2) for d in (docs, docs.unionByName(hot)))
    assert a.rules and a.rules == b.rules and a.intercept == b.intercept


def test_a_small_tree_by_hand():
    """Every rule, its rows and its value, of a tree that can be worked out on paper."""
    x = np.array([[a, b] for a in (0.0, 1.0) for b in (0.0, 1.0) for _ in range(10)])
    y = np.array([0.0] * 20 + [1.0] * 10 + [0.0] * 10)                  # 1 where a > 0 and b <= 0
    edges = [np.array([0.5]), np.array([0.5])]
    binned = (x > 0.5).astype(int)
    p = np.full(40, 0.25)
    nodes = {rule: (rows.tolist(), value) for rule, rows, value in quality._tree(binned, edges, y - p, p * (1 - p))}
    low, high = (0, True, 0.5), (0, False, 0.5)
    leaf = lambda g, n: g / (n * 0.1875 + 1)  # noqa: E731     the sum of y - p over the sum of p (1 - p) plus 1
    want = {(low,): (list(range(20)), leaf(-5.0, 20)), (high,): (list(range(20, 40)), 0.0),
            (high, (1, True, 0.5)): (list(range(20, 30)), leaf(7.5, 10)),
            (high, (1, False, 0.5)): (list(range(30, 40)), leaf(-2.5, 10))}
    first_b = {((1, True, 0.5),), ((1, False, 0.5),)} & set(nodes)
    assert not first_b                                                  # equal gains: the first statistic
    assert set(nodes) == set(want)
    for rule, (rows, value) in want.items():
        assert nodes[rule][0] == rows and abs(nodes[rule][1] - value) < 1e-12
        assert quality.holds(rule, x).nonzero()[0].tolist() == rows
