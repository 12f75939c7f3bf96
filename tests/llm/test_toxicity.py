from __future__ import annotations

import random
import zlib

import numpy as np

from snapfold.llm import toxicity
from tests.llm import cases

BAD = ["grubnak", "grubno", "grubelle", "zifwort", "zifkeit"]


def corpus(n=400, seed=5):
    """(doc_id, text, toxic): toxic texts hold words that begin as BAD's do."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("aeioulmnrst", k=rnd.randint(3, 9))) for _ in range(300)]
    rows = []
    for k in range(n):
        text = rnd.choices(words, k=rnd.randint(5, 120))
        toxic = rnd.random() < 0.2
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                text.insert(rnd.randrange(len(text)), rnd.choice(BAD) + rnd.choice(["", ".", "!"]))
        rows.append((k, " ".join(text), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, y string")
    labels = cases.labels(spark, [(i, 1, y) for i, _, y in rows] + [(3, None, None), (None, 1, 1), (7, 1, 2)])
    model = toxicity.fit(docs, labels, "toxic", 5, 0)
    assert any(t.startswith("grub") for t in model.lexicon)
    score = {r.doc_id: r.score for r in toxicity.classify(docs, model).collect()}
    held = [(score[i] >= 0.5, bool(y)) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) >= 0.95


def test_held_out_accuracy_on_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0}
    model = toxicity.fit(docs, labels, "toxic", 5, 0)
    score = {r.doc_id: r.score for r in toxicity.classify(docs, model).collect()}
    caught = np.mean([score[i] >= 0.5 for i, y in truth.items() if y == 1])
    wrong = np.mean([score[i] >= 0.5 for i, y in truth.items() if y == 0])
    assert len(score) == docs.count() and caught > 0.85 and wrong < 0.03


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows = corpus(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    a = toxicity.fit(docs, cases.labels(spark, [(i, 1, y) for i, _, y in rows]), "toxic", 5, 0)
    b = toxicity.fit(docs, cases.labels(spark, [(i, 1, 1 - y if held(i) else y) for i, _, y in rows]), "toxic", 5, 0)
    assert a.lexicon == b.lexicon and a.intercept == b.intercept and (a.weights == b.weights).all()


def test_label_model_learns_accuracies_and_correlations():
    rng = np.random.default_rng(6)
    y = rng.random(4000) < 0.3
    right = lambda p: np.where(rng.random(4000) < p, y, ~y).astype(int) + 1
    own = [right(p) for p in (0.9, 0.85, 0.8, 0.8, 0.75, 0.75)]
    poor = right(0.55)
    copy = np.where(rng.random(4000) < 0.95, poor, 3 - poor)                  # hangs on poor, not on the class
    votes = np.stack([*own, poor, copy], axis=1)
    votes[rng.random(4000) < 0.2, 1] = 0
    some = (votes == 2).sum(axis=1)                                           # where fit() starts, too
    model = toxicity.LabelModel(votes, np.array([y[some == k].mean() for k in range(9)])[some])
    assert ((model.p >= 0.5) == y).mean() > 0.93
    assert model.parent[7] == 6 or model.parent[6] == 7


def test_odd_rows(spark):
    rows = corpus(200)
    model = toxicity.fit(spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"),
                         cases.labels(spark, [(i, 1, y) for i, _, y in rows]), "toxic", 5, 0)
    docs = cases.docs(spark)
    out = toxicity.classify(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    whole = toxicity.scored(docs, model)
    assert whole.columns == [*docs.columns, toxicity.SCORE]
    for r in whole.collect():
        assert r[toxicity.SCORE] in {x.score for x in out if x.doc_id == r.doc_id}
    assert toxicity.classify(cases.empty(spark), model).count() == 0


def test_without_labels(spark):
    docs = cases.docs(spark)
    for rows, want in (([], 0.0), ([(0, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)], 1.0)):
        model = toxicity.fit(docs, cases.labels(spark, rows), "toxic", 5, 0)
        assert all(abs(r.score - want) < 1e-3 for r in toxicity.classify(docs, model).collect())


def test_one_training_row_an_id(spark):
    rows = corpus(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    hot = spark.createDataFrame([rows[k][:2] for k in (1, 2)] * 150, "doc_id long, text string")
    labels = cases.labels(spark, [(i, 1, y) for i, _, y in rows])
    once, more = (toxicity.sample(d, labels, "toxic", 5, 0) for d in (docs, docs.unionByName(hot)))
    assert sorted(map(tuple, more.collect())) == sorted(map(tuple, once.collect()))
    a, b = (toxicity.fit(d, labels, "toxic", 5, 0) for d in (docs, docs.unionByName(hot)))
    assert a.lexicon == b.lexicon and (a.weights == b.weights).all()


def learned(spark, clean, toxic):
    docs = [(k, toxic(k) if k % 5 == 0 else clean(k)) for k in range(300)]
    labels = cases.labels(spark, [(k, 1, int(k % 5 == 0)) for k, _ in docs])
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(frame, labels, "toxic", 5, 0)
    score = {r.doc_id: r.score for r in toxicity.classify(frame, model).collect()}
    held = [k for k, _ in docs if zlib.crc32(str(k).encode()) % 5 == 0]
    return model.lexicon, sum((score[k] >= 0.5) == (k % 5 == 0) for k in held) / len(held)


def test_terms_within_punctuation_and_unspaced_runs(spark):
    rnd = random.Random(9)
    glue = lambda *_: "".join(rnd.choices("aeioulmn", k=4))
    han = lambda n: "".join(chr(0x5000 + rnd.randrange(900)) for _ in range(n))
    lexicon, right = learned(spark, lambda k: f"{glue()},{glue()},{glue()}", lambda k: f"{glue()},zifwort,{glue()}")
    assert "zifwort" in lexicon and right > 0.95
    lexicon, right = learned(spark, lambda k: han(60), lambda k: han(30) + "\u8822\u8d27" + han(30))
    assert "\u8822\u8d27" in lexicon and right > 0.95
    lexicon, right = learned(spark, lambda k: glue() * 15, lambda k: "grubnak" + glue() * 15)
    assert "grubnak*" in lexicon and right > 0.95


def test_posteriors_by_enumeration():
    """Four voters: p(class | votes) from the joint probability of every vote and class, with
    the tables and the tree that the model has."""
    from itertools import product
    rng = np.random.default_rng(8)
    votes = rng.integers(0, 3, (200, 4))
    votes[:, 3] = np.where(rng.random(200) < 0.8, votes[:, 1], votes[:, 3])
    model = toxicity.LabelModel(votes, np.where(votes[:, 0] == 2, 0.8, 0.1), rounds=3)
    assert sorted(model.order) == [0, 1, 2, 3] and model.parent[model.order[0]] == -1

    def joint(c, v):
        p = model.prior if c else 1 - model.prior
        for k, j in enumerate(model.parent):
            p *= model.tables[k][c, v[j] if j >= 0 else 0, v[k]]
        return p
    every = {v: (joint(0, v), joint(1, v)) for v in product(range(3), repeat=4)}
    assert abs(sum(map(sum, every.values())) - 1) < 1e-9                # the tree is a distribution
    got = model.posterior(np.array(list(every)))
    assert all(abs(p - b / (a + b)) < 1e-9 for p, (a, b) in zip(got, every.values()))


def test_terms_are_bounded_by_a_parameter(spark):
    rows = corpus(200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = cases.labels(spark, [(i, 1, y) for i, _, y in rows])
    whole, few = (toxicity.fit(docs, labels, "toxic", 5, 0, terms=n) for n in (toxicity.MOST_TERMS, 3))
    assert len(few.lexicon) == 3 < len(whole.lexicon) and set(few.lexicon) <= set(whole.lexicon)
