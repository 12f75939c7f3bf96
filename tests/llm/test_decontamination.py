from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import regex

from snapfold.llm import decontamination as dc
from snapfold.llm.queries import op13_decontamination
from tests.llm import cases

WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(cases.lower(text))


def brute(docs, items, window=10):
    """(doc_id, n_words, items, spans) of rows (doc_id, text), by looking at every place."""
    phrases = {}
    for name, text in items:
        ws = words_of(text)
        for k in range(max(1, len(ws) - window + 1) if ws else 0):
            phrases.setdefault(tuple(ws[k:k + window]), set()).add("null" if name is None else str(name))
    sizes = {len(p) for p in phrases}
    out = []
    for i, text in docs:
        ws = words_of(text)
        hit, found = [False] * len(ws), set()
        for n in sizes:
            for k in range(len(ws) - n + 1):
                p = tuple(ws[k:k + n])
                if p in phrases:
                    found |= phrases[p]
                    hit[k:k + n] = [True] * n
        edge = [k for k in range(len(ws) + 1) if (k < len(ws) and hit[k]) != (k > 0 and hit[k - 1])]
        out.append((i, len(ws), sorted(found), list(zip(edge[::2], edge[1::2]))))
    return out


def shown(found):
    return sorted(((r.doc_id, r.n_words, r["items"], [(s.start, s.end) for s in r.spans]) for r in found.collect()), key=str)


@pytest.fixture(scope="module")
def made():
    """Documents and items from few words, so that phrases recur, overlap and touch."""
    rnd = random.Random(7)
    vocabulary = ["the", "of", "ab", "ÄB", "x1", "中文", "long" * 9, "q", "zz", "end"]
    line = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, line(rnd.choice([0, 1, 3, 9, 10, 11, 30]))) for k in range(12)]
    items += [(5, line(14)), (None, line(10)), (20, items[4][1]), (21, None), (22, "... !?"), (23, line(10).upper())]
    docs = [(k, line(rnd.randint(0, 60)) + " unknown " + (rnd.choice(items)[1] or "").replace(" ", ", ") + " " + line(3)) for k in range(40)]
    docs += [(50, items[3][1]), (51, (items[9][1] or "") * 2), (None, line(20)), (3, docs[3][1]), (52, None), (53, ""), (54, " \n\t!")]
    return docs, items


def tables(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, n_words int, items string, own int")
    return d, spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, words int")


@pytest.mark.parametrize("window, block_chars", [(10, 1 << 20), (3, 1 << 20), (10, 120)])
def test_against_brute_force(spark, made, window, block_chars):
    docs, items = made
    got = dc.find(*tables(spark, docs, items), window=window, block_chars=block_chars)
    assert got.columns == ["doc_id", "n_words", "items", "spans"]
    assert shown(got) == sorted(brute(docs, items, window), key=str)


def test_shards_pieces_and_chunks(spark, made, monkeypatch):
    """However texts are cut up, every place is found."""
    docs, items = made
    phrases = dc.Phrases([("null" if i is None else str(i), [w.encode() for w in words_of(t)]) for i, t in items], 10)
    monkeypatch.setattr(dc, "PIECE_WORDS", 7)
    monkeypatch.setattr(dc, "CHUNK", 11)
    shard = dc.Shard(phrases)
    for _, text in docs:
        shard.add(None if text is None else text.encode())
    assert shard.counts == [n for _, n, _, _ in brute(docs, [])]
    assert shard.found() == [(found, spans) for _, _, found, spans in brute(docs, items)]


def test_pieces_of_long_items_hold_every_phrase(spark):
    rnd = random.Random(1)
    text = " ".join(str(rnd.randint(0, 50)) for _ in range(200))
    bench = spark.createDataFrame([(1, text), (1, text), (2, "a b")], "item_id long, text string")
    rows = dc.pieces_of(bench, 10, "item_id", "text", piece=25).collect()
    assert len(rows) == len({r.words for r in rows}) and all(len(r.words.split()) <= 25 for r in rows)
    ws = text.split()
    want = {tuple(ws[k:k + 10]) for k in range(len(ws) - 9)}
    held = [p.split() for p in (r.words for r in rows if r.item == "1")]
    assert {tuple(p[k:k + 10]) for p in held for k in range(len(p) - 9)} == want


def test_odd_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "This software is free"), (2, "word " * 30)], "item_id long, text string")
    got = {(r.doc_id, r.n_words): r for r in dc.find(cases.docs(spark), bench).collect()}
    assert got[(1011, 11)]["items"] == ["1"] and [(s.start, s.end) for s in got[(1011, 11)].spans] == [(7, 11)]
    assert got[(1003, 20_001)]["items"] == ["2"] and [(s.start, s.end) for s in got[(1003, 20_001)].spans] == [(1, 20_001)]
    assert sum(bool(r.spans) for r in got.values()) == 2 and got[(1000, 0)].spans == []
    assert dc.find(cases.empty(spark), bench).count() == 0
    none = dc.find(cases.docs(spark), bench.limit(0)).collect()
    assert len(none) == len(cases.texts()) and not any(r["items"] or r.spans for r in none)


def test_clean_cuts_the_spans_out(spark):
    bench = spark.createDataFrame([(1, "cut these three words out now")], "item_id long, text string")
    rows = [(1, "Keep. Cut THESE, three words out\n now! and this", {"a": 1}), (2, "nothing", None), (3, None, {}), (None, "cut these", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` map<string,int>")
    got = dc.clean(docs, bench)
    assert got.schema == docs.schema
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([(1, "Keep. ! and this", {"a": 1}), *rows[1:]], key=str)


def test_index_alone():
    rng = np.random.default_rng(5)
    for top in (1, 3, 40):
        runs = [rng.integers(1, top + 1, rng.integers(1, 30)) for _ in range(30)]
        runs += [runs[0]] * 5                                                    # repeated runs
        text = np.concatenate([np.append(r, 0) for r in runs]).astype(np.int32)
        order = dc.suffix_array(text, top)
        ends = np.flatnonzero(text == 0)
        key = lambda p: [(int(c), 0) if c else (-1, int(p + k)) for k, c in enumerate(text[p:ends[np.searchsorted(ends, p)] + 1])]
        assert order.tolist() == sorted(range(len(text)), key=key)
        index = dc.FMIndex(text, top)
        words = np.flatnonzero(text != 0)
        rows = np.argsort(order)[words]                                          # the row of each place
        assert (index.locate(rows) == words).all()
        for n in (1, 2, 4):
            phrases = np.unique(rng.integers(1, top + 1, (60, n)), axis=0).astype(np.int32)
            who, low, high = index.search(phrases)
            found = {int(w): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(who, low, high)}
            want = {}
            for w, p in enumerate(phrases):
                at = [k for k in range(len(text) - n + 1) if (text[k:k + n] == p).all()]
                if at:
                    want[w] = at
            assert found == want


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = sorted((i, n, sum(b - a for a, b in spans), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(spans))
                  for i, n, found, spans in brute(docs, items))
    got = sorted(map(tuple, op13_decontamination(spark, sf).collect()))
    assert got == want and sum(r[5] for r in got) > 5
