from __future__ import annotations

import random
import re

import numpy as np
from xxhash import xxh64_intdigest

from snapfold.llm import simhash_dedup
from snapfold.llm.queries import op4_simhash_dedup
from tests.llm import cases


def brute_fingerprint(text: str | None) -> int:
    words = re.findall("[^\x20\x09-\x0D]+", cases.lower(text))
    parts = [" ".join(words[k:k + 4]) for k in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxh64_intdigest(x.encode(), 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], radius: int) -> list[int]:
    """Smallest place reachable from each place."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(prints))]


def brute_ids(rows):
    """component_id by (doc_id, fingerprint) of rows (doc_id, text)."""
    prints = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(prints, 4)
    ids = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            ids[r] = min(i, ids.get(r, i))
    return sorted(((i is None, i or 0, f"{p:016x}", ids.get(r)) for (i, _), p, r in zip(rows, prints, roots)), key=str)


def shown(rows):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in rows), key=str)


def test_rows(spark):
    from pyspark.sql import functions as F
    out = simhash_dedup.near_duplicates(cases.docs(spark))
    out = out.select("doc_id", simhash_dedup.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")
    assert shown(out.collect()) == brute_ids(cases.texts())


def test_empty_table(spark):
    assert simhash_dedup.near_duplicates(cases.empty(spark)).count() == 0
    assert simhash_dedup.deduplicate(cases.empty(spark)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert shown(op4_simhash_dedup(spark, sf).collect()) == brute_ids(rows)


def test_bk_forest_follows_every_link():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64) & np.uint64(0xFFFF00FF))
    shard = np.sort(rng.integers(1, 4, len(values)))
    forest = simhash_dedup.BKForest(values, shard)
    roots = forest.root[shard - 1]
    found = {(int(q), int(n)) for qs, ns in forest.search(values, roots, 4, step=64) for q, n in zip(qs, ns)}
    want = {(i, j) for i in range(len(values)) for j in range(len(values))
            if shard[i] == shard[j] and int(values[i] ^ values[j]).bit_count() <= 4}
    assert found == want


def test_links_with_large_shards_cut_into_many_trees(spark):
    rnd = random.Random(2)
    flip = lambda x, n: x ^ sum(1 << b for b in rnd.sample(range(64), n))
    centres = [rnd.getrandbits(64) for _ in range(30)]
    values = sorted({flip(c, rnd.randint(0, 9)) for c in centres for _ in range(15)} | {0, 1, 2**64 - 1, 2**63})
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    order = sorted(range(len(values)), key=lambda k: signed[k])
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.v: r.root for r in simhash_dedup.components(simhash_dedup.links(df, tree_nodes=5)).collect()}
    brute = brute_components([values[k] for k in order], 4)
    for place, k in enumerate(order):
        assert roots.get(signed[k], signed[k]) == signed[order[brute[place]]]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 2000 + k) for k in range(300)] + [(5, 5)]
    df = spark.createDataFrame(random.Random(0).sample(edges, len(edges)), "a long, b long")
    roots = {r.v: r.root for r in simhash_dedup.components(df).collect()}
    assert all(roots[k] == 0 for k in range(1, 301)) and all(roots[2000 + k] == 1000 for k in range(300))


def test_deduplicate_keeps_one_row_of_each_component(spark):
    docs = cases.docs(spark)
    kept = simhash_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    rows = cases.texts()
    roots = brute_components([brute_fingerprint(t) for _, t in rows], 4)
    want = []
    for r in sorted(set(roots)):
        ids = [i for (i, _), x in zip(rows, roots) if x == r]
        known = [i for i in ids if i is not None]
        want.append(min(known) if known else None)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def test_deduplicate_of_equal_rows(spark):
    one = spark.createDataFrame([(1, "same text in every row of this table")] * 50, "doc_id long, text string")
    assert simhash_dedup.deduplicate(one).count() == 1
