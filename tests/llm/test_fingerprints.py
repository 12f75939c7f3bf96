from __future__ import annotations

import hashlib
import random

from snapfold.llm import fingerprints
from tests.llm import cases


def brute(rows):
    """(doc_id, n_chars, sha256 of the edited text) for rows with distinct ids."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        h = len(t) // 2
        new = t[:len(t) - h] + after[:h]
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), fingerprints.simhash(t),
                    fingerprints.simhash(new), fingerprints.likeness(fingerprints.simhash(t), fingerprints.simhash(after))))
    return sorted(out, key=str)


def shown(out):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fp % 2**64, r.edited_fp % 2**64, r.near_next)
                   for r in out.collect()), key=str)


def distinct_rows():
    seen = {}
    for i, t in cases.texts():
        seen.setdefault(i, t)
    return list(seen.items())


def test_edit_test_over_many_ranges(spark):
    rows = distinct_rows()
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, part string, at int")
    assert shown(fingerprints.edit_test(df.repartition(7))) == brute(rows)


def test_repeated_rows(spark):
    out = fingerprints.edit_test(cases.docs(spark)).collect()
    assert len(out) == len(cases.texts())
    by_text = {}
    for i, t in cases.texts():
        by_text.setdefault(i, set()).add(fingerprints.simhash(t or ""))
    assert all(r.fp % 2**64 in by_text[r.doc_id] for r in out)


def test_single_row_and_empty_table(spark):
    one = spark.createDataFrame([(1, "alone here")], "doc_id long, text string")
    assert shown(fingerprints.edit_test(one)) == brute([(1, "alone here")])
    assert fingerprints.edit_test(cases.empty(spark)).count() == 0


def test_likeness_ranks_edits_over_strangers(spark):
    rows = [r for r in fingerprints.edit_test(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
            if r.n_chars > 400]
    assert sum(r.near_edited > r.near_next for r in rows) > 0.9 * len(rows)


def test_near_counts_by_brute_force(spark):
    rnd = random.Random(3)
    centres = [rnd.getrandbits(64) for _ in range(20)]
    values = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 4))) for c in centres for _ in range(20)} | {0, 1})
    want = {v: sum(0 < (v ^ w).bit_count() <= 3 for w in values) for v in values}
    df = spark.createDataFrame([(v - 2**64 if v >= 2**63 else v,) for v in values], "fp long")
    for size in (4096, 6):
        got = {r.fp % 2**64: r.n_near for r in fingerprints.near_counts(df, table_rows=size).collect()}
        assert got == {v: n for v, n in want.items() if n}
