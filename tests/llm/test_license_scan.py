from __future__ import annotations

import re

import pytest

from snapfold.llm import license_scan
from tests.llm import cases
from tools.oracle_check import duck, rows_of

PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", cases.lower(text))


def brute(text):
    w = words(text)
    places = [(p, label) for phrase, label in PHRASES for p in range(len(w))
              if w[p:p + len(phrase.split())] == phrase.split()]
    starts = [p for p, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def test_base_places_by_brute_force(spark):
    out = license_scan.scan(cases.docs(spark)).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in cases.texts()), key=str)
    for r in out:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)


@pytest.mark.parametrize("text, label", [
    ("Permission is hereby granted, free of charge, to any person who obtains a copy of this software and associated "
     "documentation files (the Software), to deal in the Software without any restriction", "mit"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("ALL RIGHTS RESERVED", "all-rights-reserved"),
    ("nothing of the kind, is hereby granted free lunch", ""),
])
def test_notices_with_insertions(spark, text, label):
    one = spark.createDataFrame([(1, "before it. " + text + " After it.")], "doc_id long, text string")
    assert license_scan.scan(one).first().labels == label


def test_empty_table(spark):
    assert license_scan.scan(cases.empty(spark)).count() == 0


def test_query_as_sql(spark, sf_dir):
    from snapfold.llm.queries import ORACLE, op1_license_scan
    got = rows_of(op1_license_scan(spark, sf_dir).toPandas())
    assert got == rows_of(duck(sf_dir).execute(ORACLE["op1_license_scan"]).df())
