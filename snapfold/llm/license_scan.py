"""License scan by diagonal voting.

Every rolling word k-gram of every text is joined with the positions that it has in the
license templates (a fixed list, so the join is a broadcast). A match at word p of the
text and word q of the template votes for the diagonal p - q. Full votes on a single
diagonal are a place of a base phrase, whose words then stand there consecutively.
Neighbouring diagonals of a longer template, as insertions and deletions leave them, are
merged, and a merged span is verified by the share of the template's k-grams in it.
The k-grams' words are compared as well as their hashes. Votes are gathered per text.

Defined results: null and empty texts have no words, places or labels and score 0;
repeated rows give repeated rows; a null doc_id is carried; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.common import id_text, store

K = 3                # words of a k-gram
MERGE_WORDS = 3      # diagonals so far apart at most are merged
MIN_SHARE = 0.6      # of a template's k-grams, in a verified span

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
# Notices and openings of public licenses, in words as the scan cuts them, and their labels.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial 4 0 international", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("creative commons attribution sharealike 4 0 international", "cc-by-sa"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted", "isc"),
    ("all rights reserved", "all-rights-reserved"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]


def templates() -> list[tuple[int, str, list[str], bool]]:
    """(template, label, words, base)."""
    both = [(t, label, True) for t, label in BASE] + [(t, label, False) for t, label in NOTICES]
    return [(n, label, text.split(), base) for n, (text, label, base) in enumerate(both)]


def template_grams(k: int = K) -> list[tuple[str, int, int, int, str, bool]]:
    """(k-gram, template, its position there, the template's k-grams, label, base)."""
    return [(" ".join(words[q:q + k]), n, q, len(words) - k + 1, label, base)
            for n, label, words, base in templates() for q in range(len(words) - k + 1)]


def grams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_words, p, gram): all rolling word k-grams (p null: there is none)."""
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0))
    rows = id_text(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", words.alias("words"))
    all_words = ", ".join(f"words[p + {j}]" for j in range(K))
    rolled = F.expr(f"""CASE WHEN size(words) >= {K}
        THEN transform(sequence(0, size(words) - {K}), p -> concat_ws(' ', {all_words})) END""")
    return rows.select("row", "doc_id", F.size("words").cast("long").alias("n_words"),
                       F.posexplode_outer(rolled).alias("p", "gram"))


def votes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_words, p, n, q, of, label, base): k-grams found in templates, and
    each text's first k-gram, so that every text has a row."""
    spark = docs.sparkSession
    known = spark.createDataFrame(template_grams(), "t_gram string, n int, q int, of int, label string, base boolean")
    known = known.withColumn("t_hash", F.xxhash64("t_gram"))
    g = grams(docs, id_col, text_col).withColumn("hash", F.xxhash64("gram"))
    hit = g.join(F.broadcast(known), (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram")), "left")
    return hit.filter("n IS NOT NULL OR p IS NULL OR p = 0").select(
        "row", "doc_id", "n_words", "p", "n", "q", "of", "label", "base")


def spans(found: DataFrame) -> DataFrame:
    """(row, label, base, first, last, share): places of base phrases and verified spans
    of templates; first and last are words of the text."""
    on = found.filter("n IS NOT NULL").withColumn("diagonal", F.col("p") - F.col("q"))
    exact = (on.filter("base").groupBy("row", "n", "label", "of", "diagonal")
             .agg(F.count(F.lit(1)).alias("got")).filter("got = of")
             .select("row", "label", F.lit(True).alias("base"), F.col("diagonal").alias("first"),
                     (F.col("diagonal") + F.col("of") + K - 2).alias("last"), F.lit(1.0).alias("share")))
    by = Window.partitionBy("row", "n").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by) > MERGE_WORDS
    merged = (on.filter("NOT base").withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
              .withColumn("span", F.sum("apart").over(by))
              .groupBy("row", "n", "label", "of", "span")
              .agg(F.countDistinct("q").alias("got"), F.min("p").alias("first"),
                   (F.max("p") + K - 1).alias("last"))
              .withColumn("share", F.col("got") / F.col("of")).filter(F.col("share") >= MIN_SHARE)
              .select("row", "label", F.lit(False).alias("base"), "first", "last", "share"))
    return exact.union(merged)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (the largest verified share of a template; 1 for a base
    phrase), n_spans."""
    found = store(votes(docs, id_col, text_col), "license-votes")
    texts = found.filter("p IS NULL OR p = 0").select("row", "doc_id", "n_words").distinct()
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    at = spans(found).groupBy("row").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        joined("label").alias("labels"), F.max("share").alias("score"), F.count(F.lit(1)).alias("n_spans"))
    zero = {"n_base": 0, "base_labels": "", "labels": "", "score": 0.0, "n_spans": 0}
    return texts.join(at, "row", "left").na.fill(zero).drop("row")
