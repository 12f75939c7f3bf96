"""Labelled training rows: a bounded, repeatable choice of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import id_text

TRAIN_ROWS = 20_000     # labelled rows that a classifier is fitted on, at most


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(of))


def chosen(labels: DataFrame, label: str, keep: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, y): at most ``rows`` labelled ids for which ``keep`` (a condition on
    doc_id) holds, in hash order. An id with several labels has its smallest."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
            .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & keep)
            .groupBy("doc_id").agg(F.min("y").alias("y"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))


def training_rows(docs: DataFrame, train: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, y): one row for each id of ``train`` that ``docs`` hold. Of rows that
    repeat an id, that with the smallest hash of its text stays."""
    rows = id_text(docs, id_col, text_col).join(F.broadcast(train), "doc_id")
    return (rows.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one"))
            .select("doc_id", "one.text", "y"))
