"""A training corpus from the documents table, stage by stage.

Each stage applies one operator of ``snapfold.llm`` to all rows that the stage before it
kept, and its decisions take effect: low quality goes, toxic text goes, one row of each
group of near-duplicates stays, secrets are masked, and what is left is packed into
sequences. All stages but the last return the columns of their input.

Defined results, beside the operators' own: extra columns pass through untouched, whatever
their names (dots, names that operators use) and types (maps and other nested ones), rows
with null text are judged as empty ones, and of a group of near-duplicates the row with
the smallest doc_id stays (null last; of rows that repeat it, one).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from snapfold.llm import packing, quality, secrets, simhash_dedup, toxicity
from snapfold.llm.common import named, store, table, unboxed

KEEP_QUALITY = 0.7       # score from which a document is kept
REJECT_TOXIC = 0.5       # score from which a document is rejected
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the quality classifier does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", folds=4, held_out=2)
    return unboxed(quality.own_scored(docs, model).filter(F.col("score") >= KEEP_QUALITY), docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the toxicity classifier does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", folds=5, held_out=0)
    return unboxed(toxicity.own_scored(docs, model).filter(F.col("score") < REJECT_TOXIC), docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash_dedup.deduplicate(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; n_chars, where it is a number, follows the masked text."""
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    n_chars = F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars"))
    return secrets.mask(docs).select(*[
        n_chars.cast(kinds[c]).alias(c) if c == "n_chars" and isinstance(kinds[c], NumericType) else named(c)
        for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences."""
    return packing.pack(docs, WORD_TOKENIZER)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

# Fitted classifiers, SimHash components and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
