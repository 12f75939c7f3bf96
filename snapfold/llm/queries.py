"""Registered queries of the training-data operators: each applies one operator to its
whole table and derives the digest columns from the operator's own output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.functions.hot import join_unique
from snapfold.llm import (ann, byte_bpe, decontamination, fingerprints, license_scan, packing, quality, secrets,
                          simhash_dedup, toxicity, vector_codes, warc, whitening)
from snapfold.llm.common import store, table
from snapfold.llm.labelled import fold
from snapfold.llm.oracles import ORACLE  # noqa: F401

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document, encoded and decoded."""
    ids = byte_bpe.encode(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return byte_bpe.decode(ids, BYTE_RANKS).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose SimHashes are linked within four bits."""
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_dedup.hex_fingerprint(F.col("fp")).alias("fingerprint"),
                        "component_id")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of all vectors for each whose vec_id is divisible by 50."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited form, and how many other
    fingerprints of the corpus lie within three bits."""
    tested = fingerprints.edit_test(table(spark, sf_dir, "documents"))
    near = fingerprints.near_counts(tested.select("fp").distinct())
    return join_unique(tested, store(near, "near"), ["fp"], "left").select(
        "doc_id", "n_chars", "edited_sha256", simhash_dedup.hex_fingerprint(F.col("fp")).alias("fingerprint"),
        simhash_dedup.hex_fingerprint(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next",
        F.coalesce("n_near", F.lit(0)).alias("n_near"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, and how many of their values look live or copied.
    ``frequencies`` has repositories:owners that hold the value, for each of ``spans``."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    spans = F.coalesce("judged", F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean,"
                                                "n_repos:bigint,n_owners:bigint>>"))
    base = F.filter(spans, lambda s: s["kind"] < 3)
    of_kind = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    shown = F.filter(spans, lambda s: (s["kind"] < 3) | s["live"])
    return found.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(shown).alias("spans"),
        F.array_join(F.transform(shown, lambda s: F.concat_ws(
            ":", s["n_repos"].cast("string"), s["n_owners"].cast("string"))), ",").alias("frequencies"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter(spans, lambda s: ~s["live"])).cast("long").alias("n_copied"))


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and plain-text records of every page."""
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; crc32 fold 0 of 5 is held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", folds=5, held_out=0)
    return toxicity.classify(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; crc32 fold 2 of 4 is held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "quality", folds=4, held_out=2)
    return quality.classify(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as 16 codes of 64 entries, after two rounds."""
    found, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error",
                        F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first 16 whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark phrases of ten words in every document."""
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_packing": op3_packing,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_fingerprints": op6_fingerprints,
    "op7_secret_scan": op7_secret_scan,
    "op8_warc_derivatives": op8_warc_derivatives,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_vector_codes": op11_vector_codes,
    "op12_whitening": op12_whitening,
    "op13_decontamination": op13_decontamination,
}
