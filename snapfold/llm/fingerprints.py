"""Document fingerprints by weighted SimHash, their search, and an edit test.

``simhash``: the hashes of a text's terms (pairs of neighbouring words; a lone word by
itself) vote on 64 signed bits with weight 1 + ln(count). ``near_counts`` finds all
fingerprints within a Hamming radius with permuted block tables: for every choice of
blocks on which two such fingerprints must agree, a table keyed by those blocks; a pair
is counted in the first table in which it meets. ``edit_test`` compares each text with
an edited form that takes its second half from the next text in descending doc_id.

Texts are moved once, dealt out by ranges of doc_id, to meet the next one; at the ends of
a range two rows are handed on, whatever the corpus holds.

Defined results: null and empty texts have no terms and fingerprint zero; equal texts
have equal fingerprints; the next of rows with equal doc_id goes by the text's hash, null
doc_id comes last, a lone row is its own next; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from math import cos, pi

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from snapfold.llm.common import id_text, store
from snapfold.llm.shards import block_masks, deal_shards, map_shards

RADIUS = 3
BLOCKS = 5             # a table's key is 2 of 5 blocks: 25 or 26 bits
TABLE_ROWS = 4096      # compared with each other at once, at most
PAIR = np.uint64(0x9E3779B97F4A7C15)


def simhash(text: str) -> int:
    """Unsigned 64-bit fingerprint."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    terms = np.fromiter(map(xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    if len(words) > 1:
        terms = terms[:-1] * PAIR + (terms[1:] ^ (terms[1:] >> np.uint64(29)))
        terms ^= terms >> np.uint64(32)
        terms *= PAIR
        terms ^= terms >> np.uint64(29)
    terms, counts = np.unique(terms, return_counts=True)
    weight = (1 + np.log(counts)).astype(np.float32)
    votes = np.zeros(64, dtype=np.float64)
    for at in range(0, len(terms), 8192):
        bits = np.unpackbits(terms[at:at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        votes += weight[at:at + 8192] @ bits.astype(np.float32)
    return int(np.packbits(2 * votes > weight.sum(dtype=np.float64), bitorder="little").view("<u8")[0])


def likeness(a: int, b: int) -> float:
    """The cosine that the share of differing bits estimates, not under 0."""
    return max(0.0, cos(pi * (a ^ b).bit_count() / 64))


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the start of the one that follows."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


OUT = ("doc_id long, n_chars long, edited_sha256 string, fp long, edited_fp long, near_edited double, "
       "near_next double")
_FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fp", pa.int64()),
           ("edited_fp", pa.int64()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _tested(doc_id, text: str, fp: int, following: str, next_fp: int) -> tuple:
    new = edited(text, following)
    new_fp = simhash(new)
    return (doc_id, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), _signed(fp),
            _signed(new_fp), likeness(fp, new_fp), likeness(fp, next_fp))


def _batch(rows: list[tuple], more: list[tuple[str, pa.DataType]] = []) -> pa.RecordBatch:
    fields = _FIELDS + more
    cols = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)],
                                      names=[n for n, _ in fields])


def edit_test(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``, columns OUT."""
    texts = id_text(docs, id_col, text_col)
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranges = texts.repartitionByRange(*order).sortWithinPartitions(*order)

    def within(batches):
        """Rows that meet the next one here; the first and the last row of a range are
        also handed on with their texts (part, at: 0 first, 1 last)."""
        part = TaskContext.get().partitionId()
        ends = [("part", pa.int64()), ("at", pa.int32()), ("text", pa.string())]
        held, started = None, False
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                out = []
                for doc, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    fp = simhash(text)
                    if not started:
                        started = True
                        out.append((doc, None, None, _signed(fp), None, None, None, part, 0, text))
                    else:
                        out.append(_tested(*held, text, fp) + (None, None, None))
                    held = (doc, text, fp)
                yield _batch(out, ends)
        if held is not None:
            doc, text, fp = held
            yield _batch([(doc, None, None, _signed(fp), None, None, None, part, 1, text)], ends)

    found = store(ranges.mapInArrow(within, OUT + ", part long, at int, text string"), "edit-test")
    # two rows per range: each range's last text meets the first of the next range that
    # has rows, the very last the very first
    ends = found.filter("part IS NOT NULL")
    firsts = ends.filter("at = 0").select("part", F.col("fp").alias("next_fp"), F.col("text").alias("following"))
    by = Window.orderBy("part")
    order = firsts.select("part").withColumn("then", F.lead("part").over(by)) \
        .withColumn("then", F.coalesce("then", F.first("part").over(by)))
    joined = (ends.filter("at = 1").select("part", "doc_id", "text", "fp").join(order, "part")
              .join(firsts.withColumnRenamed("part", "then"), "then")
              .select("doc_id", "text", "fp", "following", "next_fp"))

    def across(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield _batch([_tested(row["doc_id"], row["text"], row["fp"] % (1 << 64), row["following"],
                                      row["next_fp"] % (1 << 64))])
    names = [n for n, _ in _FIELDS]
    return found.filter("part IS NULL").select(names).union(joined.mapInArrow(across, OUT))


def near_counts(distinct: DataFrame, radius: int = RADIUS, table_rows: int = TABLE_ROWS) -> DataFrame:
    """(fp, n_near) for the distinct values in column ``fp`` that have others within the
    radius: how many. Every pair is found; none is written out."""
    masks = block_masks(radius, max(BLOCKS, radius + 1))
    keys = np.array(masks, dtype=np.uint64)

    def found(t, own, shard, is_node, values):
        n = np.zeros(len(values), dtype=np.int64)
        here, step = np.arange(len(values)), 1
        while True:
            here = here[here + step < len(values)]
            here = here[shard[here] == shard[here + step]]
            if not len(here):
                break
            there = here + step
            x = values[here] ^ values[there]
            near = (np.bitwise_count(x) <= radius) & (own[here] | (is_node[here] != is_node[there]))
            i, j, x = here[near], there[near], x[near]
            if len(i):
                meets = (x[:, None] & keys) == 0
                first = np.argmax(meets, axis=1) == t[i]
                np.add.at(n, i[first], 1)
                np.add.at(n, j[first], 1)
            step += 1
        some = n > 0
        return {"fp": pa.array(values[some].view(np.int64)), "n": pa.array(n[some])}
    parts = map_shards(deal_shards(distinct, masks, table_rows), found, "fp long, n long")
    return parts.groupBy("fp").agg(F.sum("n").alias("n_near"))
