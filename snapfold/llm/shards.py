"""Distinct 64-bit fingerprints dealt out so that close ones meet.

Of ``blocks`` blocks of bits, two values within a radius agree on all but ``radius`` of
them. A shard is one choice of agreeing blocks and their bits, so each close pair meets
in some shard. A shard over ``most`` values is cut by hash into parts of about that many,
and each pair of parts is a shard of its own: memory is bounded whatever a shard holds.
The values of the largest shards aren't gathered before they are cut (``join_unique``).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.functions.hot import join_unique
from snapfold.llm.common import store


def block_masks(radius: int, blocks: int) -> list[int]:
    """For each choice of ``blocks - radius`` blocks, the mask of their bits (unsigned)."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    bits = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(bits, blocks - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def deal_shards(distinct: DataFrame, masks: list[int], most: int) -> DataFrame:
    """(t, v, tree, part, is_node, fp) from the distinct values in column ``fp``: mask t,
    its bits v, and a pair of parts. Where tree = part, its values are nodes and queries;
    else nodes are of ``tree`` and queries of ``part``. Shards of one value are left out."""
    shards = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("v"))
        for t, m in enumerate(masks)])).alias("s")).select("fp", "s.t", "s.v")
    sizes = store(shards.groupBy("t", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shard-sizes")
    parts = sizes.select("t", "v", F.ceil(F.col("n") / F.lit(most)).cast("int").alias("c"))
    return (join_unique(shards, parts, ["t", "v"], counts=sizes)
            .withColumn("p", F.pmod(F.xxhash64("fp"), F.col("c")).cast("int"))
            .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
            .select("t", "v", F.least("i", "p").alias("tree"), F.greatest("i", "p").alias("part"),
                    (F.col("p") <= F.col("i")).alias("is_node"), "fp"))


def map_shards(dealt: DataFrame, f, schema: str) -> DataFrame:
    """``f(t, own, shard, is_node, values) -> columns`` over the rows of many whole shards
    at once; ``shard`` numbers them from 1 in row order, ``own`` is tree = part."""
    def run(batches):
        held: list[np.ndarray] | None = None

        def done(rows):
            t, v, tree, part, is_node, fp = rows
            new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in (t, v, tree, part)], axis=0)])
            out = f(t, tree == part, np.cumsum(new), is_node, fp.view(np.uint64))
            return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            last = np.all([x == x[-1] for x in rows[:4]], axis=0)   # a shard that may go on
            whole = int(np.argmax(last))
            if whole:
                yield done([x[:whole] for x in rows])
            held = [x[whole:] for x in rows]
        if held is not None:
            yield done(held)
    by = ["t", "v", "tree", "part"]
    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)
