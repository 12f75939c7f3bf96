"""Near-duplicates by SimHash, found with BK-trees, grouped into components.

1. ``fingerprints``: 64-bit SimHash of word shingles, one pass without a shuffle.
2. Distinct fingerprints are dealt into shards: of ``BLOCKS`` blocks of bits, two
   fingerprints within ``radius`` agree on all but ``radius`` of them, so each shard is
   one choice of agreeing blocks and their value. Every link lies in some shard.
3. Each shard's fingerprints form a BK-tree, children keyed by their integer Hamming
   distance to the parent. Shards over ``TREE_NODES`` are split into trees of that many
   nodes at most; each tree is sent to every part of its shard, and queries follow only
   edges within the radius. A shard answers with a spanning forest of its links.
4. ``components``: large-star / small-star rounds on the links, each written to the
   shared folder, until nothing changes.

Equal texts meet as one fingerprint before any of this, in partial aggregates.

Defined results: null and empty texts have fingerprint zero and are linked like any
other; repeated rows give repeated rows; rows with null doc_id take part, and a
component with no doc_id at all has component_id null; other columns are ignored, or, by
``deduplicate``, kept as they are, whatever their names and types.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from xxhash import xxh64_intdigest

from snapfold.functions.hot import join_unique
from snapfold.llm.common import OWN, batch_of, boxed, hashable, id_text, map_slices, named, store, unboxed
from snapfold.llm.shards import block_masks, deal_shards, map_shards

SHINGLE_WORDS = 4
RADIUS = 4
HASH_SEED = 42
BLOCKS = 6            # a shard is 2 of 6 blocks: 21 or 22 bits
TREE_NODES = 4096     # of one BK-tree, at most
ROW = "__row"         # the column that tells rows apart


# ---- fingerprints

def simhash(text: str, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Bits set in over half of the shingles' hashes, as an unsigned integer."""
    words = text.encode().lower().split()       # bytes: lower() and split() are ASCII only
    if not words:
        return 0
    n = len(words) - words_per_shingle + 1
    if n < 1:
        return xxh64_intdigest(b" ".join(words), HASH_SEED)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(words_per_shingle))))
    hashes = np.fromiter(map(partial(xxh64_intdigest, seed=HASH_SEED), shingles), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 8192):
        part = hashes[at:at + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp long): the fingerprint's 64 bits as a signed integer."""
    return fingerprints_of(id_text(docs, id_col, text_col), words_per_shingle, "text", "doc_id")


def fingerprints_of(rows: DataFrame, words_per_shingle: int, text_col: str, kept: str = ROW) -> DataFrame:
    """Column ``kept`` of every row and the fingerprint of its text in ``fp``."""
    def make():
        def run(batch):
            texts = batch.column(text_col).to_pylist()
            fps = np.array([simhash(t or "", words_per_shingle) for t in texts], dtype=np.uint64)
            return batch_of({kept: batch.column(kept), "fp": pa.array(fps.view(np.int64))})
        return run
    schema = StructType([rows.schema[kept], StructField("fp", LongType())])
    return map_slices(rows.select(kept, text_col), make, schema)


def hex_fingerprint(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---- BK-trees

class BKForest:
    """One BK-tree for each run of equal numbers in ``shard``, over distinct 64-bit values
    within a shard. A node is a place in ``values``; ``root`` is each shard's first. An
    edge (parent, distance) leads to the child whose subtree lies at that distance."""

    EDGE = 128          # more than any distance

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        self.values = values
        members, group = np.arange(len(values)), shard
        self.root = np.empty(0, dtype=np.int64)
        keys, children = [], []
        while len(members):                                # all trees grow a level at once
            new = np.concatenate([[True], group[1:] != group[:-1]])
            nodes = members[new]                           # a group's first becomes its node
            if not keys:
                self.root = nodes
            keys.append(group[new])
            children.append(nodes)
            parent = nodes[np.cumsum(new) - 1][~new]
            members = members[~new]
            group = parent * self.EDGE + np.bitwise_count(values[members] ^ values[parent])
            order = np.argsort(group, kind="stable")
            members, group = members[order], group[order]
        key = np.concatenate(keys[1:] or [np.empty(0, dtype=np.int64)])
        child = np.concatenate(children[1:] or [np.empty(0, dtype=np.int64)])
        order = np.argsort(key)
        self.edge_key, self.edge_child = key[order], child[order]

    def search(self, queries: np.ndarray, at: np.ndarray, radius: int, step: int = 1 << 19):
        """Arrays (query, node) within the radius; query k starts at node ``at[k]``. Only
        edges whose distance is within the radius of the query's are followed."""
        todo = [(np.arange(len(queries)), at)]
        while todo:
            q, node = todo.pop()
            if len(q) > step:
                todo += [(q[k:k + step], node[k:k + step]) for k in range(0, len(q), step)]
                continue
            far = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            near = far <= radius
            if near.any():
                yield q[near], node[near]
            first = np.searchsorted(self.edge_key, node * self.EDGE + np.maximum(far - radius, 0), "left")
            n = np.searchsorted(self.edge_key, node * self.EDGE + far + radius, "right") - first
            if n.any():
                edge = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                todo.append((np.repeat(q, n), self.edge_child[edge]))


def _unite(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the trees of a[k] and b[k]; ``up`` holds each vertex's smallest, and does after."""
    while True:
        ra, rb = up[a], up[b]
        apart = ra != rb
        if not apart.any():
            return up
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            above = up[up]
            if (above == up).all():
                break
            up = above


def shard_links(shard: np.ndarray, is_node: np.ndarray, own: np.ndarray, values: np.ndarray,
                radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For many shards at once, rows sorted by ``shard``: a spanning forest of the links
    between a shard's nodes and its queries (where ``own``, its nodes are the queries)."""
    nodes = np.flatnonzero(is_node)
    if not len(nodes):
        return values[:0], values[:0]
    forest = BKForest(values[nodes], shard[nodes])
    ask = np.flatnonzero(~is_node | own)
    roots = forest.root
    place = np.searchsorted(shard[nodes][roots], shard[ask])
    place = np.minimum(place, len(roots) - 1)
    there = shard[nodes][roots][place] == shard[ask]
    ask, place = ask[there], place[there]
    up = np.arange(len(values))
    for q, node in forest.search(values[ask], roots[place], radius):
        up = _unite(up, ask[q], nodes[node])
    tied = np.flatnonzero(up != np.arange(len(up)))
    return values[tied], values[up[tied]]


# ---- links between distinct fingerprints

def links(distinct: DataFrame, radius: int = RADIUS, tree_nodes: int = TREE_NODES) -> DataFrame:
    """(a long, b long), a != b: links that connect whatever the links within the radius
    between the distinct values in column ``fp`` connect."""
    masks = block_masks(radius, max(BLOCKS, radius + 1))
    dealt = deal_shards(distinct, masks, tree_nodes)

    def found(t, own, shard, is_node, values):
        a, b = shard_links(shard, is_node, own, values, radius)
        return {"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))}
    return map_shards(dealt, found, "a long, b long").distinct()


# ---- components

def _with_least(rows: DataFrame, vertex: str, other: str) -> tuple[DataFrame, DataFrame]:
    """The stored (vertex, m, n) with each vertex's smallest ``other`` and number of rows, and
    a join of any rows that are part of ``rows`` with m, in which a star's centre, whatever
    share of the edges it holds, isn't one task's."""
    least = store(rows.groupBy(vertex).agg(F.min(other).alias("m"), F.count(F.lit(1)).alias("n")), "least")
    return least, lambda part: join_unique(part, least.select(vertex, "m"), [vertex], counts=least)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (a, b): the smallest vertex reachable.
    Large-star and small-star rounds; a star's centre may hold any share of the edges:
    its smallest neighbour is found in partial aggregates and broadcast to its edges."""
    e = store(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
              .filter("u <> v").distinct(), "links")
    before = None
    for _ in range(max_rounds):
        # large star: larger neighbours of a vertex go to the smallest around it
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select("v", "u"))
        _, with_low = _with_least(both, "x", "y")
        large = store(with_low(both.filter("y > x")).select(F.col("y").alias("v"), F.least("x", "m").alias("u"))
                      .filter("u <> v").distinct(), "links")
        # small star: a vertex and its smaller neighbours go to the smallest of them
        least, with_least = _with_least(large, "v", "u")
        small = (with_least(large).select(F.col("u").alias("v"), F.col("m").alias("u"))
                 .union(least.select("v", F.col("m").alias("u"))).filter("u <> v").distinct())
        e = store(small, "links")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select("v", F.col("u").alias("root"))


def grouped(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, first_id, n, root, component_id) for every distinct fingerprint in ``prints``
    (doc_id, fp): its smallest doc_id, its rows, its component, and the smallest doc_id there."""
    distinct = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "distinct")
    roots = components(links(distinct.select("fp"), radius))
    rooted = store(distinct.join(roots.withColumnRenamed("v", "fp"), "fp", "left")
                   .withColumn("root", F.coalesce("root", "fp")), "rooted")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return join_unique(rooted, ids, ["root"])


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, radius: int = RADIUS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``."""
    prints = store(fingerprints(docs, words_per_shingle, id_col, text_col), "fingerprints")
    groups = store(grouped(prints, radius).select("fp", "n", "component_id"), "groups")
    return join_unique(prints, groups.select("fp", "component_id"), ["fp"], counts=groups.select("fp", "n")) \
        .select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, radius: int = RADIUS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, whole, of each component: that with its smallest doc_id, null last. Rows
    that share the id are told apart by a hash of all their columns; of equal rows one
    stays (maps are compared by their entries). Groups are found on ids, hashes and
    fingerprints alone; the columns travel in one struct, so none can clash."""
    parts = [x for f in docs.schema.fields for x in (named(f.name).isNull(), hashable(named(f.name), f.dataType))]
    row = F.struct(F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
                   F.xxhash64(*parts).alias("hash")).alias(ROW)
    marked = docs.select(row, boxed(docs))
    prints = store(fingerprints_of(docs.select(row, F.col(text_col).alias("text")), words_per_shingle, "text"), "fingerprints")
    first = prints.groupBy("fp").agg(F.min(ROW).alias(ROW))
    roots = components(links(first.select("fp"), radius)).withColumnRenamed("v", "fp")
    kept = first.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min(ROW).alias(ROW))
    times = prints.groupBy(ROW).agg(F.count(F.lit(1)).alias("times"))
    kept = store(kept.select(ROW).join(times, ROW), "kept-rows")
    once = marked.join(kept.filter("times = 1").select(ROW), ROW, "left_semi")
    repeated = kept.filter("times > 1").select(ROW)
    if not repeated.isEmpty():
        same = marked.join(repeated, ROW, "left_semi").groupBy(ROW).agg(F.any_value(OWN).alias(OWN))
        once = once.unionByName(same)
    return unboxed(once, docs.columns)
