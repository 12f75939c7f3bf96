"""Nearest neighbours by cosine: stable projections, kd-trees, chi-square stopping.

Unit vectors are projected to PROJECTED dimensions with a Gaussian (2-stable) matrix, so
the squared projected distance of a pair, over its squared distance, is chi-square. A
kd-tree over the projections, its upper splits fitted on a bounded sample, deals all
vectors into cells; large cells are cut into shards with a kd-tree each. A query takes
cells, and leaves within them, in the order of their projected distance, verifies the
vectors there by their true cosine, and stops once a vector still unseen that is nearer
than the k-th found would lie that far out with probability under 1 - CONFIDENCE.

Equal vectors are searched once, as a class that keeps its k + 1 smallest ids: no other
id of it can be among anyone's k nearest. Cosines are between vectors of equal length.

Defined results: vectors null, zero or holding null or non-finite components, and rows
with null id, take no part; repeated rows count once; ties go to the smaller id; a query
with fewer than k others gets them all; other columns are ignored.
"""

from __future__ import annotations

import heapq
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.common import store

PROJECTED = 8           # even: the chi-square test below is for even degrees
CONFIDENCE = 0.99
SAMPLE = 20_000         # projected vectors, at most, on which the upper splits are fitted
CELL_ROWS = 4096        # vectors of a shard and its kd-tree, on average
MAX_CELLS = 2048
LENGTHS = 64            # of vectors, the commonest, that have a tree of cells each
LEAF = 512              # vectors of a kd-tree's leaf, verified together


def chi2_quantile(p: float, m: int = PROJECTED) -> float:
    """x with P(chi-square of m degrees < x) = p, for even m."""
    def below(x: float) -> float:
        term = total = 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - exp(-x / 2) * total
    lo, hi = 0.0, 1.0
    while below(hi) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def projection(dim: int, m: int = PROJECTED) -> np.ndarray:
    return np.random.default_rng([dim, m]).standard_normal((dim, m))


class KDTree:
    """Median splits on the widest side down to leaves of ``leaf`` points at most, or
    ``cells`` leaves. Leaves are numbered; a split is (side, value, low, high)."""

    def __init__(self, points: np.ndarray, leaf: int, cells: int | None = None):
        self.splits: dict[int, tuple[int, float, int, int]] = {}
        self.leaf_of: dict[int, int] = {}
        self.members: list[np.ndarray] = []
        heap, nodes = [(-len(points), 0, np.arange(len(points)))], 1
        while heap:                                     # the largest leaf is split next
            _, node, who = heapq.heappop(heap)
            side = -1
            if len(who) > leaf and (cells is None or len(self.members) + len(heap) + 1 < cells):
                part = points[who]
                spread = part.max(axis=0) - part.min(axis=0)
                side = int(np.argmax(spread)) if spread.max() > 0 else -1
            if side >= 0:
                x = part[:, side]
                value = float(np.median(x))
                low = x <= value
                if low.all():                           # the median is the largest value
                    value = float(x[x < value].max())
                    low = x <= value
                self.splits[node] = (side, value, nodes, nodes + 1)
                heapq.heappush(heap, (-int(low.sum()), nodes, who[low]))
                heapq.heappush(heap, (-int((~low).sum()), nodes + 1, who[~low]))
                nodes += 2
            else:
                self.leaf_of[node] = len(self.members)
                self.members.append(who)

    def leaf(self, point: np.ndarray) -> int:
        node = 0
        while node in self.splits:
            side, value, low, high = self.splits[node]
            node = low if point[side] <= value else high
        return self.leaf_of[node]

    def nearest_leaves(self, point: np.ndarray):
        """(squared distance of its region, leaf), nearest first."""
        heap = [(0.0, 0, (0.0,) * len(point))]          # distance, node, its share on each side
        while heap:
            far, node, shares = heapq.heappop(heap)
            if node in self.leaf_of:
                yield far, self.leaf_of[node]
                continue
            side, value, low, high = self.splits[node]
            gap = float(point[side]) - value
            near, other = (low, high) if gap <= 0 else (high, low)
            heapq.heappush(heap, (far, near, shares))
            share = max(shares[side], gap * gap)
            heapq.heappush(heap, (far - shares[side] + share, other, shares[:side] + (share,) + shares[side + 1:]))


class Shard:
    """The vectors of one shard with a kd-tree over their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, matrix: np.ndarray):
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.tree = KDTree((vectors / norms[:, None]) @ matrix, LEAF)
        order = np.concatenate(self.tree.members)            # a leaf's vectors side by side
        self.ids, self.vectors, self.norms = ids[order], np.ascontiguousarray(vectors[order]), norms[order]
        self.ends = np.cumsum([len(m) for m in self.tree.members]).tolist()

    def search(self, vector: np.ndarray, matrix: np.ndarray, k: int, bound: float, limit: float):
        """The k best (score, id) here; ``bound``: squared distance of a k-th known already."""
        norm = float(np.sqrt(vector @ vector))
        point = (vector / norm) @ matrix
        best: list[tuple[float, int]] = []
        reach = bound
        for far, leaf in self.tree.nearest_leaves(point):
            if far > reach * limit + 1e-9:                   # the chi-square test
                break
            end = self.ends[leaf]
            at = end - len(self.tree.members[leaf])
            scores = (self.vectors[at:end] @ vector) / (self.norms[at:end] * norm)
            # what cannot be among the k best is left before it is sorted
            enough = best[-1][0] if len(best) == k else (np.partition(scores, -k)[-k] if len(scores) > k else -2.0)
            better = np.flatnonzero(scores >= enough)
            if not len(better):
                continue
            best += zip(scores[better].tolist(), self.ids[at:end][better].tolist())
            best.sort(key=lambda x: (-x[0], x[1]))
            del best[k:]
            if len(best) == k:
                reach = min(bound, max(0.0, 2 - 2 * best[-1][0]))
        return best


def _usable(vec: Column) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vec.isNotNull() & (F.size(vec) > 0) & F.coalesce(fine, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def classes_of(vectors: DataFrame, keep: int) -> DataFrame:
    """(cid, vec, ids): one row per distinct vector, its smallest id and ``keep`` smallest."""
    by = Window.partitionBy("vec").orderBy("id")
    few = vectors.withColumn("rn", F.row_number().over(by)).filter(F.col("rn") <= keep)
    return few.groupBy("vec").agg(F.min("id").alias("cid"), F.sort_array(F.collect_list("id")).alias("ids"))


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
           vec_col: str = "embedding", confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for each query row, chosen
    by ``is_query`` (a condition on column ``id``), among all other rows."""
    spark = vectors.sparkSession
    usable = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
              .filter(F.col("id").isNotNull() & _usable(F.col("vec"))).distinct())
    classes = store(classes_of(usable, k + 1), "ann-classes")
    queries = store(usable.filter(is_query).join(classes.select("vec", "cid"), "vec").select("id", "cid"), "ann-queries")
    limit = chi2_quantile(confidence)

    # the upper splits, for each length of vector, from a bounded sample in hash order,
    # projected where it lies: PROJECTED numbers of a vector reach the driver
    count = classes.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    few = count.orderBy(F.desc("n"), "dim").limit(LENGTHS).collect()
    sizes = {r["dim"]: r["n"] for r in few}
    share = min(1.0, SAMPLE / max(1, sum(sizes.values())))
    chosen = classes.filter(F.pmod(F.xxhash64("cid"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)) \
        .select("vec").limit(2 * SAMPLE)

    def project(batches):
        for batch in batches:
            vecs = batch.column("vec").to_pylist()
            points = [(x / np.sqrt(x @ x)) @ projection(len(x)) for x in map(np.array, vecs)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(v) for v in vecs], pa.int32()), pa.array([p.tolist() for p in points], pa.list_(pa.float64()))],
                names=["dim", "point"])
    sample = chosen.mapInArrow(project, "dim int, point array<double>").collect()
    trees: dict[int, KDTree] = {}
    shards: dict[int, int] = {}
    for dim, n in sizes.items():
        points = np.array([r["point"] for r in sample if r["dim"] == dim], dtype=np.float64).reshape(-1, PROJECTED)
        cells = max(1, min(MAX_CELLS, -(-n // CELL_ROWS)))
        trees[dim] = KDTree(points, 1, cells)
        trees[dim].members = [m[:0] for m in trees[dim].members]      # only the splits are used
        shards[dim] = max(1, -(-n // (CELL_ROWS * len(trees[dim].members))))
    # any rarer length has one cell, of as many shards as the rarest of these would need
    other = KDTree(np.zeros((0, PROJECTED)), 1)
    rest = max(1, -(-min(sizes.values(), default=1) // CELL_ROWS))

    def place(batches):
        """Deals classes to their cells."""
        for batch in batches:
            cells = []
            for v in batch.column("vec").to_pylist():
                x = np.array(v)
                x = (x / np.sqrt(x @ x)) @ projection(len(x))
                cells.append(trees.get(len(v), other).leaf(x))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.int32()),
                 pa.array([c % shards.get(len(v), rest) for c, v in zip(batch.column("cid").to_pylist(),
                                                                     batch.column("vec").to_pylist())], pa.int32())],
                names=["cid", "vec", "cell", "shard"])
    placed = store(classes.select("cid", "vec").mapInArrow(
        place, "cid long, vec array<double>, cell int, shard int"), "ann-cells")
    asked = placed.join(queries.select("cid").distinct(), "cid").select("cid", "vec", "cell")

    def routes(batches):
        """Cells that a query must still see, past its own, given its k-th distance so far."""
        for batch in batches:
            out = []
            for cid, vec, cell, bound in zip(*(batch.column(c).to_pylist() for c in ("cid", "vec", "cell", "bound"))):
                x = np.array(vec)
                x = (x / np.sqrt(x @ x)) @ projection(len(x))
                for far, leaf in trees.get(len(vec), other).nearest_leaves(x):
                    if far > bound * limit + 1e-9:
                        break
                    if leaf != cell:
                        out.append((cid, vec, leaf, bound))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.list_(pa.float64()), pa.int32(), pa.float64()))], names=["cid", "vec", "cell", "bound"])

    def visit(wanted: DataFrame) -> DataFrame:
        """(cid, other, score): the k + 1 best of each cell's shards for its queries. A
        shard's vectors come first, then its queries in a stream."""
        n_shards = F.create_map(*[F.lit(x) for d, n in (shards or {0: 1}).items() for x in (d, n)])
        ask = wanted.withColumn("n_shards", F.coalesce(F.try_element_at(n_shards, F.size("vec")), F.lit(rest))) \
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)))
        rows = placed.select(F.size("vec").alias("dim"), "cell", "shard", F.lit(0).alias("kind"), "cid", "vec",
                             F.lit(0.0).alias("bound")) \
            .union(ask.select(F.size("vec"), "cell", "shard", F.lit(1), "cid", "vec", "bound"))

        def run(batches):
            key, ids, vecs, shard, matrix = None, [], [], None, None
            for batch in batches:
                out = []
                cols = [batch.column(c).to_pylist() for c in ("dim", "cell", "shard", "kind", "cid", "vec", "bound")]
                for dim, cell, no, kind, cid, vec, bound in zip(*cols):
                    if key != (dim, cell, no):
                        key, ids, vecs, shard, matrix = (dim, cell, no), [], [], None, projection(dim)
                    if kind == 0:
                        ids.append(cid)
                        vecs.append(vec)
                        continue
                    if shard is None and ids:
                        shard = Shard(np.array(ids), np.array(vecs, dtype=np.float64), matrix)
                        ids, vecs = [], []
                    if shard is not None:
                        found = shard.search(np.array(vec), matrix, k + 1, bound, limit)
                        out += [(cid, other_id, score) for score, other_id in found]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.int64(), pa.float64()))], names=["cid", "other", "score"])
        by = ["dim", "cell", "shard"]
        return (rows.repartition(*by).sortWithinPartitions(*by, "kind")
                .mapInArrow(run, "cid long, other long, score double"))

    best = Window.partitionBy("cid").orderBy(F.desc("score"), "other")
    first = store(visit(asked.withColumn("bound", F.lit(4.0)))
                  .withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= k + 1), "ann-home")
    bounds = first.filter(F.col("rn") == k + 1).select("cid", F.greatest(F.lit(0.0), 2 - 2 * F.col("score")).alias("bound"))
    further = asked.join(bounds, "cid", "left").withColumn("bound", F.coalesce("bound", F.lit(4.0))) \
        .select("cid", "vec", "cell", "bound") \
        .mapInArrow(routes, "cid long, vec array<double>, cell int, bound double")
    found = (first.select("cid", "other", "score").union(visit(further))
             .withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= k + 1).drop("rn"))
    ids = found.join(classes.select(F.col("cid").alias("other"), "ids"), "other") \
        .select("cid", "score", F.explode("ids").alias("vec_id"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (queries.join(ids, "cid").filter("vec_id <> id")
            .select(F.col("id").alias("query_id"), "vec_id", "score")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
