"""Vector compression by product quantisation, in exact integers, on Hilbert-sorted blocks.

Vectors are cut into equal parts, and each part position has a codebook, fitted by rounds
that assign every part to its nearest entry and move each entry to the floor of its parts'
mean. All arithmetic is on integers, so results do not depend on how rows are dealt out.

1. ``blocks``: in one pass, each slice of some thousand vectors is sorted along a Hilbert
   curve, for every part position by itself, and cut into flat blocks of BLOCK parts; the
   slice is stored as one row with the sorted parts and, for each block, its min/max box and
   the sums of its parts. No vector is shuffled, in this pass or later.
2. Each round reads the stored blocks. The distances between a block's box and the entries
   bound what its parts may be assigned to: entries nearer at best than some entry is at
   worst are the block's shortlist. A shortlist of one settles the block by its sums alone;
   otherwise a small integer kernel compares the block's parts with its shortlist only.
   A task adds up its blocks, Spark adds up the tasks, the driver sees entries x components
   numbers.
3. A last pass assigns the parts again, and puts the codes back into row order.

Defined results: rows whose vector is null or holds null or non-finite components are
dropped; so are vectors of another length than the commonest that divides into the parts.
Rows with null id are kept, and come last among the first vectors of a codebook; rows that
repeat an id go by their vectors there, and give repeated rows. Fewer vectors than entries
make a codebook of that many entries. Integer components are held to +-limit(length), far
beyond any embedding's, where squared distances still fit a long; an error summed over
labels that does not is the largest long. Null labels are one label. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.functions.hot import join_unique
from snapfold.functions.joins import plain_keys, restored
from snapfold.llm.common import commonest_length, finite, matrix_of, store

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK = 32                  # parts of a block
SLICE_VALUES = 1 << 17      # components of a slice, at most (one vector at least)
KERNEL_VALUES = 1 << 18     # differences that a kernel holds at once, about
LONG = (1 << 63) - 1


def limit(dim: int) -> int:
    """The largest component for which any squared distance fits a long."""
    return isqrt(LONG // dim) // 2


def integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    most = limit(vectors.shape[1])
    with np.errstate(over="ignore"):            # a product beyond doubles is held too
        return np.clip(np.floor(vectors * scale), -most, most).astype(np.int64)


# ---- Hilbert order

def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on a Hilbert curve of points with coordinates under 2**bits (rows x at most
    64 // bits coordinates), by Skilling's transposed form."""
    x = [points[:, k].astype(np.uint64) for k in range(points.shape[1])]
    one, zero = np.uint64(1), np.uint64(0)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for k in range(len(x)):
            turned = (x[k] & bit) != 0
            swap = np.where(turned, zero, (x[0] ^ x[k]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
    for k in range(1, len(x)):
        x[k] = x[k] ^ x[k - 1]
    last = np.zeros(len(points), dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        last = np.where((x[-1] & np.uint64(1 << level)) != 0, last ^ np.uint64((1 << level) - 1), last)
    key = np.zeros(len(points), dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for c in x:
            key = (key << one) | (((c ^ last) >> np.uint64(level)) & one)
    return key


def hilbert_order(part: np.ndarray) -> np.ndarray:
    """The rows of a part along the curve: coordinates from the smallest up, cut to the bits
    that 64 leave each of them (of very long parts the first 64 coordinates)."""
    part = part[:, :64]
    bits = max(1, min(8, 64 // part.shape[1]))
    up = part - part.min(axis=0)
    shift = max(0, int(up.max()).bit_length() - bits)
    return np.argsort(hilbert_keys(up >> shift, bits), kind="stable")


class Slice:
    """One slice's sorted parts and blocks: ``parts`` (position, row, component), ``order``
    (position, row) with the row's place in the slice, ``low``, ``high`` and ``sums``
    (position, block, component)."""

    FIELDS = (("parts", np.int32), ("order", np.int32), ("low", np.int32), ("high", np.int32), ("sums", np.int64))

    def __init__(self, parts, order, low, high, sums):
        self.parts, self.order, self.low, self.high, self.sums = parts, order, low, high, sums

    @classmethod
    def of(cls, ints: np.ndarray, positions: int) -> Slice:
        n, width = len(ints), ints.shape[1] // positions
        cut = ints.reshape(n, positions, width).transpose(1, 0, 2)
        order = np.stack([hilbert_order(p) for p in cut])
        parts = np.take_along_axis(cut, order[:, :, None], axis=1)
        starts = np.arange(0, n, BLOCK)
        return cls(parts, order, np.minimum.reduceat(parts, starts, axis=1), np.maximum.reduceat(parts, starts, axis=1),
                   np.add.reduceat(parts, starts, axis=1))

    def packed(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, f), dtype=t).tobytes() for f, t in self.FIELDS]

    @classmethod
    def unpacked(cls, raw: list[bytes], positions: int, n: int) -> Slice:
        parts, order, low, high, sums = (np.frombuffer(r, dtype=t) for r, (_, t) in zip(raw, cls.FIELDS))
        boxes = (positions, -(-n // BLOCK), -1)
        return cls(parts.reshape(positions, n, -1).astype(np.int64), order.reshape(positions, n),
                   low.reshape(boxes).astype(np.int64), high.reshape(boxes).astype(np.int64), sums.reshape(boxes))


def shortlists(entries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(block, entry): the entries that some part within the box may be nearest to. Entries
    that tie with the best stay."""
    e, low, high = entries[None], low[:, None], high[:, None]
    gap = np.maximum(np.maximum(low - e, e - high), 0)
    far = np.maximum(np.abs(e - low), np.abs(high - e))
    return (gap * gap).sum(axis=2) <= (far * far).sum(axis=2).min(axis=1, keepdims=True)


def nearest(entries: np.ndarray, parts: np.ndarray, low: np.ndarray, high: np.ndarray,
            settle: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """(entry of each row, its squared distance, entry of each block or -1). With ``settle``
    blocks whose shortlist is one entry are left out of the rows (their entry is there all
    the same) and no distances are made."""
    n, width = parts.shape
    lists = shortlists(entries, low, high)
    size = lists.sum(axis=1)
    alone = np.where(size == 1, lists.argmax(axis=1), -1)
    chosen = np.repeat(np.maximum(alone, 0), BLOCK)[:n]
    far = None if settle else np.zeros(n, dtype=np.int64)
    if not settle:
        off = parts - entries[chosen]
        far = (off * off).sum(axis=1)
    wide = 1
    while wide < len(entries):                      # blocks by the length of their shortlists
        wide *= 2
        some = np.flatnonzero((size > wide // 2) & (size <= wide))
        step = max(1, KERNEL_VALUES // (BLOCK * min(wide, len(entries)) * width))
        for at in range(0, len(some), step):
            blocks = some[at:at + step]
            rows = np.minimum(blocks[:, None] * BLOCK + np.arange(BLOCK), n - 1)
            own = np.argsort(~lists[blocks], axis=1, kind="stable")[:, :wide]       # the shortlist, ascending, first
            off = parts[rows][:, :, None, :] - entries[own][:, None, :, :]
            distance = (off * off).sum(axis=3)
            best = distance.argmin(axis=2)
            chosen[rows] = np.take_along_axis(own, best, axis=1)
            if far is not None:
                far[rows] = np.take_along_axis(distance, best[:, :, None], axis=2)[:, :, 0]
    return chosen, far, alone


def tally(s: Slice, books: np.ndarray, count: np.ndarray, total: np.ndarray) -> None:
    """Adds a slice's parts to ``count`` (position, entry) and ``total`` (position, entry,
    component), by the nearest entries of ``books``."""
    n = s.parts.shape[1]
    full = np.minimum(BLOCK, n - np.arange(0, n, BLOCK))
    for p, book in enumerate(books):
        chosen, _, alone = nearest(book, s.parts[p], s.low[p], s.high[p], settle=True)
        whole = np.flatnonzero(alone >= 0)
        np.add.at(count[p], alone[whole], full[whole])
        np.add.at(total[p], alone[whole], s.sums[p][whole])
        rest = np.flatnonzero(np.repeat(alone < 0, BLOCK)[:n])
        np.add.at(count[p], chosen[rest], 1)
        np.add.at(total[p], chosen[rest], s.parts[p][rest])


# ---- on Spark

def kept_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    label = F.col(label_col) if label_col in vectors.columns else F.lit(None).cast("int")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    return rows.filter(finite(F.col("vec")))


def blocks(rows: DataFrame, dim: int, parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """A row per slice: members (vec_id, label) in row order, and the fields of ``Slice``."""
    size = max(1, SLICE_VALUES // dim)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                some = batch.slice(at, size)
                n = some.num_rows
                member = pa.StructArray.from_arrays([some.column("vec_id"), some.column("label")], ["vec_id", "label"])
                raw = Slice.of(integers(matrix_of(some.column("vec"), dim), scale), parts).packed()
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), member), *[pa.array([r], pa.binary()) for r in raw]],
                    names=["members", *[f for f, _ in Slice.FIELDS]])
    label = rows.schema["label"].dataType.simpleString()
    schema = f"members array<struct<vec_id:bigint,label:{label}>>, " + ", ".join(f"{f} binary" for f, _ in Slice.FIELDS)
    return rows.select("vec_id", "label", "vec").mapInArrow(run, schema)


def _slices(batch, positions: int):
    for k in range(batch.num_rows):
        n = len(batch.column("members")[k])
        yield k, Slice.unpacked([batch.column(f)[k].as_buffer() for f, _ in Slice.FIELDS], positions, n)


def moved(sliced: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all parts; unused entries stay."""
    positions, entries, width = books.shape

    def run(batches):
        count = np.zeros((positions, entries), dtype=np.int64)
        total = np.zeros((positions, entries, width), dtype=np.int64)
        for batch in batches:
            for _, s in _slices(batch, positions):
                tally(s, books, count, total)
        p, e = np.nonzero(count)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(p, width)), pa.array(np.repeat(e, width)), pa.array(np.tile(np.arange(width), len(p))),
                 pa.array(np.repeat(count[p, e], width)), pa.array(total[p, e].ravel())], names=["p", "e", "c", "n", "total"])
    sums = (sliced.select(F.transform("members", lambda m: m["vec_id"]).alias("members"), *[f for f, _ in Slice.FIELDS])
            .mapInArrow(run, "p long, e long, c long, n long, total long").groupBy("p", "e", "c")
            .agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
    out = books.copy()
    for r in sums.collect():
        out[r["p"], r["e"], r["c"]] = int(r["total"]) // r["n"]
    return out


def coded(sliced: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    positions = len(books)

    def run(batches):
        for batch in batches:
            for k, s in _slices(batch, positions):
                member = batch.column("members").slice(k, 1).flatten()
                n = len(member)
                codes, error = np.zeros((n, positions), dtype=np.uint8), np.zeros(n, dtype=np.int64)
                for p, book in enumerate(books):
                    chosen, far, _ = nearest(book, s.parts[p], s.low[p], s.high[p], settle=False)
                    codes[s.order[p], p] = chosen
                    error[s.order[p]] += far
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [*member.flatten(), pa.array([text[i:i + 2 * positions] for i in range(0, len(text), 2 * positions)]),
                     pa.array(error)], names=["vec_id", "label", "code", "error"])
    label = sliced.schema["members"].dataType.elementType["label"].dataType.simpleString()
    return sliced.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error, label_error) of every kept vector, the codebooks as
    (position, entry, component)). At most 256 entries: a code is two hex digits a part."""
    if not 0 < entries <= 256:
        raise ValueError("1 to 256 entries")
    rows = kept_vectors(vectors, id_col, vec_col, label_col)
    dim = commonest_length(rows, "vec", parts)
    rows = rows.filter(F.size("vec") == dim)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).select("vec").collect() if dim else []
    if not first:
        empty = rows.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long")
        return (empty.withColumn("label", F.lit(None).cast(rows.schema["label"].dataType)), np.zeros((parts, 0, 0), dtype=np.int64))
    books = integers(np.array([r["vec"] for r in first]), scale).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    sliced = store(blocks(rows, dim, parts, scale), "vector-blocks")
    for _ in range(rounds):
        books = moved(sliced, books)
    out, keys = plain_keys(coded(sliced, books), ["label"])
    out = store(out, "vector-codes")
    held = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    of_label = store(out.groupBy(*keys).agg(held.alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    whole = join_unique(out, of_label.drop("n"), keys, counts=of_label.select(*keys, "n"))
    return whole.select("vec_id", *restored(["label"]), "code", "error", "label_error"), books


def books_sha256(books: np.ndarray) -> str:
    """Digest of all components, by part, entry and place within the part."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
