"""Benchmark decontamination with an FM-index over each shard of the training texts.

A test phrase is ``window`` consecutive words of a benchmark item, or all words of a
shorter one. Every place of a document where a phrase stands is found:

1. ``Phrases``: the distinct phrases of a block of items, their vocabulary, and which items
   hold each of them. Items are cut into pieces that overlap by a phrase less a word, and
   pieces are dealt by hash into blocks of some BLOCK_CHARS characters: that bounds what is
   sent to the tasks, whatever the benchmark holds.
2. A task takes its documents in shards of some SHARD_BYTES. Words become numbers; words that no
   phrase has become separators, since no phrase can cross them, and runs too short for
   any phrase are left out. ``FMIndex``: the suffix array of what is left, by prefix doubling;
   the Burrows-Wheeler transform in a wavelet matrix, with rank tables; every STEP-th
   suffix position and each run's start, sampled.
3. Backward search takes all phrases of one length at once, a word a step, each word two
   ranks down the wavelet levels. Matching rows are located by walking back to the next
   sampled position.
4. Places that overlap or touch are merged into removal spans of words.

With one block nothing is shuffled; further blocks add rows for the documents that they
hit, gathered by row. A very long text is read in chunks, and a shard is at most one
document more than SHARD_BYTES; longer documents are cut into overlapping pieces.

Defined results: null and empty texts have no words; items without words have no phrase;
items that share an id are one item, a null id is written ``null``; repeated rows give
repeated rows; null doc_ids are kept; other columns are ignored, or kept by ``clean``,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapfold.llm.common import OWN, batch_of, boxed, map_slices, store, unboxed
from snapfold.session import scratch_path

WINDOW = 10
SHARD_BYTES = 8 << 20           # text of a shard, about
PIECE_WORDS = 1 << 20           # words of a document in one shard, at most
CHUNK = 1 << 22                 # bytes of a text cut into words at once
ITEM_PIECE = 4096               # words of a piece of a benchmark item
BLOCK_CHARS = 4 << 20           # characters of the pieces that tasks load at once, about
STEP = 8                        # every so many suffix positions are sampled

# bytes of words as they are, A-Z in lower case, all others a space
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def word_chunks(raw: bytes):
    """The words of a text, as lists of some CHUNK bytes."""
    at = 0
    while at < len(raw):
        to = at + CHUNK
        part = raw[at:to].translate(TABLE)
        if to < len(raw):                       # up to the last whole word, or to the end of a longer one
            cut = part.rfind(b" ")
            while cut < 0 and to < len(raw):
                to += CHUNK
                part = raw[at:to].translate(TABLE)
                cut = part.rfind(b" ") if to < len(raw) else len(part)
            part, to = part[:cut], at + cut
        yield part.split()
        at = max(to, at + 1)


# ---- phrases

class Phrases:
    """Distinct phrases, by length: (number of the first, k x length array of word numbers from
    1). The items that hold phrase p are ``items[starts[p]:starts[p + 1]]``, places in ``names``."""

    def __init__(self, pieces: list[tuple[str, list[bytes]]], window: int):
        self.words: dict[bytes, int] = {}
        known: dict[str, int] = {}
        rows: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for name, words in pieces:
            if not words:
                continue
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in words], dtype=np.int32)
            size = min(window, len(ids))
            found = np.lib.stride_tricks.sliding_window_view(ids, size)
            rows.setdefault(size, []).append(found)
            owners.setdefault(size, []).append(np.full(len(found), known.setdefault(name, len(known))))
        self.names = list(known)
        self.by_length: list[tuple[int, np.ndarray]] = []
        count, items, holds = 0, [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for size in sorted(rows):
            phrases, which = np.unique(np.concatenate(rows[size]), axis=0, return_inverse=True)
            pairs = np.unique(which.ravel() * len(known) + np.concatenate(owners[size]))
            self.by_length.append((count, phrases))
            holds.append(np.bincount(pairs // len(known), minlength=len(phrases)))
            items.append(pairs % len(known))
            count += len(phrases)
        self.items = np.concatenate(items)
        self.starts = np.concatenate([[0], np.cumsum(np.concatenate(holds))])
        self.shortest = min(rows, default=0)
        self.longest = max(rows, default=0)


# ---- the index

def suffix_array(text: np.ndarray, top: int) -> np.ndarray:
    """Order of the suffixes of ``text`` (numbers up to ``top``, 0 a separator, the last one
    too): separators are all different and ordered by their places, below any word."""
    n, bits = len(text), max(1, int(top).bit_length())
    width = max(1, min(8, 62 // bits))
    key, going = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for k in range(width):                              # the first words in one number
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:max(0, n - k)] = text[k:]
        ahead[~going] = 0
        key = (key << bits) | ahead
        going &= ahead != 0
    order = np.argsort(key, kind="stable")              # suffixes that have ended go by place
    rank = np.empty(n, dtype=np.int64)
    sorted_key, ended = key[order], ~going[order]
    first = np.ones(n, dtype=bool)
    first[1:] = (sorted_key[1:] != sorted_key[:-1]) | ended[1:]
    head = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[order] = head
    tied = np.flatnonzero(~first | np.append(~first[1:], False))
    while len(tied):                                    # prefix doubling of what is still equal
        at = order[tied]
        pair = rank[at] * n + rank[at + width]
        sub = np.argsort(pair, kind="stable")
        at, pair = at[sub], pair[sub]
        order[tied] = at
        new = np.ones(len(at), dtype=bool)
        new[1:] = pair[1:] != pair[:-1]
        rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        tied = tied[~new | np.append(~new[1:], False)]
        width *= 2
    return order


class WaveletMatrix:
    """Rank and access over numbers up to ``top``: a bit table for each level, with the ones
    before every place."""

    def __init__(self, values: np.ndarray, top: int):
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bit = (values >> level) & 1
            ones = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])
        # where each number's places start on the last level
        self.start = self._down(np.arange(top + 1), np.zeros(top + 1, dtype=np.int64))

    def _down(self, c: np.ndarray, place: np.ndarray) -> np.ndarray:
        top = len(self.ones) - 1
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            before = ones[place]
            place = np.where((c >> (top - k)) & 1, zeros + before, place - before)
        return place

    def rank(self, c: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often c[k] stands before place[k]."""
        return self._down(c, place) - self.start[c]

    def access(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number at each place, its rank there)."""
        c = np.zeros(len(place), dtype=np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            before = ones[place]
            one = ones[place + 1] > before
            c = (c << 1) | one
            place = np.where(one, zeros + before, place - before)
        return c, place - self.start[c]


class FMIndex:
    def __init__(self, text: np.ndarray, top: int):
        order = suffix_array(text, top)
        self.n = len(text)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])[:top + 1]
        self.wavelet = WaveletMatrix(text[order - 1].astype(np.int64), top)     # before place 0 stands the last, 0
        marked = (order % STEP == 0) | (text[order - 1] == 0)
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.sampled = order[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which phrase, first row, row after the last) of those that occur."""
        who = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n)
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[who, k]
            low = self.smaller[c] + self.wavelet.rank(c, low)
            high = self.smaller[c] + self.wavelet.rank(c, high)
            there = low < high
            who, low, high = who[there], low[there], high[there]
        return who, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The suffix position of each row."""
        out = np.empty(len(rows), dtype=np.int64)
        going, steps = np.arange(len(rows)), 0
        while len(going):
            known = self.marks[rows + 1] > self.marks[rows]
            out[going[known]] = self.sampled[self.marks[rows[known]]] + steps
            going, rows = going[~known], rows[~known]
            if len(going):
                c, rank = self.wavelet.access(rows)
                rows = self.smaller[c] + rank
            steps += 1
        return out


# ---- a shard

def runs_of(words: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in text, place in words of each run): the runs of at least ``shortest``
    known words, each followed by a separator."""
    known = np.concatenate([[False], words != 0, [False]])
    edge = np.flatnonzero(known[1:] != known[:-1])
    start, end = edge[::2], edge[1::2]
    long = end - start >= shortest
    start, size = start[long], (end - start)[long]
    at = np.concatenate([[0], np.cumsum(size + 1)])
    text = np.zeros(at[-1], dtype=np.int32)
    if len(start):
        inside = np.ones(at[-1], dtype=bool)
        inside[at[1:] - 1] = False
        text[inside] = words[np.repeat(start - at[:-1], size) + np.flatnonzero(inside)]
    return text, at[:-1], start


def occurrences(words: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, phrase, its length) of every place in ``words`` where a phrase stands."""
    text, at, start = runs_of(words, max(1, phrases.shortest))
    none = np.zeros(0, dtype=np.int64)
    if not len(text) or not phrases.by_length:
        return none, none, none
    index = FMIndex(text, len(phrases.words))
    places, which, sizes = [], [], []
    for first, some in phrases.by_length:
        who, low, high = index.search(some)
        n = high - low
        rows = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        place = index.locate(rows)
        run = np.searchsorted(at, place, side="right") - 1
        places.append(place - at[run] + start[run])
        which.append(first + np.repeat(who, n))
        sizes.append(np.full(len(place), some.shape[1]))
    return np.concatenate(places), np.concatenate(which), np.concatenate(sizes)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


class Shard:
    """Texts added one by one, then searched together."""

    def __init__(self, phrases: Phrases):
        self.phrases, self.size = phrases, 0
        self.counts: list[int] = []                     # words of each text
        self.parts: list[tuple[int, int, np.ndarray]] = []      # (text, its word there, word numbers)

    def add(self, raw: bytes | None) -> None:
        doc, n, kept = len(self.counts), 0, []
        number, zero = self.phrases.words.get, 0
        for words in word_chunks(raw or b""):
            kept.append(np.fromiter((number(w, zero) for w in words), dtype=np.int32, count=len(words)))
            n += len(words)
        ids = np.concatenate(kept) if len(kept) > 1 else kept[0] if kept else np.zeros(0, dtype=np.int32)
        lap = max(1, self.phrases.longest) - 1
        for at in range(0, max(1, n - lap), PIECE_WORDS):
            self.parts.append((doc, at, ids[at:at + PIECE_WORDS + lap]))
        self.counts.append(n)
        self.size += len(raw or b"")

    def found(self) -> list[tuple[list[str], list[tuple[int, int]]]]:
        """(items, removal spans) of each text."""
        out: list[tuple[list[str], list[tuple[int, int]]]] = [([], []) for _ in self.counts]
        groups, group, held = [], [], 0
        for part in self.parts:                         # indexes of a bounded number of words
            if group and held + len(part[2]) > PIECE_WORDS:
                groups.append(group)
                group, held = [], 0
            group.append(part)
            held += len(part[2])
        groups.append(group)
        hits: dict[int, tuple[set[int], list[tuple[int, int]]]] = {}
        for group in groups:
            if not group:
                continue
            size = np.array([len(ids) + 1 for _, _, ids in group])
            begin = np.cumsum(size) - size
            words = np.zeros(size.sum(), dtype=np.int32)
            for at, (_, _, ids) in zip(begin, group):
                words[at:at + len(ids)] = ids
            place, phrase, length = occurrences(words, self.phrases)
            if not len(place):
                continue
            change = np.zeros(len(words) + 1, dtype=np.int32)
            np.add.at(change, place, 1)
            np.add.at(change, place + length, -1)
            cover = np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])
            edge = np.flatnonzero(cover[1:] != cover[:-1])
            for start, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
                k = int(np.searchsorted(begin, start, side="right")) - 1
                doc, off, _ = group[k]
                hits.setdefault(doc, (set(), []))[1].append((start - int(begin[k]) + off, end - int(begin[k]) + off))
            of = np.searchsorted(begin, place, side="right") - 1
            many = len(self.phrases.starts)
            for code in np.unique(of * many + phrase).tolist():
                k, p = divmod(code, many)
                s = self.phrases.starts
                hits[group[k][0]][0].update(self.phrases.items[s[p]:s[p + 1]].tolist())
        for doc, (items, spans) in hits.items():
            out[doc] = (sorted(self.phrases.names[i] for i in items), _merged(spans))
        return out


# ---- on Spark

SPANS = "array<struct<start:bigint,end:bigint>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def pieces_of(benchmark: DataFrame, window: int, id_col: str, text_col: str, piece: int = ITEM_PIECE) -> DataFrame:
    """(item, words): the items' words, joined by spaces, in pieces of which each phrase of an
    item lies in one. Repeated pieces of an item are there once."""
    def make():
        def run(batch):
            names, texts = [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = [w for some in word_chunks(text) for w in some]
                step = max(1, piece - window + 1)
                for at in range(0, max(1, len(words) - window + 1), step) if words else ():
                    names.append(item)
                    texts.append(b" ".join(words[at:at + step + window - 1]).decode("utf-8", "surrogatepass"))
            return batch_of({"item": (names, pa.string()), "words": (texts, pa.string())})
        return run
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                             F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return map_slices(items, make, "item string, words string").distinct()


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text",
                  block_chars: int = BLOCK_CHARS):
    """``Phrases`` of one block after another; the driver holds one."""
    pieces = store(pieces_of(benchmark, window, id_col, text_col), "benchmark-pieces")
    chars = pieces.agg(F.sum(F.octet_length("words") + F.octet_length("item"))).first()[0] or 0
    count = max(1, -(-chars // block_chars))
    for k in range(count):
        rows = pieces.filter(F.pmod(F.xxhash64("item", "words"), F.lit(count)) == k).collect()
        found = sorted((r["item"], r["words"].encode("utf-8", "surrogatepass").split()) for r in rows)
        yield count, Phrases(found, window)


def scan(texts: DataFrame, phrases: Phrases, kept: list[str]) -> DataFrame:
    """Columns ``kept`` of every row of ``texts``, n_words, items and spans."""
    def run(batches):
        shard, rows = Shard(phrases), []

        def done():
            found = shard.found()
            cols = {c: pa.concat_arrays([b.column(c) for b in rows]) for c in kept}
            return batch_of(cols | {
                "n_words": (shard.counts, pa.int64()), "items": ([i for i, _ in found], pa.list_(pa.string())),
                "spans": ([[{"start": a, "end": b} for a, b in s] for _, s in found], pa.list_(_SPAN))})
        for batch in batches:
            first = 0
            for at, raw in enumerate(batch.column("text")):     # one text at a time
                shard.add(raw.as_py())
                if shard.size >= SHARD_BYTES:
                    rows.append(batch.slice(first, at + 1 - first))
                    yield done()
                    shard, rows, first = Shard(phrases), [], at + 1
            if first < batch.num_rows:
                rows.append(batch.slice(first))
        if rows:
            yield done()
    schema = StructType([texts.schema[c] for c in kept] + StructType.fromDDL(
        f"n_words long, items array<string>, spans {SPANS}").fields)
    return texts.select(*kept, F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _across_blocks(texts: DataFrame, benchmark: DataFrame, window: int, id_col: str, text_col: str, kept: list[str],
                   block_chars: int) -> DataFrame:
    blocks = phrase_blocks(benchmark, window, id_col, text_col, block_chars)
    count, phrases = next(blocks)
    if count == 1:
        return scan(texts, phrases, kept)
    # rows are numbered in a stored copy; each block adds what it hits
    texts = store(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
    path = scratch_path(texts.sparkSession, "hits")
    scan(texts, phrases, ["row"]).write.parquet(path)           # all rows, for their words
    for _, more in blocks:
        scan(texts, more, ["row"]).filter(F.size("spans") > 0).write.mode("append").parquet(path)
    hits = texts.sparkSession.read.parquet(path).groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    joined = F.aggregate("spans", F.array().cast(SPANS), lambda out, s: F.when(
        (F.size(out) > 0) & (F.element_at(out, -1)["end"] >= s["start"]),
        F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(
            F.element_at(out, -1)["start"].alias("start"), F.greatest(F.element_at(out, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(out, F.array(s))))
    return texts.select("row", *kept).join(hits.withColumn("spans", F.when(F.size("spans") > 0, joined)
                                                           .otherwise(F.col("spans"))), "row").drop("row")


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n_words, items, spans): for every row of ``docs`` its words, the items with a
    phrase in it, sorted, and the removal spans, as words from 0, ends exclusive."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _across_blocks(texts, benchmark, window, item_col, item_text_col, ["doc_id"], block_chars)


def cut_out(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``raw`` without the words of the spans and what stands between them."""
    plain = np.frombuffer(raw.translate(TABLE), dtype=np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate([[False], plain, [False]]).astype(np.int8)))
    out, at = [], 0
    for start, end in spans:
        out.append(raw[at:edge[2 * start]])
        at = int(edge[2 * end - 1])
    return b"".join(out) + raw[at:]


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All rows and columns of ``docs``, the removal spans cut out of their texts."""
    columns = docs.columns
    texts = docs.select(boxed(docs), F.col(text_col).cast("string").alias("text"))
    found = store(_across_blocks(texts, benchmark, window, item_col, item_text_col, [OWN], block_chars), "scanned")

    def make():
        def run(batch):
            own = batch.column(OWN)
            fields = dict(zip(columns, own.flatten()))
            texts = [None if t is None else cut_out(t, [(s["start"], s["end"]) for s in spans]).decode("utf-8", "surrogatepass")
                     for t, spans in zip(fields[text_col].cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist())]
            fields[text_col] = pa.array(texts, own.type.field(columns.index(text_col)).type)
            return batch_of({OWN: pa.StructArray.from_arrays(list(fields.values()), fields=list(own.type))})
        return run
    hit = map_slices(found.filter(F.size("spans") > 0).select(OWN, "spans"), make, StructType([found.schema[OWN]]))
    return unboxed(hit.unionByName(found.filter(F.size("spans") == 0).select(OWN)), columns)
