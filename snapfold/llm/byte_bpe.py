"""Byte-level BPE encoding and decoding by a rank file.

Text is cut by the tokenizer's pattern; each match is merged on its own. Merges are
picked by a rank queue: one bucket of linked-list positions per merge rank and a
hierarchical bitmap of the non-empty buckets, whose find-first-set gives the lowest
rank in one word read per level. An entry whose pair has changed since it was queued
is stale and skipped, so a pre-token of n bytes takes O(n log n) however long it is.

Defined results: null and empty texts have no ids and decode to no bytes; repeated
rows give repeated rows; a null doc_id is carried; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import batch_of, id_text, map_slices

# white space as the pattern's engine has it (fixed value); Python's has more
_W = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNIT = f" ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]+"

WORD_BITS = 256
BIT = [1 << k for k in range(WORD_BITS)]
# units and pre-tokens that a worker remembers, in each of two generations
CACHED = 350_000
LONGEST = 48             # characters of one, at most


class Ranks:
    """A rank file: token bytes by rank, and the rank that each pair of tokens merges to."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            lines = [line.split() for line in f if line.strip()]
        self.rank = {base64.b64decode(tok): int(r) for tok, r in lines}
        self.size = size = max(self.rank.values()) + 1
        self.token: list[bytes | None] = [None] * size
        for tok, r in self.rank.items():
            self.token[r] = tok
        self._pairs: dict[int, int] = {}

    @property
    def pairs(self) -> dict[int, int]:
        """Rank of token a followed by token b, by a * size + b."""
        if not self._pairs:
            rank, size = self.rank, self.size
            for tok, r in rank.items():
                for k in range(1, len(tok)):
                    a, b = rank.get(tok[:k]), rank.get(tok[k:])
                    if a is not None and b is not None:
                        self._pairs[a * size + b] = r
        return self._pairs


class Merger:
    """Merges pre-tokens with a rank queue over their linked positions: ``buckets[r]``
    lists the positions whose pair merges to rank r; ``words`` and ``top`` are the two
    levels of a bitmap of the ranks that have a bucket. Many short pre-tokens share one
    queue: the lists of different ones are not linked, so each is merged as if alone."""

    def __init__(self, ranks: Ranks):
        self.rank, self.size = ranks.rank, ranks.size
        self.pairs = ranks.pairs
        self.of_byte = np.array([self.rank[bytes([c])] for c in range(256)])
        self.byte_pairs = np.array([[self.rank.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])

    def ids(self, pieces: list[bytes]) -> list[bytes]:
        """Each pre-token's ids as little-endian 32-bit integers."""
        known = self.rank.get
        whole = [known(p, -1) for p in pieces]
        parts = [p if r < 0 else b"" for p, r in zip(pieces, whole)]
        ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
        node = np.array(self._merge(np.frombuffer(b"".join(parts), dtype=np.uint8), ends), dtype="<i4")
        keep = node >= 0
        merged = node[keep].tobytes()
        cuts = (np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])] * 4).tolist()
        return [merged[i:j] if r < 0 else r.to_bytes(4, "little") for i, j, r in zip(cuts, cuts[1:], whole)]

    def _merge(self, data: np.ndarray, ends: np.ndarray) -> list[int]:
        """The token at each position after all merges, -1 where it went into its left.
        ``ends``: where pre-tokens end."""
        size, rank_of, n = self.size, self.pairs.get, len(data)
        node = self.of_byte[data].tolist()
        if not n:
            return node
        last = np.unique(ends[ends > 0]) - 1
        first = np.full(n, -1, dtype=np.int64)             # rank of a position and its right
        first[:-1] = self.byte_pairs[data[:-1], data[1:]]
        first[last] = -1
        pair = first.tolist()
        right = np.arange(1, n + 1)
        right[last] = -1                                   # no links between pre-tokens
        left = np.arange(-1, n - 1)
        left[last[:-1] + 1] = -1
        right, left = right.tolist(), left.tolist()
        words = [0] * (size // WORD_BITS + 1)
        top = 0
        live = np.flatnonzero(first >= 0)
        live = live[np.argsort(first[live], kind="stable")]
        ranks, at = np.unique(first[live], return_index=True)
        at, live = [*at.tolist(), len(live)], live.tolist()
        buckets: dict[int, list[int]] = {}
        for r, i, j in zip(ranks.tolist(), at, at[1:]):
            buckets[r] = live[i:j]
            words[r >> 8] |= BIT[r & 255]
            top |= 1 << (r >> 8)
        while top:
            w = (top & -top).bit_length() - 1          # find first set, level by level
            word = words[w]
            low = word & -word
            r = (w << 8) + low.bit_length() - 1
            bucket = buckets[r]
            bucket.sort()                              # the leftmost pair merges first
            first = r
            for at, i in enumerate(bucket):
                if pair[i] != r:
                    continue                           # stale: the pair has changed since
                j = right[i]
                node[i], node[j], pair[j] = r, -1, -1
                right[i] = k = right[j]
                if k >= 0:
                    left[k] = i
                    new = pair[i] = rank_of(r * size + node[k], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            buckets[new] = [i]
                            words[new >> 8] |= BIT[new & 255]
                            top |= 1 << (new >> 8)
                        if new < first:
                            first = new
                else:
                    pair[i] = -1
                h = left[i]
                if h >= 0:
                    new = pair[h] = rank_of(node[h] * size + r, -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(h)
                        else:
                            buckets[new] = [h]
                            words[new >> 8] |= BIT[new & 255]
                            top |= 1 << (new >> 8)
                        if new < first:
                            first = new
                if first < r:                          # a lower rank goes before the rest
                    break
            rest = bucket[at + 1:]
            if rest:
                buckets[r] = rest
            else:
                del buckets[r]
                words[w] ^= low
                if not words[w]:
                    top ^= 1 << w
        return node


@lru_cache(maxsize=4)
def load_ranks(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=2)
def load_encoder(path: str, pattern: str) -> Encoder:
    """One encoder, with what it remembers, for all tasks of a worker process."""
    return Encoder(path, pattern)


class Encoder:
    """Encodes texts unit by unit: a unit is a run without white space with at most one
    space before it, or other white space, cut as the pattern cuts it. No match of the
    pattern crosses the end of a unit, so units are encoded, and remembered, alone."""

    def __init__(self, path: str, pattern: str):
        import regex
        self.merge = Merger(load_ranks(path)).ids
        self.matches = regex.compile(pattern).findall
        self.units = re.compile(UNIT).findall
        self.now: dict[str, bytes] = {}         # ids of units and pre-tokens met lately,
        self.old: dict[str, bytes] = {}         # and before: two generations

    def encode_new(self, units: list[str]) -> dict[str, bytes]:
        """Ids of units; their pre-tokens not known yet are merged in one queue. A
        match of the pattern is also matched whole when it stands alone."""
        now, old = self.now, self.old
        cut = [self.matches(unit) for unit in units]
        new = list(set().union(*cut).difference(now).difference(old))
        got = dict(zip(new, self.merge([m.encode() for m in new])))
        now.update(got)
        for unit, ms in zip(units, cut):
            if len(ms) > 1:
                got[unit] = b"".join([now[m] if m in now else old[m] for m in ms])
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as little-endian 32-bit integers."""
        now, old = self.now, self.old
        cut = [self.units(text) for text in texts]
        missing = set().union(*cut).difference(now)
        new = missing.difference(old)
        now.update([(u, old[u]) for u in missing - new])
        got = self.encode_new(list(new))
        now.update(got)
        out = [b"".join(map(now.__getitem__, units)) for units in cut]
        for u in [u for u in got if len(u) > LONGEST]:      # not worth remembering
            del now[u]
        if len(now) > CACHED:
            self.old, self.now = now, {}
        return out


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): the ids of every whole text. No shuffle."""
    def make():
        enc = load_encoder(ranks_path, pattern)

        def run(batch):
            done = enc.encode(batch.column("text").to_pylist())
            offsets = np.zeros(len(done) + 1, dtype=np.int32)
            np.cumsum([len(d) // 4 for d in done], out=offsets[1:])
            values = pa.array(np.frombuffer(b"".join(done), dtype="<i4"))
            return batch_of({"doc_id": batch.column("doc_id"),
                             "ids": pa.ListArray.from_arrays(pa.array(offsets), values)})
        return run
    return map_slices(id_text(docs, id_col, text_col), make, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded binary): the bytes that the ids stand for."""
    def make():
        token = np.array(load_ranks(ranks_path).token, dtype=object)

        def run(batch):
            ids = batch.column("ids")
            of_row = ids.value_lengths().fill_null(0).to_numpy()
            parts = token[ids.flatten().to_numpy()].tolist()
            ends = np.cumsum(of_row).tolist()
            done = [b"".join(parts[end - n:end]) for n, end in zip(of_row.tolist(), ends)]
            return batch_of({"doc_id": batch.column("doc_id"), "ids": ids, "decoded": (done, pa.binary())})
        return run
    narrow = encoded.select("doc_id", F.col(ids_col).alias("ids"))
    return map_slices(narrow, make, "doc_id long, ids array<int>, decoded binary")
