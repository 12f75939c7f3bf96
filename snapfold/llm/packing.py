"""Packing of tokenised documents into fixed-length sequences.

A document's ids are cut into full pieces of the sequence length, which are sequences
of their own, and one shorter rest. Documents are dealt at random into groups of about
``GROUP_DOCS``; in each group the rests are placed by first-fit decreasing. A tournament
tree over the bins' free room finds the first bin with enough of it in O(log bins).
Only lengths and checksums are shuffled, never the ids, and a group's memory does not
grow with the corpus.

Defined results: null and empty texts are the closing id alone; repeated rows (also
with null doc_id) are packed as documents of their own; ties in length are placed in
the order (doc_id, row, start); other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import RunCache, batch_of, id_text, map_slices

SEQUENCE_TOKENS = 2048
GROUP_DOCS = 2048          # documents of a group, on average
END_ID = 1
CACHED = 300_000           # runs and words that a worker remembers, in each of two generations

PIECES = ("doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long")


class RoomTree:
    """Tournament tree over bin room: each inner node holds the larger room below it."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.most = [room] * (2 * self.leaves)

    def first_fit(self, need: int) -> int:
        """Takes ``need`` of the first bin that has it; the bin's number."""
        most, at = self.most, 1
        while at < self.leaves:
            at *= 2
            if most[at] < need:
                at += 1
        found = at - self.leaves
        most[at] -= need
        while at > 1:
            at //= 2
            a, b = most[2 * at], most[2 * at + 1]
            most[at] = a if a >= b else b
        return found


def first_fit_decreasing(lengths: list[int], room: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item; ``lengths`` fall, each at most ``room``."""
    tree = RoomTree(len(lengths) or 1, room)
    used: dict[int, int] = {}
    bins, offsets = [], []
    for need in lengths:
        b = tree.first_fit(need)
        bins.append(b)
        offsets.append(used.get(b, 0))
        used[b] = offsets[-1] + need
    return bins, offsets


# runs that the vocabulary's normalizer changes by case alone
SIMPLE_RUN = re.compile("[!-~\u00a1-\u024f]+")
# the vocabulary's own pre-tokenizer pattern (fixed value)
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class RunTokenizer:
    """Ids of texts as little-endian 32-bit integers. The vocabulary's words never cross
    white space, so runs between spaces, tabs and line ends are encoded, and remembered,
    on their own: simple ones word by word by the library's model, others, and those that
    hold an added token, by its whole chain of added tokens, normalizer, pre-tokenizer and
    model."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(re.search(r"\s", t.content) or t.lstrip or t.rstrip for t in added):
            raise ValueError("an added token of the vocabulary reaches over white space")
        self.added = re.compile("|".join(re.escape(t.content) for t in added) or "(?!)", re.IGNORECASE)
        self.findall = regex.compile(WORD_PATTERN).findall
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letter = {}                       # the model's letter for each byte
        for c in range(0x250):
            for b, x in zip(chr(c).encode(), letters.pre_tokenize_str(chr(c))[0][0]):
                self.letter[b] = x
        self.words = RunCache(self.encode_word, CACHED)
        self.runs = RunCache(self.encode_run, CACHED)

    def encode_word(self, word: str) -> bytes:
        mapped = word.encode().decode("latin-1").translate(self.letter)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def encode_run(self, run: str) -> bytes:
        if not SIMPLE_RUN.fullmatch(run) or self.added.search(run):
            ids = self.tokenizer.encode(run, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        run = run.lower()
        stem = run.rstrip(".,")
        if stem.isalpha():                     # a word, and what punctuation ends it
            ids = self.words[stem]
            return ids + self.words[run[len(stem):]] if len(run) > len(stem) else ids
        return b"".join([self.words[w] for w in self.findall(run)])

    def encode(self, text: str) -> bytes:
        runs = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        ids = b"".join(map(self.runs.__getitem__, runs))
        self.runs.turn()
        self.words.turn()
        return ids


@lru_cache(maxsize=2)
def load_tokenizer(path: str) -> RunTokenizer:
    """One tokenizer, with what it remembers, for all tasks of a worker process."""
    return RunTokenizer(path)


def cut_pieces(docs: DataFrame, tokenizer_path: str, tokens: int = SEQUENCE_TOKENS,
               id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: (doc_id, row, start, length, ids_crc32, doc_tokens), and the
    piece's ``ids`` if asked. ``row`` numbers the input rows, so repeated ones differ."""
    def make():
        tok = load_tokenizer(tokenizer_path)
        end = np.array([END_ID], dtype="<u4").tobytes()

        def run(batch):
            out: dict[str, list] = {k: [] for k in ("doc_id", "row", "start", "length", "ids_crc32",
                                                    "doc_tokens", "ids")}
            for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(),
                                      batch.column("text").to_pylist()):
                ids = tok.encode(text) + end
                n = len(ids) // 4
                for start in range(0, n, tokens):
                    piece = ids[4 * start:4 * (start + tokens)]
                    for k, v in (("doc_id", doc), ("row", row), ("start", start), ("length", len(piece) // 4),
                                 ("ids_crc32", zlib.crc32(piece)), ("doc_tokens", n)):
                        out[k].append(v)
                    if with_ids:
                        out["ids"].append(np.frombuffer(piece, dtype="<i4"))
            cols = {k: (v, pa.int64()) for k, v in out.items() if k != "ids"}
            if with_ids:
                cols["ids"] = (out["ids"], pa.list_(pa.int32()))
            return batch_of(cols)
        return run
    rows = id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return map_slices(rows, make, PIECES + (", ids array<int>" if with_ids else ""))


def pack(docs: DataFrame, tokenizer_path: str, tokens: int = SEQUENCE_TOKENS,
         group_docs: int = GROUP_DOCS, seed: int = 0, n_docs: int | None = None,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces with their ``sequence_id`` and ``offset`` there. ``n_docs`` (else counted)
    sets only the number of groups."""
    n = docs.count() if n_docs is None else n_docs
    groups = max(1, math.ceil(n / group_docs))
    pieces = cut_pieces(docs, tokenizer_path, tokens, id_col, text_col, with_ids)
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(groups)))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "row", "start"], ascending=[False, True, True, True])
        bins, offsets = first_fit_decreasing(pdf["length"].tolist(), tokens)
        return pdf.assign(sequence_id=pdf["grp"] * (1 << 32) + np.array(bins, dtype="int64"),
                          offset=np.array(offsets, dtype="int64")).drop(columns=["grp", "row"])

    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
              + ("ids array<int>, " if with_ids else "") + "sequence_id long, offset long")
    return dealt.groupBy("grp").applyInPandas(place, schema)
