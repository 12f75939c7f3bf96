from __future__ import annotations

import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from snapfold.llm import packing
from snapfold.llm.queries import WORD_TOKENIZER, op3_packing
from tests.llm import cases


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(WORD_TOKENIZER)
    t.encode_special_tokens = True
    return t


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\r\x85　ab'sdreÀé中文1२.,!'́\x1cΣİß<|>", max_size=20))
def test_ids_as_the_library(library, text):
    got = np.frombuffer(packing.load_tokenizer(WORD_TOKENIZER).encode(text), dtype="<u4").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids


@lru_cache
def default_library():
    return Tokenizer.from_file(WORD_TOKENIZER)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "|>", "<", " ", "\n",
                                 "\u3000", "x", "Hello", "é", "中", "\u0338", ".", "1"]), max_size=12).map("".join))
def test_added_tokens_as_the_library_by_default(text):
    got = np.frombuffer(packing.load_tokenizer(WORD_TOKENIZER).encode(text), dtype="<u4").tolist()
    assert got == default_library().encode(text, add_special_tokens=False).ids


def test_added_tokens_in_rows(spark):
    text = "hello <|endoftext|> x<|endoftext|>y world"
    rows = packing.pack(spark.createDataFrame([(1, text)], "doc_id long, text string"), WORD_TOKENIZER, with_ids=True)
    assert rows.first().ids == [3306, 49407, 343, 49407, 344, 1002, 1]


@given(st.lists(st.integers(1, 50), max_size=60))
def test_first_fit_decreasing(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, offsets = packing.first_fit_decreasing(lengths, 50)
    used: list[int] = []
    for need, b, at in zip(lengths, bins, offsets):
        fits = [k for k, u in enumerate(used) if u + need <= 50]
        want = fits[0] if fits else len(used)
        if want == len(used):
            used.append(0)
        assert (b, at) == (want, used[want])
        used[want] += need


def check(rows, texts, library, tokens=2048):
    """Every id in one piece, offsets gapless from 0, right checksums."""
    ids = defaultdict(list)
    for i, t in texts:
        ids[i].append(library.encode(t or "", add_special_tokens=False).ids + [1])
    assert sum(r.length for r in rows) == sum(len(x) for xs in ids.values() for x in xs)
    for r in rows:
        part = [x for x in ids[r.doc_id] if len(x) == r.doc_tokens]
        crcs = {zlib.crc32(np.array(x[r.start:r.start + r.length], dtype="<u4").tobytes()) for x in part}
        assert r.ids_crc32 in crcs
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= tokens
        padding += 0 if at & (at - 1) == 0 else tokens - at
    return padding / max(1, sum(r.length for r in rows))


def test_rows(spark, library):
    rows = packing.pack(cases.docs(spark), WORD_TOKENIZER, group_docs=10).collect()
    check(rows, cases.texts(), library)


def test_ids_kept(spark, library):
    rows = packing.pack(cases.docs(spark), WORD_TOKENIZER, with_ids=True).collect()
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and len(r.ids) == r.length


def test_empty_table(spark):
    assert packing.pack(cases.empty(spark), WORD_TOKENIZER).count() == 0


def test_query_pads_little(spark, library):
    rows = op3_packing(spark, "/root/testdata/sf0.01").collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert check(rows, texts, library) < 0.01
