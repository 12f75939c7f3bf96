from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from snapfold.llm import byte_bpe
from snapfold.llm.queries import BYTE_RANKS, op2_byte_bpe
from tests.llm import cases


@pytest.fixture(scope="module")
def library():
    with open(BYTE_RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.load_encoder(BYTE_RANKS, public_tokenizers.PATTERN)


def ids(encoder, *texts):
    return [np.frombuffer(b, dtype="<i4").tolist() for b in encoder.encode(list(texts))]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=" \n\t\r\x85　ab'sdreÀé中文1२.,!'́\x1c😀", max_size=24))
def test_texts_as_the_library(encoder, library, text):
    assert ids(encoder, text) == [library.encode_ordinary(text)]


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000 + "中" * 500, " " * 4000, "\n" * 999 + "x", "éa" * 4000])
def test_long_pretokens(encoder, library, text):
    assert ids(encoder, text) == [library.encode_ordinary(text)]


def test_what_is_remembered_is_bounded(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED", 20)
    small = byte_bpe.Encoder(BYTE_RANKS, public_tokenizers.PATTERN)
    for i, text in cases.texts():
        assert ids(small, text or "") == [library.encode_ordinary(text or "")]
    assert len(small.now) <= 21 + max(len((t or "").split(" ")) for _, t in cases.texts()) * 2


def test_rows(spark, library):
    out = byte_bpe.decode(byte_bpe.encode(cases.docs(spark), BYTE_RANKS, public_tokenizers.PATTERN), BYTE_RANKS).collect()
    want = sorted(((i is None, i or 0, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in cases.texts()))
    assert sorted((r.doc_id is None, r.doc_id or 0, list(r.ids), bytes(r.decoded)) for r in out) == want


def test_empty_table(spark):
    assert byte_bpe.encode(cases.empty(spark), BYTE_RANKS, public_tokenizers.PATTERN).count() == 0


def test_query(spark, sf_dir, library):
    got = {r.doc_id: r for r in op2_byte_bpe(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        want = library.encode_ordinary(r.text)
        assert got[r.doc_id].n_tokens == len(want)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
