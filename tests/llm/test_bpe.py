"""Encoding and counting against the two libraries, and exact round trips."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabwright.llm.bpe import LONG_BYTES, encode_documents, rank_coder
from tabwright.llm.token_counts import count_tokens, counter
from tests.llm.helpers import by_id, documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


ODD = [
    "", " ", "\n\n \t x", "a" * (LONG_BYTES * 3), "ab" * LONG_BYTES, "é" * LONG_BYTES, "日本語テキスト" * 400,
    "it's IT'S we'll 12 ³ ½ x² <|endoftext|> y<|endoftext|><|endoftext|>", "\x1c\x1d\x85   z　", "🙂👩‍👩‍👧",
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(library, tokenizer, text):
    coder = rank_coder(RANKS, PATTERN)
    blob = coder.encode([text])[0]
    assert blob == as_bytes(library.encode_ordinary(text))
    assert coder.decode(np.frombuffer(blob, "<u4").astype(int)) == text.encode()
    assert counter(TOKENIZER, PATTERN)([text]) == [len(tokenizer.encode(text, add_special_tokens=False).ids)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=200), max_size=5))
def test_any_texts(library, tokenizer, texts):
    coder = rank_coder(RANKS, PATTERN)
    assert coder.encode(texts) == [as_bytes(library.encode_ordinary(t)) for t in texts]
    counts = counter(TOKENIZER, PATTERN)(texts)
    assert counts == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def test_long_rows_merge_like_matrix_rows():
    coder = rank_coder(RANKS, PATTERN)
    rng = np.random.default_rng(1)
    for _ in range(50):
        piece = bytes(rng.choice(list(b"abestn "), int(rng.integers(2, 200))).tolist())
        assert coder.merges._by_heap(piece).tolist() == coder.merges.ids([piece])[0].tolist()


def test_proven_strings_are_one_token(tokenizer):
    proven = counter(TOKENIZER, PATTERN).proven
    assert len(proven) > 40_000
    some = sorted(proven)[::97]
    assert all(len(e.ids) == 1 for e in tokenizer.encode_batch(some, add_special_tokens=False))


def test_documents(spark, sf_dir, library, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    encoded, counted = by_id(encode_documents(docs, RANKS, PATTERN)), by_id(count_tokens(docs, TOKENIZER, PATTERN))
    rows = docs.collect()
    assert len(rows) == len(encoded) == len(counted)
    for r in rows:
        ids = as_bytes(library.encode_ordinary(r["text"]))
        assert bytes(encoded[r["doc_id"]]["ids"]) == ids
        assert encoded[r["doc_id"]]["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert encoded[r["doc_id"]]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
        n = len(tokenizer.encode(r["text"], add_special_tokens=False).ids)
        row = counted[r["doc_id"]]
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(r["text"].encode()), n, n > 512)


def test_odd_rows(spark):
    docs = documents(spark, [None, "", "x", "x", (2, "x"), (None, "y"), "z " * 100_000])
    docs = docs.withColumns({"found": F.lit(1), "n_tokens": F.lit("a"), "ids": F.lit(None)})
    for result in (encode_documents(docs, RANKS, PATTERN), count_tokens(docs, TOKENIZER, PATTERN)):
        rows = result.collect()
        assert len(rows) == 7
        assert sorted(r["n_tokens"] for r in rows)[:6] == [0, 0, 1, 1, 1, 1]
    assert encode_documents(docs.limit(0), RANKS, PATTERN).count() == 0
    assert count_tokens(docs.limit(0), TOKENIZER, PATTERN).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert by_id(encode_documents(docs, RANKS, PATTERN))[0]["ids_sha256"] == empty
