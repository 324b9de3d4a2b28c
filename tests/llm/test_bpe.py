"""Byte-level BPE against the library on whole texts, and exact round trips."""

from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from premia.llm import bpe

FILE, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def enc():
    return bpe.encoding(FILE, PATTERN)


ALPHABET = st.sampled_from(list("abZ09 \n\t'’éß中🙂-_=.,!s\x00\x1c\x85 　") + ["'s", "  ", "\r\n", " the"])


@settings(max_examples=300, deadline=None)
@given(st.lists(ALPHABET, max_size=120).map("".join), st.integers(1, 9), st.integers(1, 9))
def test_cutting_never_changes_ids(text, size, reach):
    enc = bpe.encoding(FILE, PATTERN)
    assert bpe.encode_text(enc, PATTERN, text, size, reach).tolist() == enc.encode_ordinary(text)


@pytest.mark.parametrize(
    "text", ["a b " * 40_000, "x" * 150_000, "ab" + " " * 150_000 + "c", " " * 300_000, "\n" * 90_000 + " z", "1" * 70_000 + " it's"]
)
def test_long_texts_round_trip(enc, text):
    ids = bpe.encode_text(enc, PATTERN, text)
    assert enc.decode_bytes(ids.tolist()).decode() == text


def test_white_space_on_which_the_library_fails(enc):
    ids = bpe.encode_text(enc, PATTERN, "a" + " " * 2_000_000 + "b")
    assert enc.decode_bytes(ids.tolist()) == b"a" + b" " * 2_000_000 + b"b"


def test_rows_nulls_repeats_and_other_columns(spark, enc):
    rows = [(1, "it's <|endoftext|> fine", "k", 5), (1, "it's <|endoftext|> fine", "k", 5), (None, "x", None, 6), (2, None, "n", 7), (3, "", "e", 8)]
    schema = "doc_id long, text string, decoded string, ids int"
    docs = spark.createDataFrame(rows, schema)
    out = bpe.decode(bpe.encode(docs, FILE, PATTERN), FILE, PATTERN)
    got = sorted((r.doc_id is None, r.doc_id, list(r.ids), bytes(r.decoded)) for r in out.collect())
    want = sorted((i is None, i, enc.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows)
    assert got == want
    at_once = bpe.encode(docs.drop("decoded"), FILE, PATTERN, decoded=True).collect()
    assert sorted((r.doc_id is None, r.doc_id, list(r.ids), bytes(r.decoded)) for r in at_once) == want
    assert bpe.encode(docs.limit(0), FILE, PATTERN).count() == 0


def test_decoding_keeps_bytes_that_are_no_text(spark, enc):
    half = [i for i in range(256) if enc.decode_single_token_bytes(i) == b"\xe4"]
    schema = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
    out = bpe.decode(spark.createDataFrame([(half,), (None,), ([],)], schema), FILE, PATTERN).collect()
    assert [r.decoded for r in out] == [bytearray(b"\xe4"), None, bytearray(b"")]
