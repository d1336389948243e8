"""Ids against the tokenizers library: by tiktoken, and by the pair index."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from railpulse.llm import bpe, tokens
from tests.llm import cases

LIBRARY = Tokenizer.from_file(cases.TOKENIZER)
ODD = [*cases.texts(), "aaaaaaaaaaaaa", "a" * 3001, "ababababab", "<|endoftext|><|endoftext|>x", "don't we'll I'VE",
       " \t\n  x", "\r\n\r\n", "  ", "é" * 50, "x  y   z    ", "＀‼️ ۱۲۳"]


def expected(texts):
    return [encoding.ids for encoding in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def split(ids, sizes):
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]


def test_odd_texts():
    assert [tokens.encode(t, cases.TOKENIZER).tolist() for t in ODD] == expected(ODD)
    assert split(*bpe.merger(cases.TOKENIZER).encode(ODD)) == expected(ODD)


def test_every_script():
    points = [p for p in range(0x20000) if not 0xD800 <= p < 0xE000]
    texts = [f"a{chr(p)}b {chr(p)}  {chr(p)}1{chr(p)}!{chr(p)}{chr(p)}\n" for p in points]
    want = expected(texts)
    assert [tokens.encode(t, cases.TOKENIZER).tolist() for t in texts] == want
    assert split(*bpe.merger(cases.TOKENIZER).encode(texts)) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=6))
def test_random_texts(texts):
    want = expected(texts)
    assert split(*bpe.merger(cases.TOKENIZER).encode(texts)) == want
    assert [tokens.encode(t, cases.TOKENIZER).tolist() for t in texts] == want


@pytest.mark.parametrize("chunk", [1, 40, 10_000_000])
def test_encoding_and_decoding_in_chunks(spark, chunk):
    docs = cases.unusual(spark, clashing=True)
    rows = bpe.decoded(bpe.encoded(docs, cases.TOKENIZER, chunk), cases.TOKENIZER).collect()
    want = sorted(zip([str(r[0]) for r in cases.ROWS], expected(cases.texts()), cases.texts()))
    assert sorted((str(r["doc_id"]), r["ids"], r["text"]) for r in rows) == want


def test_decoding_what_is_no_text(spark):
    lone = bpe.merger(cases.TOKENIZER).ids[b"\xe3"]
    rows = spark.createDataFrame([(1, [lone, 64]), (2, []), (3, None)], "doc_id long, ids array<int>")
    found = {r["doc_id"]: r["text"] for r in bpe.decoded(rows, cases.TOKENIZER).collect()}
    assert found == {1: LIBRARY.decode([lone, 64], skip_special_tokens=False), 2: "", 3: None}


def test_empty_table(spark):
    assert bpe.decoded(bpe.encoded(cases.empty(spark), cases.TOKENIZER), cases.TOKENIZER).count() == 0
