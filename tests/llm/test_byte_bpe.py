"""Ids of the scanned words against the library that owns the file of ranks."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from railpulse.llm import byte_bpe
from railpulse.llm.queries import op13_scanned_byte_bpe
from tests.llm import cases

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
with open(RANKS, "rb") as _file:
    LIBRARY = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, _file)})
ODD = [*cases.texts(), "aaaaaaaaaaaaa", "a" * 3001, "ab" * 900, "<|endoftext|>x", "don't we'll I'VE it's'd 're're",
       "!'s ''s 's!'s '  's\n's\t's 'lx 'l 'r", " \t\n  x", "\r\n\r\n", "  ", "x  y   z    ", "'", "'s", " '", "a'",
       "é" * 200, "＀‼️ ۱۲۳", "\x00\x00 a\x00", "　　x y", "'ſ 's"]


def check(texts):
    own = byte_bpe.merger(RANKS)
    ids, ends, sizes = own.encode(texts)
    cuts = np.cumsum(sizes)[:-1]
    for text, part, until in zip(texts, np.split(ids, cuts), np.split(ends, cuts)):
        assert part.tolist() == LIBRARY.encode_ordinary(text), text[:80]
        assert own.decode(part, until) == text.encode()
        assert until.tolist() == np.cumsum([len(LIBRARY.decode_single_token_bytes(i)) for i in part]).tolist()


def test_odd_texts():
    check(ODD)
    for text in ODD:
        check([text])


def test_every_code_point():
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    spelled = "a{0}b {0}  {0}1{0}'s{0}!\n{0}{0}'ll x{0}\t "
    for first in range(0, len(points), 50_000):
        text = "".join(spelled.format(chr(p)) for p in points[first:first + 50_000])
        assert byte_bpe.merger(RANKS).encode([text])[0].tolist() == LIBRARY.encode_ordinary(text)


PIECES = st.sampled_from(["'", "s", "re", "ll", "ve", " ", "  ", "\n", "\t", "a", "É", "1", "²", "!", "日", " ", "'t"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.lists(PIECES, max_size=30).map("".join)), min_size=1, max_size=6))
def test_random_texts(texts):
    check(texts)


@pytest.mark.parametrize("block", [1, 2, 7, 512])
def test_scan_by_blocks(block):
    kinds = np.random.default_rng(1).integers(0, 9, 500).astype(np.uint8)
    own, state, want = byte_bpe.scanner(), byte_bpe.FRESH, []
    for kind in kinds:
        want.append(state)
        state = int(own.after[state, kind])
    assert own.states_before(kinds, block).tolist() == want


def test_long_words_merge_as_short_ones():
    own = byte_bpe.merger(RANKS)
    for seed in range(200):
        word = bytes(np.random.default_rng(seed).choice(list(b"etaonrish "), 1 + seed % 60).tolist())
        assert own._merge_long(word) == own._merge_short(word)


def test_the_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED_WORDS", 3)
    own = byte_bpe.RankMerger(RANKS)
    text = " ".join(f"wörd{i}xq" for i in range(50))
    assert own.encode([text])[0].tolist() == LIBRARY.encode_ordinary(text)
    assert len(own.cache) <= 3


@pytest.mark.parametrize("chunk", [1, 40, 10_000_000])
def test_tables_in_chunks(spark, chunk):
    docs = cases.unusual(spark, clashing=True)
    rows = byte_bpe.decoded(byte_bpe.encoded(docs, RANKS, chunk), RANKS).collect()
    want = sorted((str(r[0]), LIBRARY.encode_ordinary(t), t.encode()) for r, t in zip(cases.ROWS, cases.texts()))
    assert sorted((str(r["doc_id"]), r["ids"], bytes(r["content"])) for r in rows) == want


def test_unknown_ids_and_nulls(spark):
    own = byte_bpe.merger(RANKS)
    with pytest.raises(KeyError):
        own.decode(np.array([10**6]), np.array([1]))
    rows = spark.createDataFrame([(1, None, None), (2, [], [])], "doc_id long, ids array<int>, ends array<long>")
    assert {r["doc_id"]: r["content"] for r in byte_bpe.decoded(rows, RANKS).collect()} == {1: None, 2: b""}


def test_empty_table(spark):
    assert byte_bpe.decoded(byte_bpe.encoded(cases.empty(spark), RANKS), RANKS).count() == 0


def test_query_over_the_whole_table(spark, sf001):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    rows = op13_scanned_byte_bpe(spark, sf001).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = LIBRARY.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(LIBRARY.decode_bytes(ids)).hexdigest()
