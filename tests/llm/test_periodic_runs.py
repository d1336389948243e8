"""Extensions and runs against brute force."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from railpulse.llm import periodic_runs
from railpulse.llm.queries import op11_recompression_runs
from railpulse.llm.recompression import Grammar
from tests.llm import cases


def brute(words):
    """All runs by looking at every period."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        begin = None
        for i in range(n - p + 1):
            same = i < n - p and words[i] == words[i + p]
            if same and begin is None:
                begin = i
            if not same and begin is not None:
                if i + p - begin >= max(6, 4 * p):
                    found.setdefault((begin, i + p), p)
                begin = None
    return sorted([b, e - b, p] for (b, e), p in found.items())


def extension(words, i, j, step):
    n = 0
    while 0 <= i < len(words) and 0 <= j < len(words) and words[i] == words[j]:
        i, j, n = i + step, j + step, n + 1
    return n


SHAPES = [lambda r, n: r.integers(0, 2, n), lambda r, n: r.integers(0, 20, n), lambda r, n: np.zeros(n, int),
          lambda r, n: np.tile(r.integers(0, 3, 1 + n // 7), 8)[:n], lambda r, n: np.arange(n) // 3,
          lambda r, n: np.repeat(r.integers(0, 3, n), r.integers(1, 9, n))[:n]]


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("n", [2, 3, 17, 150])
def test_extensions(shape, n):
    words = np.asarray(shape(np.random.default_rng(n), n))
    grammar = Grammar(words)
    one, two = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n)))
    one, two = one[one < two], two[one < two]
    listed = words.tolist()
    assert grammar.forward(one, two).tolist() == [extension(listed, i, j, 1) for i, j in zip(one, two)]
    assert grammar.backward(one, two).tolist() == [extension(listed, i - 1, j - 1, -1) for i, j in zip(one, two)]


def test_the_grammar_is_small():
    levels = Grammar(np.random.default_rng(0).integers(0, 50, 100_000)).levels
    # A pair level shrinks by a quarter in expectation, and may have a block level beside it.
    assert len(levels) < 120 and sum(len(level.symbols) for level in levels) < 800_000
    assert sum(len(level.symbols) for level in Grammar(np.zeros(100_000, int)).levels) < 100_100


WORDS = st.one_of(
    st.lists(st.integers(0, 2), max_size=60),
    st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 9)), max_size=6).map(
        lambda parts: [w for part, times in parts for w in part * times]))


@settings(max_examples=400, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=6))
def test_runs(texts):
    found = periodic_runs.runs_of([np.array(t, np.int64) for t in texts])
    assert [rows.tolist() for rows in found] == [brute(t) for t in texts]


def test_many_candidates(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PENDING", 10)
    texts = [[1] * 500, [1, 2] * 300 + [2] * 90 + [3, 1, 2] * 40, [], [5], list(range(40)) * 5]
    found = periodic_runs.runs_of([np.array(t, np.int64) for t in texts])
    assert [rows.tolist() for rows in found] == [brute(t) for t in texts]


def test_a_very_long_text():
    words = np.concatenate([np.arange(150_000), np.zeros(200_000, np.int64), np.tile(np.arange(9_000), 5)])
    found = periodic_runs.runs_of([words])[0].tolist()
    assert found == [[150_000, 200_001, 1], [350_000, 45_000, 9_000]]


def digests(doc_id, text):
    """The contract's row, word by word."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    dropped = {i for b, size, p in runs for i in range(b + p, b + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = [hashlib.sha256(part).hexdigest() for part in (
        "".join(f"{b},{size},{p}\n" for b, size, p in runs).encode(),
        b" ".join(w for i, w in enumerate(words) if i not in dropped))]
    return (doc_id, len(runs), *(best or [None] * 3), best and 1000 * best[1] // best[2], *sha)


def test_query_over_the_whole_table(spark, sf001):
    rows = op11_recompression_runs(spark, sf001).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    short = [row for row in rows if len((texts[row["doc_id"]] or "").split()) < 1500]
    assert len(short) > 950 and sum(row["n_runs"] > 0 for row in short) > 50
    assert sorted(map(tuple, short)) == sorted(digests(row["doc_id"], texts[row["doc_id"]]) for row in short)
    for row in rows:  # of long texts, that the best run is one
        if row not in short and row["n_runs"]:
            assert row["length"] >= max(6, 4 * row["period"]) and row["exponent_milli"] >= 4000


@pytest.mark.parametrize("chunk", [1, 10_000_000])
def test_unusual_tables(spark, chunk):
    docs = cases.unusual(spark, clashing=True)
    rows = periodic_runs.periodic_runs(docs, chunk).collect()
    found = sorted((str(r["doc_id"]), r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in rows)
    want = []
    for row, text in zip(cases.ROWS, cases.texts()):
        words = text.encode().split()
        runs = [(0, 40_000, 10)] if row[0] == 5 else [tuple(r) for r in brute(words)]
        left = words[:10] if row[0] == 5 else words
        want.append((str(row[0]), len(words), runs, b" ".join(left).decode()))
    assert found == sorted(want)
    planted = {str(r["doc_id"]): r["text"] for r in periodic_runs.with_planted_repeats(docs).collect()}
    assert len(planted) == len({str(r[0]) for r in cases.ROWS})


def test_empty_table(spark):
    assert periodic_runs.periodic_runs(periodic_runs.with_planted_repeats(cases.empty(spark))).count() == 0
