"""The registered queries over whole tables: against SQL, or against brute force in Python."""

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from railpulse.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import bags, connect
from tests.llm import cases
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def texts(spark, sf001):
    rows = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in sorted(rows, key=lambda r: r["doc_id"])}


@pytest.fixture(scope="module")
def ids(texts):
    encodings = Tokenizer.from_file(cases.TOKENIZER).encode_batch(list(texts.values()), add_special_tokens=False)
    return {k: e.ids for k, e in zip(texts, encodings)}


def result(spark, sf001, name):
    return QUERIES[name](spark, sf001).collect()


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


def test_all_are_registered():
    names = entry_points.queries()
    for n in range(1, 11):
        assert len([name for name in names if name.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, sf001, name):
    ours, theirs = bags(QUERIES[name](spark, sf001), connect(sf001), ORACLE_SQL[name])
    assert ours and ours == theirs


def test_op1(spark, sf001, ids):
    pieces, sequences = {}, {}
    for r in result(spark, sf001, "op1_hilbert_packing"):
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == ids.keys()
    for doc_id, own in pieces.items():
        whole, at = [*ids[doc_id], 1], 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(whole)
            at += p["length"]
            assert p["ids_crc32"] == crc(whole[p["start"]:at])
        assert at == len(whole)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_op2(spark, sf001, texts):
    order, rows = list(texts), {r["doc_id"]: r for r in result(spark, sf001, "op2_multiset_fingerprints")}
    assert rows.keys() == texts.keys()
    for k, doc_id in enumerate(order):
        text, following = texts[doc_id], texts[order[(k + 1) % len(order)]]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        row = rows[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    by_text = {}
    for doc_id, text in texts.items():
        by_text.setdefault(text, set()).add(rows[doc_id]["fingerprint"])
    assert all(len(found) == 1 for found in by_text.values())
    assert len({min(found) for found in by_text.values()}) == len(by_text)


def test_op3(spark, sf001, texts):
    rows = {r["doc_id"]: r for r in result(spark, sf001, "op3_weak_toxicity")}
    assert rows.keys() == texts.keys()
    for doc_id, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.7)


def test_op5(spark, sf001, texts):
    rows = result(spark, sf001, "op5_hilbert_shards")
    slots = {}
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 8, zlib.crc32(raw), "rows")
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(24)) and len(rows) == len(texts)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1


def test_op6(spark, sf001, texts):
    rows = {r["doc_id"]: r for r in result(spark, sf001, "op6_hyperdimensional_langid")}
    assert rows.keys() == texts.keys()
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    held = [k for k in rows if zlib.crc32(str(k).encode()) % 4 == 2]
    assert all(rows[k]["held_out"] == (k in set(held)) for k in rows)
    assert sum(rows[k]["lang_pred"] == known[k] for k in held) >= 0.98 * len(held)


def test_op7(spark, sf001, texts, ids):
    rows = {r["doc_id"]: r for r in result(spark, sf001, "op7_pair_index_bpe")}
    assert rows.keys() == texts.keys()
    for doc_id, r in rows.items():
        listed = ",".join(map(str, ids[doc_id]))
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids[doc_id]), hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(texts[doc_id].encode()).hexdigest())


def test_op9(spark, sf001, texts):
    rows = {r["doc_id"]: r for r in result(spark, sf001, "op9_simhash_pivots")}
    bits = [plain_fingerprint(t) for t in texts.values()]
    want = plain_components(bits, list(texts), 4)
    assert {k: (r["fingerprint"], r["component_id"]) for k, r in rows.items()} == {
        k: (f"{b:016x}", c) for k, b, c in zip(texts, bits, want)}


def test_op10(spark, sf001, ids):
    rows = {r["doc_id"]: r for r in result(spark, sf001, "op10_seekable_tokens")}
    at = 0
    for doc_id, own in ids.items():
        r = rows[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(own) + 1, crc([*own, 0]))
        at += len(own) + 1
    assert rows.keys() == ids.keys()
