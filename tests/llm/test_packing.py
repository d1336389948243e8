import numpy as np
from tokenizers import Tokenizer

from railpulse.llm import packing
from railpulse.llm.hilbert import hilbert_index
from tests.llm import cases


def test_curve_visits_neighbours():
    for dims, bits in ((2, 5), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        index = hilbert_index(grid, bits)
        assert sorted(index) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(1) == 1).all()


def check(rows, ids_of, length):
    """Pieces cover documents without gaps or overlaps, and sequences from offset 0."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, pieces in by_doc.items():
        whole = b"".join(p["ids"] for p in sorted(pieces, key=lambda p: (p["start"], p["sequence_id"])))
        times = len(ids_of[doc_id])
        one = np.array([*ids_of[doc_id][0], 1], "<u4").tobytes()
        assert len(whole) == times * len(one)
        if times == 1:
            assert whole == one
        assert all(p["doc_tokens"] == len(one) // 4 and len(p["ids"]) == 4 * p["length"] for p in pieces)
    for pieces in by_sequence.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length


def test_pieces(spark):
    library = Tokenizer.from_file(cases.TOKENIZER)
    ids_of = {}
    for row in cases.ROWS:
        ids_of.setdefault(row[0], []).append(library.encode(row[1] or "", add_special_tokens=False).ids)
    for length in (7, 2048):
        rows = packing.packed(cases.unusual(spark, clashing=True), cases.TOKENIZER, 1, length).collect()
        assert {r["doc_id"] for r in rows} == set(ids_of)
        check(rows, ids_of, length)


def test_little_padding_and_neighbours(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet")
    rows = packing.packed(docs, cases.TOKENIZER).collect()
    used = {}
    for r in rows:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    short = [n for n in used.values() if n != 2048]
    assert len(short) <= spark.sparkContext.defaultParallelism
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    ordered = sorted(rows, key=lambda r: (r["sequence_id"], r["offset"]))
    same = np.mean([lang[a["doc_id"]] == lang[b["doc_id"]] for a, b in zip(ordered, ordered[1:])])
    assert same > 0.7  # by chance it would be under a half


def test_empty_table(spark):
    assert packing.packed(cases.empty(spark), cases.TOKENIZER).count() == 0
