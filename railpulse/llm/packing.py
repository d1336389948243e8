"""Packing along a space-filling curve: documents that are alike share sequences.

1. Every text is tokenised once. Its ids are hashed into a wide vector of dampened counts,
   and random directions project that to a few coordinates.
2. The coordinates are put on a grid by the corpus' own mean and spread; a document's key
   is the Hilbert index of its grid point.
3. Documents are range-partitioned and sorted by key (then id, then position in the table,
   so that copies of one text split like any others), and every partition's ids are laid
   end to end and cut at each ``length`` ids. Only the last sequence of a partition has
   padding, and none if its length is a power of two.

The one shuffle carries the ids. A sequence's number is its partition's number times 2**40
plus its place, so no task needs to know about the others.

Null texts are empty: just the end id. Null ids are kept, and so are repeated rows. An
empty table gives no pieces. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.llm import tokens
from railpulse.llm.hilbert import hilbert_index
from railpulse.llm.tables import stored, whole_text

HASHED, DIMS, BITS, SPREAD = 1024, 4, 12, 3.0
ENCODED = "doc_id long, place long, ids binary, coords array<float>"
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
          "offset long, curve_key long")
PIECE_NAMES = [column.split()[0] for column in PIECES.split(", ")]


def projection(vocabulary_size: int, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every token id, and the directions to project the buckets on."""
    source = np.random.default_rng(seed)
    return (source.integers(0, HASHED, vocabulary_size),
            source.standard_normal((HASHED, DIMS)).astype(np.float32))


def document_coordinates(ids: np.ndarray, buckets: np.ndarray, directions: np.ndarray) -> np.ndarray:
    wide = np.log1p(np.bincount(buckets[ids], minlength=HASHED)).astype(np.float32)
    return wide / max(float(np.linalg.norm(wide)), 1e-12) @ directions


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Ids as bytes (two each if the vocabulary allows) with the coordinates; one pass over the texts."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = tokens.vocabulary(tokenizer).size
        buckets, directions = projection(size)
        kind, place = ("<u2" if size <= 1 << 16 else "<u4"), TaskContext.get().partitionId() << 40
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                found = [np.append(tokens.encode(text.as_py(), tokenizer), np.uint32(end_id))
                         for text in part["text"]]
                points = [document_coordinates(ids, buckets, directions).tolist() for ids in found]
                yield pa.RecordBatch.from_arrays([
                    part["doc_id"], pa.array(range(place, place + len(found)), pa.int64()),
                    pa.array([ids.astype(kind).tobytes() for ids in found], pa.binary()),
                    pa.array(points, pa.list_(pa.float32()))], ["doc_id", "place", "ids", "coords"])
                place += len(found)

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(encode, ENCODED)


def with_curve_key(points: DataFrame) -> DataFrame:
    """Adds ``curve_key``; the grid comes from one row of means and deviations over all rows."""
    at = [F.col("coords")[i] for i in range(DIMS)]
    row = points.agg(*[f(c) for c in at for f in (F.mean, F.stddev_pop)]).first()
    moments = np.array([x if x is not None else 0.0 for x in row]).reshape(DIMS, 2)
    low, width = moments[:, 0] - SPREAD * moments[:, 1], np.maximum(2 * SPREAD * moments[:, 1], 1e-9)

    @F.pandas_udf("long")
    def key(coords):
        grid = (np.stack(coords.to_numpy()) - low) / width * (1 << BITS) if len(coords) else np.zeros((0, DIMS))
        return pd.Series(hilbert_index(np.clip(grid, 0, (1 << BITS) - 1), BITS))

    return points.withColumn("curve_key", key("coords")).drop("coords")


def packed(docs: DataFrame, tokenizer: str, end_id: int = 1, length: int = 2048) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` ids; ``ids`` are 32-bit little-endian."""
    keyed = with_curve_key(stored(encoded(docs, tokenizer, end_id), "encoded"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<u2" if tokens.vocabulary(tokenizer).size <= 1 << 16 else "<u4"
        base, filled = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                out, rows = [], []
                for row, ids in enumerate(part["ids"]):
                    all_ids = np.frombuffer(ids.as_buffer(), kind).astype("<u4")
                    begin = 0
                    while begin < len(all_ids):
                        offset = filled % length
                        taken = min(length - offset, len(all_ids) - begin)
                        rows.append(row)
                        out.append((begin, taken, all_ids[begin:begin + taken].tobytes(), len(all_ids),
                                    base + filled // length, offset))
                        begin, filled = begin + taken, filled + taken
                if not rows:
                    continue
                start, taken, raw, whole, sequence, offset = zip(*out)
                source = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([
                    source["doc_id"], pa.array(start, pa.int64()), pa.array(taken, pa.int64()),
                    pa.array(raw, pa.binary()), pa.array(whole, pa.int64()), pa.array(sequence, pa.int64()),
                    pa.array(offset, pa.int64()), source["curve_key"]],
                    PIECE_NAMES)

    order = [F.col("curve_key"), F.col("doc_id").asc_nulls_first(), F.col("place")]
    return (keyed.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("doc_id", "ids", "curve_key").mapInArrow(pack, PIECES))
