"""Token files: independent zstandard frames, a trailing seek table, a checksum per frame.

A file is a valid zstandard stream in the published seekable layout:

* frames of ``frame_bytes`` raw bytes each (the last one shorter), every one compressed by
  itself; raw bytes are the little-endian unsigned 32-bit ids of the documents in order;
* a skippable frame with the document index: ids and token counts, as a zstandard frame;
* a skippable frame with the seek table: per frame its compressed and raw size and the low
  32 bits of the XXH64 of its raw bytes; the last nine bytes hold the number of frames, a
  flag byte and a magic number.

A reader takes the tail, the seek table and the index, and then decompresses only the
frames that hold the documents asked for. Frames do not end with documents, so that a very
long one needs no more memory to write or to seek than others.

Documents are range-partitioned and sorted by ``doc_id``; every task writes one file and
reports it in a manifest. A file counts only through the manifest, which holds those of
successful attempts: an attempt that was lost or repeated leaves a file nobody reads.

Null texts are empty and hold just the end id. Null ids come first; rows that share an id
are kept and ordered by a hash of the text. An empty table gives no files. Other columns are ignored.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railpulse.llm import tokens
from railpulse.llm.tables import stored, whole_text

#: Fixed values of the seekable layout: skippable frames, seek table tail, checksum flag.
INDEX_MAGIC, SEEK_MAGIC, TAIL_MAGIC, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
FRAME_BYTES = 1 << 18
MANIFEST = "part int, file string, documents long, tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids binary"


class TokenFileWriter:
    """Appends documents to one open file."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self._out, self._frame_bytes = out, frame_bytes
        self._compressor = zstandard.ZstdCompressor(level=level)
        self._raw = bytearray()
        self._frames: list[tuple[int, int, int]] = []
        self._doc_ids: list[int | None] = []
        self._counts: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._doc_ids.append(doc_id)
        self._counts.append(len(ids))
        self._raw += ids.astype("<u4").tobytes()
        whole = len(self._raw) // self._frame_bytes * self._frame_bytes
        for at in range(0, whole, self._frame_bytes):
            self._frame(bytes(self._raw[at:at + self._frame_bytes]))
        del self._raw[:whole]

    def _frame(self, raw: bytes) -> None:
        packed = self._compressor.compress(raw)
        self._out.write(packed)
        self._frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> tuple[int, int]:
        """Documents and tokens written."""
        if self._raw:
            self._frame(bytes(self._raw))
        known = np.array([i is not None for i in self._doc_ids], np.uint8)
        index = self._compressor.compress(b"".join([
            struct.pack("<Q", len(known)), known.tobytes(),
            np.array([i or 0 for i in self._doc_ids], "<i8").tobytes(),
            np.array(self._counts, "<u8").tobytes()]))
        self._out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *frame) for frame in self._frames)
        tail = struct.pack("<IBI", len(self._frames), WITH_CHECKSUMS, TAIL_MAGIC)
        self._out.write(struct.pack("<II", SEEK_MAGIC, len(table) + len(tail)) + table + tail)
        return len(known), sum(self._counts)


class TokenFile:
    """Reads documents of one file by their position in it."""

    def __init__(self, source):
        self._source = source
        size = source.seek(0, io.SEEK_END)
        n_frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != TAIL_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table = self._at(size - 9 - 12 * n_frames, 12 * n_frames)
        self._frames = np.frombuffer(table, "<u4").reshape(-1, 3).astype(np.int64)
        self._places = np.concatenate([[0], np.cumsum(self._frames[:, 0])])
        self._ends = np.cumsum(self._frames[:, 1])
        head = struct.unpack("<II", self._at(int(self._places[-1]), 8))
        if head[0] != INDEX_MAGIC:
            raise ValueError("no document index before the seek table")
        index = zstandard.ZstdDecompressor().decompress(self._at(int(self._places[-1]) + 8, head[1]))
        n = struct.unpack_from("<Q", index)[0]
        self.known = np.frombuffer(index, np.uint8, n, 8).astype(bool)
        self.doc_ids = np.frombuffer(index, "<i8", n, 8 + n)
        self.counts = np.frombuffer(index, "<u8", n, 8 + 9 * n).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.frames_read = 0
        self._cached: tuple[int, bytes] = (-1, b"")

    def _at(self, place: int, length: int) -> bytes:
        self._source.seek(place)
        return self._source.read(length)

    def _frame(self, k: int) -> bytes:
        if self._cached[0] != k:
            packed, raw_size, checksum = map(int, self._frames[k])
            raw = zstandard.ZstdDecompressor().decompress(self._at(int(self._places[k]), packed))
            if len(raw) != raw_size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {k} fails its checksum")
            self.frames_read += 1
            self._cached = (k, raw)
        return self._cached[1]

    def document(self, position: int) -> np.ndarray:
        begin = int(self.starts[position]) * 4
        end = begin + int(self.counts[position]) * 4
        parts, k = [], int(np.searchsorted(self._ends, begin, "right"))
        while begin < end:
            first = int(self._ends[k] - self._frames[k, 1])
            stop = min(end, int(self._ends[k]))
            parts.append(self._frame(k)[begin - first:stop - first])
            begin, k = stop, k + 1
        return np.frombuffer(b"".join(parts), "<u4")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0,
                      frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Files of token ids in ascending ``doc_id`` order under ``folder``; returns the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, writer = TaskContext.get().partitionId(), None, None
        name = f"part-{part:06d}-{uuid.uuid4().hex}.tok.zst"
        for batch in batches:
            if batch.num_rows and writer is None:
                store, root = fs.FileSystem.from_uri(folder)
                store.create_dir(root)
                out = store.open_output_stream(f"{root}/{name}", compression=None)
                writer = TokenFileWriter(out, frame_bytes)
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                writer.add(doc_id, np.append(tokens.encode(text.as_py(), tokenizer), np.uint32(end_id)))
        if writer is not None:
            documents, n_tokens = writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [f"{folder}/{name}"],
                "documents": pa.array([documents], pa.int64()), "tokens": pa.array([n_tokens], pa.int64())})

    # Rows that share an id are told apart by a hash, as the sample of keys goes to the driver.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = (docs.select("doc_id", whole_text().alias("text"))
               .repartitionByRange(*order).sortWithinPartitions(*order))
    return stored(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, doc_ids: set[int] | None = None) -> DataFrame:
    """Documents of the files, or those of a given small set of ids; ids as raw bytes.

    ``start`` is the number of ids of all documents before one.
    """

    def rows(file: TokenFile, base: int) -> Iterator[pa.RecordBatch]:
        chosen = np.arange(len(file.doc_ids)) if doc_ids is None else np.flatnonzero(
            file.known & np.isin(file.doc_ids, list(doc_ids)))
        step, first = 2000, 0
        while first < len(chosen):
            # A batch ends after so many documents, or with one that brings it to 32 MB.
            size = np.cumsum(file.counts[chosen[first:first + step]])
            last = first + min(len(size), 1 + int(np.searchsorted(size, 8 << 20)))
            at = chosen[first:last]
            yield pa.RecordBatch.from_arrays([
                pa.array(file.doc_ids[at], pa.int64(), mask=~file.known[at]),
                pa.array(base + file.starts[at], pa.int64()), pa.array(file.counts[at], pa.int64()),
                pa.array([file.document(int(i)).tobytes() for i in at], pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"])
            first = last

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, place in zip(batch["base"].to_pylist(), batch["file"].to_pylist()):
                store, path = fs.FileSystem.from_uri(place)
                with store.open_input_file(path) as source:
                    yield from rows(TokenFile(source), base)

    # The manifest has a row per file; where a file's ids begin is summed over those rows.
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("part", "file", F.coalesce(before, F.lit(0)).alias("base"))
    files = max(1, manifest.count())
    return placed.repartition(files, "part").mapInArrow(read, ROWS)
