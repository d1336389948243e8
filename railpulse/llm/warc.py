"""WARC archives: a writer with revisit records, and a reader that salvages damaged files.

Writing. Payloads of at least ``LEAST`` bytes that equal an earlier one become revisit
records that name it; the response is that of the smallest ``page_id``. Every record is a
gzip member of its own. Tasks write their rows to files of about ``ARCHIVE_BYTES``; a file
counts only through the manifest, so those of lost or repeated attempts are never read.

Reading. Records are taken from members (or, in archives that are not compressed, from
version lines) one by one. A member must inflate with the right checksum, a record must have
a version line, headers, a block of the stated length with the closing blank lines, and a
payload of the stated digest. Where a check fails, the reader searches for the next gzip
magic or version line that starts a valid record and goes on there; the bytes between are
logged as a quarantined gap with the reason. Members and gaps cover an archive from its
first byte to its last.

A member may hold several records. Where one of them fails, the search goes on in the
inflated bytes, and the gap there is logged with its place in them (``inside``). Of a member
that does not inflate to its end or has a wrong checksum, what did inflate is searched too: a
record there counts if its payload's digest is stated and holds, its ``length`` is null, and
the member's bytes are a gap all the same. Headers may be of any length.

Null html is an empty payload, a null url an empty target. Null ids make records without a
page number, which are no candidates for a response that others name. Rows that repeat the
smallest id of a payload are all responses. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railpulse.llm.tables import stored, whole_text
from railpulse.operators.timetable import join_on

LEAST, ARCHIVE_BYTES, READ_BYTES = 100, 32 << 20, 1 << 16
#: Fixed values of the formats.
GZIP_MAGIC, VERSION, BLANK = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
PAGE_NAME = re.compile(r"<urn:page:(-?\d+)>")
MANIFEST = "archive string, records long, bytes long"
READ = ("archive string, at long, length long, inside long, inside_length long, reason string, "
        "record_type string, page_id long, refers_to long, target string, payload_bytes long, "
        "payload_digest string, payload binary")
DRILL = ("archive string, records long, damaged_from long, damaged_bytes long, struck long, "
         "recovered long, lost_unstruck long, quarantined_bytes long")
READ_NAMES = [column.split()[0] for column in READ.split(", ")]


def with_record_types(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, refers_to`` (null for responses)."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string").alias("url"),
                        whole_text("html").alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("long").alias("payload_bytes"),
                       F.sha2(F.col("html"), 256).alias("payload_digest"))
    copies = (rows.where(F.col("payload_bytes") >= LEAST).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
              .where("n > 1").drop("n"))
    known = join_on(rows, copies, ["payload_digest"])
    return known.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")),
                                                F.col("first_id"))).drop("first_id")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record; a revisit has the HTTP header of the full payload and no body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    name = f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}>"
    target = re.sub(r"\s", "%20", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {name}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + BLANK + block + BLANK


def gzip_member(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_archives(typed: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives under ``folder``; returns the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        attempt, number, out, size, count = uuid.uuid4().hex, 0, None, 0, 0
        done = []

        def close() -> None:
            nonlocal out, size, count, number
            out.close()
            done.append((f"{folder}/{name}", count, size))
            out, size, count, number = None, 0, 0, number + 1

        for batch in batches:
            columns = [batch[c] for c in ("page_id", "url", "html", "payload_digest", "refers_to")]
            for row in range(batch.num_rows):
                page_id, url, html, digest, refers_to = (c[row].as_py() for c in columns)
                if out is None:
                    name = f"{TaskContext.get().partitionId():06d}-{number:04d}-{attempt}.warc.gz"
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                member = gzip_member(record(page_id, url, html.encode(), digest, refers_to))
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    close()
        if out is not None:
            close()
        if done:
            places, counts, sizes = zip(*done)
            yield pa.RecordBatch.from_pydict({"archive": list(places), "records": pa.array(counts, pa.int64()),
                                              "bytes": pa.array(sizes, pa.int64())})

    return stored(typed.mapInArrow(write, MANIFEST), "archives")


class Found(NamedTuple):
    """A record that passed every check, or a gap (no record) with the reason.

    ``inside``: place in the member's inflated bytes, null for gaps between members and records.
    """

    at: int
    length: int | None
    inside: int | None
    inside_length: int | None
    reason: str | None
    headers: dict[str, str]
    payload: bytes


class Invalid(Exception):
    """A failed check; ``inflated`` is what came out of a member before it."""

    def __init__(self, reason: str, inflated: bytes = b""):
        super().__init__(reason)
        self.inflated = inflated


def parse_record(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and end of the record that starts at a place in ``raw``."""
    if not raw.startswith(VERSION, at):
        raise Invalid("no version line")
    head = raw.find(BLANK, at)
    if head < 0:
        raise Invalid("headers do not end")
    try:
        lines = raw[at:head].decode().split("\r\n")
    except UnicodeDecodeError:
        raise Invalid("headers are no UTF-8") from None
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Invalid("header without a colon")
        name = name.strip().lower()
        if name in headers and name != "warc-concurrent-to":  # two records run into one
            raise Invalid("repeated header")
        headers[name] = value.strip()
    if not headers.get("content-length", "").isdigit():
        raise Invalid("no content length")
    begin = head + len(BLANK)
    end = begin + int(headers["content-length"])
    if raw[end:end + len(BLANK)] != BLANK:
        raise Invalid("block is not of the stated length")
    block = raw[begin:end]
    body = block.find(BLANK) if "application/http" in headers.get("content-type", "") else -len(BLANK)
    if body < 0 and body != -len(BLANK):
        raise Invalid("no HTTP header in the block")
    payload = block[body + len(BLANK):]
    stated = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") != "revisit" and stated.startswith("sha256:"):
        if hashlib.sha256(payload).hexdigest() != stated.removeprefix("sha256:"):
            raise Invalid("payload differs from its digest")
    if headers.get("warc-type") == "revisit" and body >= 0:
        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", block)
        headers["full-length"] = length[1].decode() if length else ""
    return headers, payload, end + len(BLANK)


class SalvageReader:
    """Records and gaps of one archive, in the order of its bytes."""

    def __init__(self, source):
        self._source = source
        self._size = source.size()
        self._block: tuple[int, bytes] = (0, b"")

    def _read(self, at: int, length: int) -> bytes:
        self._source.seek(at)
        return self._source.read(length)

    def _inflate(self, at: int) -> tuple[bytes, int]:
        """Content and end of the member at a place."""
        machine, parts = zlib.decompressobj(31), []
        place = at
        while not machine.eof:
            raw = self._read(place, READ_BYTES)
            if not raw:
                raise Invalid("member is cut off", b"".join(parts))
            before = machine.copy()
            try:
                parts.append(machine.decompress(raw))
            except zlib.error as error:
                for k in range(len(raw)):  # what this read gives up to the failing byte
                    try:
                        parts.append(before.decompress(raw[k:k + 1]))
                    except zlib.error:
                        break
                raise Invalid(f"member does not inflate: {error}", b"".join(parts)) from None
            place += len(raw)
        return b"".join(parts), place - len(machine.unused_data)

    def _plain(self, at: int) -> tuple[bytes, int]:
        """Content and end of the record whose version line is at a place."""
        raw, line = self._read(at, READ_BYTES), 0
        while (head := raw.find(BLANK)) < 0:
            # Junk is given up at its first line without a colon, not read to its end.
            while (end := raw.find(b"\r\n", line)) >= 0:
                if line and b":" not in raw[line:end]:
                    raise Invalid("header without a colon")
                line = end + 2
            more = self._read(at + len(raw), len(raw))
            if not more:
                raise Invalid("headers do not end")
            raw += more
        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", raw[:head])
        if length is None:
            raise Invalid("no headers with a content length")
        end = at + head + 2 * len(BLANK) + int(length[1])
        if end > self._size:
            raise Invalid("record is cut off")
        return self._read(at, end - at), end

    def _member(self, at: int) -> tuple[bytes, int, bool]:
        """Content and end of the member, or of the record by itself, at a place; whether it is a member."""
        start = self._read(at, 8)
        if start.startswith(GZIP_MAGIC):
            return *self._inflate(at), True
        if start.startswith(VERSION):
            raw, end = self._plain(at)
            if parse_record(raw)[2] != len(raw):
                raise Invalid("record is not of the stated length")
            return raw, end, False
        raise Invalid("neither a member nor a version line")

    @staticmethod
    def _inside(raw: bytes, at: int, length: int | None) -> Iterator[Found]:
        """Records and gaps of inflated bytes. Without ``length`` the member failed: then only
        records with a digest that holds count, and gaps are not listed, as its bytes are one."""
        place, gap, reason = 0, None, ""
        while place < len(raw):
            try:
                headers, payload, end = parse_record(raw, place)
                if length is None and (headers.get("warc-type") == "revisit" or not headers.get(
                        "warc-payload-digest", "").startswith("sha256:")):
                    raise Invalid("no digest of its own in a broken member")
            except Invalid as error:
                if gap is None:
                    gap, reason = place, str(error)
                place = raw.find(VERSION, place + 1)
                if place < 0:
                    place = len(raw)
                continue
            if gap is not None and length is not None:
                yield Found(at, length, gap, place - gap, reason, {}, b"")
            gap = None
            yield Found(at, length, place, end - place, None, headers, payload)
            place = end
        if gap is not None and length is not None:
            yield Found(at, length, gap, len(raw) - gap, reason, {}, b"")

    def _next_start(self, at: int) -> int:
        """Place of the next magic or version line, or the end of the archive."""
        overlap = len(VERSION) - 1
        while at < self._size:
            raw = self._read(at, READ_BYTES + overlap)
            places = [p for p in (raw.find(GZIP_MAGIC), raw.find(VERSION)) if p >= 0]
            if places:
                return at + min(places)
            at += READ_BYTES
        return self._size

    def __iter__(self) -> Iterator[Found]:
        at, gap, reason = 0, None, ""
        while at < self._size:
            try:
                raw, end, packed = self._member(at)
            except Invalid as error:
                if gap is None:
                    gap, reason = at, str(error)
                yield from self._inside(error.inflated, at, None)
                at = self._next_start(at + 1)
                continue
            if gap is not None:
                yield Found(gap, at - gap, None, None, reason, {}, b"")
                gap = None
            if packed:
                yield from self._inside(raw, at, end - at)
            else:
                headers, payload, _ = parse_record(raw)
                yield Found(at, end - at, None, None, None, headers, payload)
            at = end
        if gap is not None:
            yield Found(gap, self._size - gap, None, None, reason, {}, b"")


def _row(archive: str, found: Found) -> tuple:
    if found.reason is not None:
        return (archive, *found[:5], *[None] * 7)
    headers = found.headers
    numbers = [int(m[1]) if (m := PAGE_NAME.fullmatch(headers.get(h, ""))) else None
               for h in ("warc-record-id", "warc-refers-to")]
    revisit = headers.get("warc-type") == "revisit"
    size = int(headers["full-length"]) if revisit and headers.get("full-length") else len(found.payload)
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:") or None
    return (archive, *found[:5], headers.get("warc-type"), *numbers,
            headers.get("warc-target-uri"), size, digest, None if revisit else found.payload)


def read_archives(archives: DataFrame) -> DataFrame:
    """Records, and gaps (rows with a ``reason``), of the files in column ``archive``."""
    schema = pa.schema([(name, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind])
                        for name, kind in (c.split() for c in READ.split(", "))])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch["archive"].to_pylist():
                store, path = fs.FileSystem.from_uri(place)
                with store.open_input_file(path) as source:
                    rows, size = [], 0
                    for found in SalvageReader(source):
                        rows.append(_row(place, found))
                        size += len(found.payload)
                        if len(rows) >= 1000 or size >= 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch_of(rows)

    files = max(1, archives.count())
    return archives.select("archive").repartition(files, "archive").mapInArrow(read, READ)


def split_read(found: DataFrame, manifest: DataFrame, quarantine: str) -> DataFrame:
    """The records of archives just read and stored; gaps go to ``quarantine``, as Parquet.

    Raises where an archive gave other than the records its manifest states: results are whole
    or there are none.
    """
    found.where("reason is not null").drop("payload").write.mode("append").parquet(quarantine)
    records = found.where("reason is null")
    read = records.groupBy("archive").agg(F.count("*").alias("n_read"))
    short = (manifest.join(read, "archive", "left").where(F.coalesce("n_read", F.lit(0)) != F.col("records"))
             .select(F.count("*"), F.min("archive")).first())
    if short[0]:
        raise ValueError(f"{short[0]} archives gave other than their records, such as {short[1]}; see {quarantine}")
    return records


def salvage_drill(archives: DataFrame, folder: str, every: int = 8) -> DataFrame:
    """Damages a copy of the archives of every ``every``-th writing task and salvages it.

    The middle sixteenth of a copy is overwritten. Per copy: records of the archive, the bytes
    damaged, records they struck, records recovered, records lost though not struck (none, if the
    reader does its work) and bytes in quarantine. Copies that are not needed longer stay in
    ``folder``, which is scratch.
    """
    schema = pa.schema([(name, {"string": pa.string(), "long": pa.int64()}[kind])
                        for name, kind in (c.split() for c in DRILL.split(", "))])

    def drill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in batch["archive"].to_pylist():
                store, path = fs.FileSystem.from_uri(place)
                target, root = fs.FileSystem.from_uri(folder)
                target.create_dir(root)
                copy = f"{root}/{uuid.uuid4().hex}-{path.rsplit('/', 1)[-1]}"
                with store.open_input_file(path) as source:
                    size = source.size()
                    begin, length = size // 2, max(1, size // 16)
                    with target.open_output_stream(copy, compression=None) as out:
                        at = 0
                        while at < size:
                            source.seek(at)
                            block = bytearray(source.read(min(1 << 20, size - at)))
                            low, high = max(begin - at, 0), min(begin + length - at, len(block))
                            if low < high:
                                block[low:high] = b"\xa5" * (high - low)
                            out.write(bytes(block))
                            at += len(block)
                    # Places, not payloads, are kept: some tens of bytes a record of one archive.
                    whole = {(f.at, f.inside): f.length for f in SalvageReader(source) if f.reason is None}
                with target.open_input_file(copy) as source:
                    got, gaps = set(), 0
                    for f in SalvageReader(source):
                        if f.reason is None:
                            got.add((f.at, f.inside))
                        elif f.inside is None:
                            gaps += f.length
                struck = {key for key, n in whole.items() if key[0] < begin + length and begin < key[0] + n}
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (
                    place, len(whole), begin, length, len(struck), len(got & whole.keys()),
                    len(whole.keys() - struck - got), gaps)))], schema=schema)

    chosen = archives.where(F.regexp_extract("archive", r"/(\d{6,})-\d+-[^/]*$", 1).cast("long") % every == 0)
    return chosen.select("archive").repartition(max(1, archives.count()), "archive").mapInArrow(drill, DRILL)
