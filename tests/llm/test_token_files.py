import io
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from railpulse.llm import token_files
from railpulse.session import shared_folder
from tests.llm import cases


def expected():
    """Rows in the order of ids, nulls first."""
    library = Tokenizer.from_file(cases.TOKENIZER)
    at, out = 0, []
    for doc_id, text in sorted([(r[0], r[1] or "") for r in cases.ROWS],
                               key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("frame_bytes", [64, token_files.FRAME_BYTES])
def test_round_trip(spark, frame_bytes):
    docs = cases.unusual(spark, clashing=True).repartition(3)
    manifest = token_files.write_token_files(docs, shared_folder(spark, "t"), cases.TOKENIZER, 0, frame_bytes)
    rows = token_files.read_token_files(manifest).collect()
    found = [(r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in rows]
    assert sorted(found, key=lambda r: r[1]) == expected()
    some = token_files.read_token_files(manifest, {1, 6, 404}).collect()
    assert sorted(r["doc_id"] for r in some) == [1, 6, 6]


def test_empty_table(spark):
    manifest = token_files.write_token_files(cases.empty(spark), shared_folder(spark, "t"), cases.TOKENIZER)
    assert token_files.read_token_files(manifest).count() == 0


def written(frame_bytes, documents):
    out = io.BytesIO()
    writer = token_files.TokenFileWriter(out, frame_bytes)
    for k, ids in enumerate(documents):
        writer.add(k, np.array(ids, np.uint32))
    writer.close()
    return out.getvalue()


def test_only_requested_frames_are_read_and_checked():
    documents = [list(range(k, k + 100)) for k in range(200)]
    raw = written(1024, documents)
    file = token_files.TokenFile(io.BytesIO(raw))
    assert file.document(150).tolist() == documents[150]
    assert file.frames_read <= 2
    # Any zstandard reader takes the frames as one stream and skips the tables.
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True)
    assert stream.read() == np.array(sum(documents, []), "<u4").tobytes()
    broken = bytearray(raw)
    broken[len(raw) // 3] ^= 0xFF
    file, failed = token_files.TokenFile(io.BytesIO(bytes(broken))), 0
    for k in range(200):
        try:
            assert file.document(k).tolist() == documents[k]
        except (ValueError, zstandard.ZstdError):
            failed += 1
    assert 0 < failed < 10


def test_no_seek_table():
    with pytest.raises(ValueError):
        token_files.TokenFile(io.BytesIO(b"x" * 100))
