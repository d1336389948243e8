import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from railpulse.llm import warc
from railpulse.session import shared_folder

HTML = "<html>" + "page with a long enough body " * 8 + "</html>"
PAGES = [(1, "http://a/ b", HTML), (2, None, HTML), (-3, "http://c", HTML + "é"), (4, "http://d", None),
         (5, "http://e", ""), (6, "http://f", "short"), (7, "http://g", "short"), (8, "http://h", "x" * 300_000),
         (None, "http://i", HTML), (2, "http://j", HTML), (9, "http://k", "\r\n\r\nWARC/1.1\r\n" * 40),
         (1, "http://l", HTML)]


def archive(records, packed=True):
    members = [warc.record(k, f"http://x/{k}", p, hashlib.sha256(p).hexdigest(), None)
               for k, p in enumerate(records)]
    return [warc.gzip_member(m) if packed else m for m in members]


def salvaged(raw):
    return list(warc.SalvageReader(pa.BufferReader(raw)))


def cover(found, raw):
    """Members and gaps follow each other from the first byte to the last; so do a member's records and gaps."""
    at = inner = 0
    for f in found:
        if f.length is None:  # from a broken member, whose bytes are in a gap
            continue
        if f.inside:
            assert f.inside == inner and f.at + f.length == at
        else:
            assert f.at == at
            at += f.length
        inner = (f.inside or 0) + (f.inside_length or 0)
    assert at == len(raw)


PAYLOADS = [b"one " * 50, b"", b"WARC/1.1 inside " * 20, bytes(range(256)) * 9, b"five"]


@pytest.mark.parametrize("packed", [True, False])
def test_whole_archive(packed):
    raw = b"".join(archive(PAYLOADS, packed))
    found = salvaged(raw)
    assert [f.payload for f in found] == PAYLOADS and all(f.reason is None for f in found)
    cover(found, raw)


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("hit", range(5))
@pytest.mark.parametrize("how", ["flip", "cut", "junk", "zero"])
def test_damage_costs_one_record(packed, hit, how):
    members = archive(PAYLOADS, packed)
    broken, spared = bytearray(members[hit]), [p for k, p in enumerate(PAYLOADS) if k != hit]
    if how == "flip":
        broken[len(broken) // 2] ^= 0xFF
    elif how == "cut":
        broken = broken[:len(broken) // 2]
    elif how == "zero":
        broken = bytearray(len(broken))
    else:
        broken, spared = bytearray(b"\x1f\x8b\x08junk WARC/1.0 \x1f\x8b") + broken, PAYLOADS
    raw = b"".join([*members[:hit], bytes(broken), *members[hit + 1:]])
    found = salvaged(raw)
    got = [f.payload for f in found if f.reason is None]
    gaps = [f for f in found if f.reason is not None]
    assert [p for p in got if p in spared] == spared
    if not packed and how == "flip" and hit in (1, 2):
        return  # the flipped byte is in a header, which no check covers there
    assert len(gaps) == 1
    cover(found, raw)


def test_digest_is_checked():
    raw = warc.gzip_member(warc.record(1, "u", b"payload", "0" * 64, None))
    assert [f.reason for f in salvaged(raw)] == ["payload differs from its digest"]


def test_junk_only_and_nothing():
    assert [(f.at, f.length) for f in salvaged(b"junk" * 50_000)] == [(0, 200_000)]
    assert salvaged(b"") == []


@pytest.mark.parametrize("size", [1, warc.ARCHIVE_BYTES])
def test_round_trip(spark, size):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns(
        {c: F.lit("x") for c in ("archive", "payload", "first_id", "n", "refers_to")})
    manifest = warc.write_archives(warc.with_record_types(pages), shared_folder(spark, "w"), size)
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    rows = warc.read_archives(manifest).collect()
    assert all(r["reason"] is None for r in rows)
    firsts = {}
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        if page_id is not None and len(raw) >= 100:
            firsts[raw] = min(page_id, firsts.get(raw, page_id))
    want = []
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        other = firsts.get(raw) if firsts.get(raw) != page_id else None
        want.append((str(page_id), len(raw), hashlib.sha256(raw).hexdigest(),
                     "response" if other is None else "revisit", other, raw if other is None else None))
    assert sorted(map(str, want)) == sorted(
        str((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
             None if r["payload"] is None else bytes(r["payload"]))) for r in rows)


def test_damaged_file_in_a_job(spark):
    folder = shared_folder(spark, "w")
    pages = spark.createDataFrame([(k, f"u{k}", f"{k} " * 200) for k in range(50)],
                                  "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_archives(warc.with_record_types(pages), folder)
    place = manifest.first()["archive"].removeprefix("file://")
    with open(place, "r+b") as file:
        file.seek(1500)
        file.write(b"\0" * 300)
    rows = warc.read_archives(manifest).collect()
    gaps = [r for r in rows if r["reason"] is not None]
    assert len(gaps) == 1 and gaps[0]["length"] >= 300
    assert 45 <= len(rows) - 1 < 50


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.with_record_types(pages), shared_folder(spark, "w"))
    assert warc.read_archives(manifest).count() == 0


def test_streams_are_not_needed_whole():
    # A record far larger than the read size is found after junk.
    raw = b"\0" * 100_000 + b"".join(archive([b"y" * 3_000_000, b"z"]))
    found = salvaged(raw)
    assert [len(f.payload) for f in found if f.reason is None] == [3_000_000, 1]


def several(payloads):
    parts = archive(payloads, packed=False)
    return parts, b"".join(parts)


def test_failed_record_inside_a_member():
    parts, content = several(PAYLOADS)
    start = len(parts[0]) + len(parts[1])
    spoiled = bytearray(content)
    spoiled[start + len(parts[2]) - 10] ^= 1  # in the third payload
    raw = b"".join(archive([b"before"])) + warc.gzip_member(bytes(spoiled)) + b"".join(archive([b"after"]))
    found = salvaged(raw)
    assert [f.payload for f in found if f.reason is None] == [
        b"before", PAYLOADS[0], PAYLOADS[1], PAYLOADS[3], PAYLOADS[4], b"after"]
    (gap,) = [f for f in found if f.reason is not None]
    assert (gap.inside, gap.inside_length) == (start, len(parts[2]))
    cover(found, raw)


@pytest.mark.parametrize("how", ["cut", "flip", "checksum"])
def test_records_of_a_broken_member(how):
    source = np.random.default_rng(1)
    payloads = [source.bytes(50_000) for _ in range(6)]
    member = bytearray(warc.gzip_member(several(payloads)[1]))
    if how == "cut":
        member = member[:len(member) // 2]
    elif how == "flip":
        member[len(member) // 2:len(member) // 2 + 40] = bytes(40)
    else:
        member[-6] ^= 1
    raw = bytes(member) + b"".join(archive([b"after"]))
    found = salvaged(raw)
    got = [f.payload for f in found if f.reason is None]
    assert got[:2] == payloads[:2] and got[-1] == b"after"
    assert set(got[:-1]) <= set(payloads) and len(got) == len(set(got))
    if how == "checksum":
        assert got[:-1] == payloads
    (gap,) = [f for f in found if f.reason is not None]
    assert (gap.at, gap.length) == (0, len(member)) and gap.inside is None
    assert all(f.length is None for f in found if f.reason is None and f.payload != b"after")
    cover(found, raw)


def test_revisit_in_a_broken_member_is_not_trusted():
    part = warc.record(3, "u", b"x" * 200, hashlib.sha256(b"x" * 200).hexdigest(), 1)
    member = bytearray(warc.gzip_member(part))
    member[-6] ^= 1
    assert [f.reason is None for f in salvaged(bytes(member))] == [False]


@pytest.mark.parametrize("packed", [True, False])
def test_long_headers(packed):
    lines = b"".join(b"X-Note-%d: %s\r\n" % (k, b"n" * 1000) for k in range(200))
    part = archive([b"payload"], packed=False)[0].replace(b"WARC-Date", lines + b"WARC-Date")
    raw = b"".join([warc.gzip_member(part) if packed else part, *archive([b"next"], packed)])
    found = salvaged(raw)
    assert [f.payload for f in found if f.reason is None] == [b"payload", b"next"]
    assert all(f.reason is None for f in found)
    cover(found, raw)


def test_version_lines_in_junk():
    raw = b"WARC/1.1\r\n" * 30_000 + b"".join(archive([b"kept"], packed=False))
    found = salvaged(raw)
    assert [f.payload for f in found if f.reason is None] == [b"kept"]
    cover(found, raw)


def test_drill_and_quarantine(spark):
    pages = spark.createDataFrame([(k, f"u{k}", hashlib.sha256(b"%d" % k).hexdigest() * 40) for k in range(300)],
                                  "page_id long, url string, html string").repartition(3)
    manifest = warc.write_archives(warc.with_record_types(pages), shared_folder(spark, "w"))
    rows = warc.salvage_drill(manifest, shared_folder(spark, "d"), every=1).collect()
    assert len(rows) == manifest.count() and sum(r["records"] for r in rows) == 300
    for r in rows:
        assert r["struck"] and r["lost_unstruck"] == 0 and r["quarantined_bytes"] >= r["damaged_bytes"]
        assert r["records"] - r["struck"] <= r["recovered"] < r["records"]
    found = warc.read_archives(manifest)
    kept = warc.split_read(found, manifest, shared_folder(spark, "q"))
    assert kept.count() == 300
    place = manifest.first()["archive"].removeprefix("file://")
    with open(place, "r+b") as file:
        file.seek(3000)
        file.write(b"\0" * 300)
    quarantine = shared_folder(spark, "q")
    with pytest.raises(ValueError, match="1 archives gave other than their records"):
        warc.split_read(warc.read_archives(manifest), manifest, quarantine)
    assert spark.read.parquet(quarantine).count() == 1
