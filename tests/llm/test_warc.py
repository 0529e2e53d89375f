from __future__ import annotations

import hashlib
import io
import struct
from collections import defaultdict

import pytest
import zstandard

from marketloom.llm import warc
from marketloom.session import scratch_path

SCHEMA = "page_id long, url string, html string, payload string, first_id long"


def rows():
    out = [(i, f"http://h{i % 3}/p?{i}", f"<html>page {i} " + "text é " * (i % 60) + "</html>") for i in range(400)]
    out += [(1000 + i, "http://x/", "copied page " * 20) for i in range(300)]
    out += [(2000, None, "short"), (2001, "u\r\nX: y", "short"), (2002, "http://e/", None), (2003, "http://e/", ""), (None, "http://n/", "null id " * 30)]
    out += [(990, "http://x/", "copied page " * 20), (7, "http://dup/", "twice " * 50), (7, "http://dup/", "twice " * 50), (2004, "http://w/", "\r\n\r\nWARC/1.1\r\n" * 20_000)]
    return out


def brute(data):
    first = defaultdict(list)
    for i, _, html in data:
        first[html or ""].append(i)
    out = []
    for i, _, html in data:
        payload = (html or "").encode()
        ids = [x for x in first[html or ""] if x is not None]
        revisit = len(payload) >= 100 and ids and i != min(ids)
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", min(ids) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("archive_bytes", [5_000, 32_000_000])
def test_round_trip(spark, archive_bytes):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows()], SCHEMA)
    found = warc.round_trip(spark, pages, warc.Settings(archive_bytes=archive_bytes)).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute(rows())
    payloads = {r["payload_digest"]: r["payload"] for r in found if r["record_type"] == "response"}
    assert all(hashlib.sha256(p).hexdigest() == d for d, p in payloads.items())


def test_archive_is_frames_behind_a_dictionary(spark):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows()], SCHEMA)
    archives = warc.write(pages.coalesce(1), scratch_path(spark, "warc-test")).collect()
    content = b"".join(open("/" + a["archive"].removeprefix("file:").lstrip("/"), "rb").read() for a in archives[:1])
    magic, size = struct.unpack("<II", content[:8])
    assert magic == 0x184D2A5D and size > 0
    known = zstandard.ZstdCompressionDict(content[8 : 8 + size])
    rest, records = content[8 + size :], []
    while rest:
        frame = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
        records.append(frame.decompress(rest))
        rest = frame.unused_data
    assert len(records) == archives[0]["records"] + 1
    assert all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
    assert list(warc.read_records(io.BytesIO(content), chunk=7)) == records


def test_damage_is_found():
    settings = warc.Settings()
    page = {"page_id": 1, "url": "u", "html": "x" * 500, "record_type": "response", "payload_digest": "0" * 64, "payload_bytes": 500, "refers_to": None}
    content = b"".join(warc.archive_bytes([warc.page_record(page, settings.date)], settings))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(content[:-3])))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"\0" * 20)))


def test_empty(spark):
    assert warc.round_trip(spark, spark.createDataFrame([], SCHEMA)).collect() == []
