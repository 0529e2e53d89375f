"""WARC archives with a Zstandard dictionary, written from and read back to DataFrames.

An archive is a file of frames. The first is a skippable frame that holds a dictionary built from
the archive's own records; each record follows as a frame of its own, compressed with it. So a
record can be read alone, and an archive needs no other file.

Of records with equal payloads one is stored in full (response), the others refer to it (revisit).
Every task writes the archives of its rows, a buffer of bounded size at a time, under names that
depend on the partition only; a file gets its name when it is complete, so a task that runs again
replaces what it wrote before.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.base import stored
from marketloom.session import scratch_path

#: Fixed values of the format: magic numbers of a dictionary's skippable frame and of a frame.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Settings:
    """``archive_bytes``: payload after which an archive is closed, the bound of a task's buffer but
    for one record; the dictionary is trained on at most ``sample_bytes`` of records spread over it."""

    least_bytes: int = 100
    archive_bytes: int = 32_000_000
    dictionary_bytes: int = 65_536
    sample_bytes: int = 4_000_000
    level: int = 6
    date: str = "1970-01-01T00:00:00Z"


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path there; works for any scheme that executors can reach."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def _one_line(value: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION.decode(), f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page: dict, date: str) -> bytes:
    """One page as a record: the payload behind an HTTP head, or a reference to the page that has it."""
    payload = (page["html"] or "").encode("utf-8", "surrogatepass") if page["record_type"] == "response" else b""
    headers = [
        ("WARC-Record-ID", f"<urn:page:{'' if page['page_id'] is None else page['page_id']}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{page['payload_digest']}"),
        ("Payload-Length", str(page["payload_bytes"])),
    ]
    if page["url"] is not None:
        headers.append(("WARC-Target-URI", _one_line(page["url"])))
    if page["record_type"] == "revisit":
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{page['refers_to']}>")]
        return _record("revisit", headers, b"")
    headers.append(("Content-Type", "application/http; msgtype=response"))
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return _record("response", headers, head.encode() + payload)


def archive_bytes(records: list[bytes], s: Settings) -> Iterator[bytes]:
    """The frames of an archive. Too few records to build a dictionary from leave it empty."""
    import zstandard

    step = max(1, -(-sum(map(len, records)) // s.sample_bytes))
    sample = [r[:131_072] for r in records[::step]]
    try:
        trained = zstandard.train_dictionary(s.dictionary_bytes, sample, k=1024, d=8)
    except zstandard.ZstdError:
        trained = zstandard.ZstdCompressionDict(b"")
    content = trained.as_bytes()
    yield struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content
    compressor = zstandard.ZstdCompressor(level=s.level, dict_data=trained if content else None)
    for record in records:
        yield compressor.compress(record)


def read_records(source, chunk: int = 65_536) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    import zstandard

    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    content = source.read(size)
    known = zstandard.ZstdCompressionDict(content) if content else None
    waiting = b""
    while True:
        if not waiting and not (waiting := source.read(chunk)):
            return
        frame, parts = zstandard.ZstdDecompressor(dict_data=known).decompressobj(), []
        while True:
            parts.append(frame.decompress(waiting))
            if frame.eof:
                break
            if not (waiting := source.read(chunk)):
                raise ValueError("the archive ends inside a record")
        waiting = frame.unused_data
        yield b"".join(parts)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != VERSION.decode():
        raise ValueError(f"not a record: {lines[0][:40]}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def classified(pages: DataFrame, s: Settings) -> DataFrame:
    """page_id, url, html and what is known of the payload: bytes, digest, record_type, refers_to.

    Only digests that occur more than once are joined, so that unique pages meet an empty side.
    """
    rows = pages.select("page_id", "url", "html").withColumns(
        {
            "payload_bytes": F.coalesce(F.octet_length("html"), F.lit(0)).cast("bigint"),
            "payload_digest": F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256),
        }
    )
    repeated = (
        rows.where(F.col("payload_bytes") >= s.least_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(repeated, "payload_digest", "left").select(
        "page_id",
        "url",
        F.when(revisit, None).otherwise(F.col("html")).alias("html"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _written(folder: str, s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, base = _store(folder)
        waiting: list[bytes] = []
        held = number = 0

        def close() -> pa.RecordBatch:
            name = f"pages-{context.partitionId():06d}-{number:05d}.warc.zst"
            final, draft = posixpath.join(base, name), posixpath.join(base, f".{name}.{context.taskAttemptId()}")
            info = _record("warcinfo", [("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", s.date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            store.create_dir(base, recursive=True)
            size = 0
            with store.open_output_stream(draft, compression=None) as out:
                for frame in archive_bytes([info, *waiting], s):
                    out.write(frame)
                    size += len(frame)
            store.move(draft, final)
            values = [[posixpath.join(folder, name)], [len(waiting)], [held], [size]]
            return pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["archive", "records", "raw_bytes", "archive_bytes"])

        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                for page in batch.slice(begin, 256).to_pylist():
                    record = page_record(page, s.date)
                    waiting.append(record)
                    held += len(record)
                    if held >= s.archive_bytes:
                        yield close()
                        waiting, held, number = [], 0, number + 1
        if waiting:
            yield close()

    return run


def write(pages: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives into ``folder``, which executors share.

    Returns archive, records, raw_bytes and archive_bytes per archive. A null html is an empty
    payload, a null url is left out of the record. Among repeated rows of a page each is written. Rows with a
    null id are no one's first copy, unless all copies have none: then all are responses.
    An empty table writes nothing.
    """
    rows = classified(pages, settings)
    return stored(
        rows.mapInArrow(_written(folder, settings), "archive string, records bigint, raw_bytes bigint, archive_bytes bigint"),
        "warc-archives",
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def cell(value: str) -> int | None:
        number = value.removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number else None

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]

    def flushed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for archive in batch.column(0).to_pylist():
            store, path = _store(archive)
            rows, size = [], 0
            with store.open_input_stream(path, compression=None) as source:
                for record in read_records(source):
                    headers, block = parse(record)
                    kind = headers["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                    if payload is not None and (hashlib.sha256(payload).hexdigest(), str(len(payload))) != (digest, headers["Payload-Length"]):
                        raise ValueError(f"damaged payload in {archive}: {headers['WARC-Record-ID']}")
                    refers = cell(headers["WARC-Refers-To"]) if kind == "revisit" else None
                    rows.append((cell(headers["WARC-Record-ID"]), int(headers["Payload-Length"]), digest, kind, refers, headers.get("WARC-Target-URI"), payload))
                    size += len(record)
                    if size > 8_000_000:
                        yield flushed(rows)
                        rows, size = [], 0
            if rows:
                yield flushed(rows)


def read(archives: DataFrame) -> DataFrame:
    """The records of the archives named in column ``archive``; payloads are checked against their digests.

    page_id, payload_bytes, payload_digest, record_type, refers_to, url and payload (null for a revisit).
    """
    return archives.select("archive").mapInArrow(
        _read,
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, payload binary",
    )


def round_trip(spark: SparkSession, pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Write the pages into a new folder of the shared storage and read the archives back."""
    archives = write(pages, scratch_path(spark, "warc"), settings)
    # one archive to a task, as far as rows can be dealt evenly
    dealt = archives.repartition(max(1, archives.count()))
    return read(dealt)
