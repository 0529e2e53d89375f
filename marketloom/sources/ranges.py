"""Files of any size read by byte ranges: content digests as a Merkle tree, and records of quoted CSV.

A file is listed as ranges, one row each, and many tasks read them; no task holds more than a piece of
a range in memory.

* Digests: a range's digest is a leaf; a node is the digest of up to ``FAN`` children in order. The root
  stands for the file, and leaves tell which ranges changed.
* Records: a line break ends a record unless it stands between quotes. Whether a range begins between
  quotes follows from the number of quotes before it: each range is counted alone, a running sum over the ranges
  of a file gives the state at every start, and then each range finds the records that begin in it. A doubled
  quote counts twice, so it never changes the state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

RANGE_BYTES = 64 << 20
PIECE = 1 << 20  # bytes held at once
AHEAD = 1 << 12  # bytes of the first piece where a line break is soon expected; each further piece doubles, up to PIECE
FAN = 1024  # children of a node
QUOTE, LF = b'"', b"\n"


def _opened(address: str):
    """A file for reading at any place, on the file system that its address names."""
    if address.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + address.removeprefix("file:").lstrip("/"))
    if "://" not in address:
        return pafs.LocalFileSystem().open_input_file(address)
    system, path = pafs.FileSystem.from_uri(address)
    return system.open_input_file(path)


def _listed(spark: SparkSession, path: str, range_bytes: int) -> tuple[DataFrame, int]:
    """The ranges of every file, and over how many tasks they are dealt: as a shuffle has, or as there are ranges.

    The number is named because adaptive execution sees the size of these rows only, not of the bytes they
    stand for, and would join all of them into one task.
    """
    files = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified")
    )
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint")))
    ranges = files.withColumn("start", starts).withColumn("size", F.least(F.lit(range_bytes).cast("bigint"), F.col("length") - F.col("start")))
    return ranges, max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), ranges.count()))


def list_ranges(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """file, length, modified, start and size: a row per byte range of every file, dealt over the tasks.

    An empty file has none. Contents are not read.
    """
    ranges, tasks = _listed(spark, path, range_bytes)
    return ranges.repartition(tasks, "file", "start")


# --- digests ---------------------------------------------------------------------------------


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            digest, at, end = hashlib.sha256(), row["start"], row["start"] + row["size"]
            with _opened(row["file"]) as source:
                while at < end:
                    piece = source.read_at(min(PIECE, end - at), at)
                    if not piece:
                        raise OSError(f"{row['file']} became shorter while it was read")
                    digest.update(piece)
                    at += len(piece)
            found.append(digest.hexdigest())
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("file", "length", "start")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], ["file", "length", "start", "digest"])


def range_digests(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """file, length, start and the SHA-256 ``digest`` of every byte range."""
    ranges = list_ranges(spark, path, range_bytes)
    return ranges.select("file", "length", "start", "size").mapInArrow(_digests, "file string, length bigint, start bigint, digest string")


def merkle_roots(leaves: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """file, length and ``root`` of the tree over each file's leaves (file, length, start, digest).

    A file of one range has that range's digest as its root. The levels are as many as the longest
    file needs; a node gathers at most ``FAN`` children.
    """
    longest = leaves.agg(F.max("length")).first()[0] or 0
    level = leaves.select("file", "length", F.floor(F.col("start") / range_bytes).alias("at"), F.col("digest").alias("node"))
    nodes = max(1, -(-longest // range_bytes))
    while nodes > 1:
        children = F.array_sort(F.collect_list(F.struct("at", "node")))
        joined = F.concat(F.lit("node:"), F.array_join(F.transform("children", lambda c: c["node"]), ""))
        level = (
            level.groupBy("file", "length", F.floor(F.col("at") / FAN).alias("at"))
            .agg(children.alias("children"))
            .select("file", "length", "at", F.when(F.size("children") == 1, F.col("children")[0]["node"]).otherwise(F.sha2(joined, 256)).alias("node"))
        )
        nodes = -(-nodes // FAN)
    return level.select("file", "length", F.col("node").alias("root"))


def changed_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """file, start and ``change`` (changed, added, removed) of the leaves that differ."""
    both = before.select("file", "start", F.col("digest").alias("old")).join(after.select("file", "start", F.col("digest").alias("new")), ["file", "start"], "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return both.select("file", "start", change.alias("change")).where("change IS NOT NULL")


# --- records of quoted CSV ---------------------------------------------------------------------


def _quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            count, at, end = 0, row["start"], row["start"] + row["size"]
            with _opened(row["file"]) as source:
                while at < end:
                    piece = source.read_at(min(PIECE, end - at), at)
                    count += piece.count(QUOTE)
                    at += max(1, len(piece))
            found.append(count % 2)
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("file", "length", "start", "size")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int32())], ["file", "length", "start", "size", "odd"])


def record_ends(piece: bytes, quoted: bool) -> tuple[list[int], bool]:
    """Places of the line feeds outside quotes, and whether the piece ends between quotes."""
    ends, at = [], 0
    while True:
        if quoted:
            close = piece.find(QUOTE, at)
            if close < 0:
                return ends, True
            at, quoted = close + 1, False
        else:
            open_ = piece.find(QUOTE, at)
            stop = len(piece) if open_ < 0 else open_
            feed = piece.find(LF, at, stop)
            while feed >= 0:
                ends.append(feed)
                feed = piece.find(LF, feed + 1, stop)
            if open_ < 0:
                return ends, False
            at, quoted = open_ + 1, True


def _records_of(source, start: int, end: int, length: int, quoted: bool) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the records that begin in the range, read on to the end of the last one.

    ``quoted`` is the state at ``start``. A record begins behind the line feed that ends the one before,
    which may be the last byte before the range, so that byte is looked at again.
    """
    at = max(0, start - 1)
    if at < start and source.read_at(1, at) == QUOTE:
        quoted = not quoted
    held, begun, ahead = [], start, AHEAD
    inside = start == 0  # else the record that is under way belongs to an earlier range
    while at < length:
        if at < end:
            piece = source.read_at(min(PIECE, end - at), at)
        else:
            piece, ahead = source.read_at(min(PIECE, ahead, length - at), at), 2 * ahead
        if not piece:
            break
        ends, quoted = record_ends(piece, quoted)
        cut = 0
        for feed in ends:
            if inside:
                yield begun, b"".join(held) + piece[cut:feed]
            held, cut, begun, inside = [], feed + 1, at + feed + 1, True
            if begun >= end:
                return
        held.append(piece[cut:])
        at += len(piece)
        if not inside:
            held.clear()
            if at >= end:
                return  # no record begins here
    if inside and begun < length:
        yield begun, b"".join(held)


def _breaks_with_return(source, length: int) -> bool:
    """Whether the file's first line break is a carriage return with a line feed."""
    at, last, ahead = 0, b"", AHEAD
    while at < length:
        piece, ahead = source.read_at(min(PIECE, ahead, length - at), at), 2 * ahead
        feed = piece.find(LF)
        if feed >= 0 or not piece:
            return (last + piece[:feed]).endswith(b"\r")
        at, last = at + len(piece), piece[-1:]
    return False


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flushed(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
        columns = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["file", "place", "record"])

    rows, size = [], 0  # of as many ranges as make a batch
    for batch in batches:
        for row in batch.to_pylist():
            file = row["file"]
            with _opened(file) as source:
                returns = _breaks_with_return(source, row["length"])
                for place, record in _records_of(source, row["start"], row["start"] + row["size"], row["length"], row["quoted"]):
                    if returns:
                        record = record.removesuffix(b"\r").replace(b"\r\n", b"\n")
                    rows.append((file, place, record.decode("utf-8", "replace")))
                    size += len(record)
                    if size > 4 * PIECE:
                        yield flushed(rows)
                        rows, size = [], 0
    if rows:
        yield flushed(rows)


def read_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """file, place (of the first byte) and text of every record of CSV files, headers included.

    Line breaks between quotes belong to the record; where a file's first line break is a carriage return with
    a line feed, those between quotes become line feeds, as in Spark's reader of whole files. Blank lines are left out. A quote that is never closed makes the rest of the file one record.
    """
    listed, tasks = _listed(spark, path, range_bytes)
    ranges = listed.select("file", "length", "start", "size").repartition(tasks, "file", "start")
    counted = ranges.mapInArrow(_quotes, "file string, length bigint, start bigint, size bigint, odd int")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    stated = counted.withColumn("quoted", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    dealt = stated.select("file", "length", "start", "size", "quoted").repartition(tasks, "file", "start")
    return dealt.mapInArrow(_records, "file string, place bigint, record string").where(F.length("record") > 0)


def read_quoted(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, malformed: str | None = None) -> DataFrame:
    """Quoted CSV files with a header as text columns, and ``_source_file``, the name of each row's file.

    The columns are named by the first line of the first file; every file begins with that line.
    A record with too few or too many fields is shown whole in the column ``malformed``, if one is named.
    """
    records = read_records(spark, path, range_bytes)
    first = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).schema
    fields = T.StructType([T.StructField(name, T.StringType()) for name in [*first.names, *([malformed] if malformed else [])]])
    options = {"escape": '"'} | ({"columnNameOfCorruptRecord": malformed} if malformed else {})
    row = F.from_csv("record", ", ".join(f"`{name}` string" for name in fields.names), options)
    return records.where("place > 0").select(row.alias("row"), F.element_at(F.split("file", "/"), -1).alias("_source_file")).select("row.*", "_source_file")
