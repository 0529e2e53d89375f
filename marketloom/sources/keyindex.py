"""Key index of an appended table: which of its files may hold a key.

Beside a table's files stands, for each of them, the least and the greatest key and a Bloom filter of
all its keys. A load compares its keys with the index first and opens only the files that may
hold one of them; what the filter takes falsely is found out there, by comparison with the keys themselves.
So the cost of a load follows its own rows and the index, not the rows stored before it. A load of so many keys
that comparing them with the index would cost more than reading the stored keys opens every file whose range it meets.

The filter is cut into blocks of 32,768 bits, and a key sets all of its bits in one block, so a key is looked up
by joining one row. All of it is done with built-in functions: hashes, bitmaps and joins.

The index lies in a hidden folder of the table, a part per load. A full refresh replaces the folder, index
included; a file without an entry (written by other means, or by a load that died before it was indexed)
is opened whenever its keys are asked for, and indexed with the next load.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import brief_shuffles
from marketloom.sources.sinks import stored

FOLDER = "_keys"
BLOCK_BITS = 1 << 15  # of one bitmap of Spark's bitmap functions
BITS_PER_KEY = 24
PROBES = 16  # bits per key; with 24 bits for each key about one key in 100,000 is taken falsely
LISTED_FILES = 100_000  # the index's file ranges are broadcast up to so many, about 10 MB
PROBED = 1 << 24  # pairs of a key and a file that are compared in any case; more, only as many as the files' keys


def _block(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), F.col(key)), blocks).cast("int")


def _bit(key: str, probe: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(probe + 1), F.col(key)), F.lit(BLOCK_BITS))


def _bits(key: str) -> Column:
    return F.array(*[_bit(key, i) for i in range(PROBES)])


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def names_of(files: Sequence[str]) -> dict[str, str]:
    """Address by file name; the names of data files are unique."""
    return {f.rsplit("/", 1)[-1]: f for f in files}


def read_index(spark: SparkSession, path: str) -> DataFrame | None:
    """file, least, greatest, blocks, block and bits of the table at ``path``, or None."""
    return stored(spark, f"{path}/{FOLDER}")


def entries_of(spark: SparkSession, key: T.StructField, files: Sequence[str]) -> DataFrame:
    """The index's entries of some files, reading their key column only.

    Keys are dealt by the block they set, not by file, so a task's share is even however large a file is. What
    is sorted are the keys, not each of their bits: every probe fills a bitmap of its own, and the
    bitmaps of a block become one after that.
    """
    rows = spark.read.schema(T.StructType([key])).parquet(*files).select(F.col(key.name).alias("key"), F.col("_metadata.file_name").alias("file"))
    facts = rows.groupBy("file").agg(
        F.min("key").alias("least"),
        F.max("key").alias("greatest"),
        F.ceil(F.count("key") * BITS_PER_KEY / BLOCK_BITS).cast("int").alias("blocks"),
    )
    # numbers stand for the names, which are far longer than a key
    listed = spark.createDataFrame([(name, i) for i, name in enumerate(names_of(files))], "file STRING, number INT")
    listed = listed.join(facts, "file", "left")
    few = F.broadcast(listed) if len(files) <= LISTED_FILES else listed
    held = rows.where(F.col("key").isNotNull()).join(few.select("file", "number", "blocks"), "file").select("number", "blocks", "key").distinct()
    block, place = _block("key", F.col("blocks")), ["number", "block"]
    placed = held.repartition("number", block).select("number", block.alias("block"), "key")
    probes = placed.groupBy(*place).agg(*[F.bitmap_construct_agg(_bit("key", i)).alias(f"probe_{i}") for i in range(PROBES)])
    bitmaps = (
        probes.select(*place, F.explode(F.array(*[f"probe_{i}" for i in range(PROBES)])).alias("bits"))
        .groupBy(*place)
        .agg(F.bitmap_or_agg("bits").alias("bits"))
    )
    filled = bitmaps.join(few, "number").select("file", "least", "greatest", "blocks", "block", "bits")
    # a file without any key, or any row, has an entry without a filter
    bare = listed.where(F.coalesce("blocks", F.lit(0)) == 0).drop("number")
    return filled.unionByName(bare, allowMissingColumns=True)


def add(spark: SparkSession, path: str, key: T.StructField, files: Sequence[str]) -> None:
    """Index some files of the table at ``path``."""
    if not files:
        return
    entries = entries_of(spark, key, files)
    with brief_shuffles(spark):
        entries.write.parquet(f"{path}/{FOLDER}/load={uuid.uuid4().hex}")


def files_to_open(spark: SparkSession, path: str, table: DataFrame, keys: DataFrame, key: str) -> list[str]:
    """Addresses of the files of ``table`` that may hold one of ``keys`` (column ``key``, no NULL).

    Every key is compared with every file whose range holds it. Where both loads and files cover
    the same wide range, these pairs grow with their product; then reading the files' keys is less, and all of
    these files are named.
    """
    files = names_of(table.inputFiles())
    index = read_index(spark, path)
    if index is None:
        return list(files.values())
    entries = index.groupBy("file").agg(F.first("least").alias("least"), F.first("greatest").alias("greatest"), F.first("blocks").alias("blocks"))
    with brief_shuffles(spark):
        low, high, number = keys.agg(F.min(key), F.max(key), F.count(key)).first()
        if low is None:
            return []
        listed = entries.select("file", "blocks", F.coalesce((F.col("least") <= F.lit(high)) & (F.col("greatest") >= F.lit(low)), F.lit(False)).alias("meets")).collect()
    known = {r["file"] for r in listed}
    unknown = [address for name, address in files.items() if name not in known]
    meeting = [r["file"] for r in listed if r["meets"] and r["file"] in files]
    if not meeting:
        return unknown
    held = sum(r["blocks"] for r in listed if r["meets"]) * BLOCK_BITS / BITS_PER_KEY
    if len(meeting) > LISTED_FILES or number * len(meeting) > max(PROBED, held):
        return unknown + [files[f] for f in meeting]
    ranges = F.broadcast(entries.where((F.col("least") <= F.lit(high)) & (F.col("greatest") >= F.lit(low))))
    probed = (
        keys.join(ranges, F.col(key).between(F.col("least"), F.col("greatest")))
        .select(key, "file", _block(key, F.col("blocks")).alias("block"))
        .join(index.select("file", "block", "bits"), ["file", "block"])
        .where(F.forall(_bits(key), lambda bit: _is_set(F.col("bits"), bit)))
    )
    with brief_shuffles(spark):
        return unknown + [files[r["file"]] for r in probed.select("file").distinct().collect() if r["file"] in files]


def stored_keys(spark: SparkSession, path: str, table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Those of ``keys`` that the table holds, by comparison with the keys in the files that may hold them."""
    opened = files_to_open(spark, path, table, keys, key)
    if not opened:
        return keys.limit(0)
    held = spark.read.schema(T.StructType([table.schema[key]])).parquet(*opened)
    return keys.join(held, key, "left_semi")


def catch_up(spark: SparkSession, path: str, key: str) -> None:
    """Index the files of the table that have no entry yet."""
    table = spark.read.parquet(path)
    files, index = names_of(table.inputFiles()), read_index(spark, path)
    with brief_shuffles(spark):
        known = set() if index is None else {r["file"] for r in index.select("file").distinct().collect()}
    add(spark, path, table.schema[key], [address for name, address in files.items() if name not in known])
