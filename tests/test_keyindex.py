from __future__ import annotations

import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from marketloom.session import discard, scratch_path
from marketloom.sources import keyindex
from marketloom.sources.sinks import append_new, full_refresh


def keys(spark, low, high, hashed=False):
    return spark.range(low, high).select((F.md5(F.col("id").cast("string")) if hashed else F.col("id")).alias("k"), (F.col("id") * 2).alias("v"))


def opened(spark, path, rows):
    table = spark.read.parquet(path)
    return keyindex.files_to_open(spark, path, table, rows.select("k"), "k")


@pytest.mark.parametrize("hashed", [False, True])
def test_new_keys_open_no_old_file(spark, hashed):
    path = scratch_path(spark, "index")
    assert append_new(keys(spark, 0, 4000, hashed), path, "k") == 4000
    files = spark.read.parquet(path).inputFiles()
    assert len(files) > 1
    assert opened(spark, path, keys(spark, 4000, 6000, hashed)) == []
    # one stored key opens the file that holds it
    one = opened(spark, path, keys(spark, 17, 18, hashed))
    assert 1 <= len(one) < len(files) and spark.read.parquet(*one).join(keys(spark, 17, 18, hashed), "k").count() == 1
    assert sorted(opened(spark, path, keys(spark, 0, 4000, hashed))) == sorted(files)
    assert append_new(keys(spark, 3000, 5000, hashed), path, "k") == 1000
    assert append_new(keys(spark, 0, 5000, hashed), path, "k") == 0
    assert spark.read.parquet(path).count() == spark.read.parquet(path).select("k").distinct().count() == 5000


def test_keys_the_filter_takes_falsely_are_compared(spark, monkeypatch):
    """With hardly any bits every key seems to be stored; the keys themselves decide."""
    monkeypatch.setattr(keyindex, "BITS_PER_KEY", 0.5)
    monkeypatch.setattr(keyindex, "BLOCK_BITS", 64)
    path = scratch_path(spark, "index")
    append_new(keys(spark, 0, 3000, True), path, "k")
    assert len(opened(spark, path, keys(spark, 9000, 9500, True))) > 0
    assert append_new(keys(spark, 2500, 3500, True), path, "k") == 500


def test_a_load_of_many_keys_opens_files_rather_than_pair_with_each(spark, monkeypatch):
    """Keys and files over one wide range: their pairs would be the product of both."""
    path = scratch_path(spark, "index")
    append_new(keys(spark, 0, 4000, True), path, "k")
    files, probed = spark.read.parquet(path).inputFiles(), []
    bits = keyindex._bits
    monkeypatch.setattr(keyindex, "PROBED", 100)
    monkeypatch.setattr(keyindex, "_bits", lambda key: probed.append(key) or bits(key))
    assert sorted(opened(spark, path, keys(spark, 4000, 12_000, True))) == sorted(files)
    assert not probed
    assert opened(spark, path, keys(spark, 4000, 4010, True)) == [] and probed
    assert append_new(keys(spark, 2000, 12_000, True), path, "k") == 8000


def test_an_append_leaves_no_shuffle_files(spark):
    def left():
        place = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return place.getAllBlocks().mkString("\n").count("shuffle_")

    spark.sparkContext._jvm.System.gc()
    path = scratch_path(spark, "index")
    none = spark.range(50).select(F.lit(None).cast("bigint").alias("k"), F.col("id").alias("v"))
    before = left()
    for _ in range(2):
        append_new(keys(spark, 0, 500).union(none), path, "k")
    until = time.time() + 10
    while left() > before and time.time() < until:  # they are removed in the background
        time.sleep(0.1)
    assert left() <= before


def test_files_without_an_entry_are_opened_and_indexed(spark):
    path = scratch_path(spark, "index")
    append_new(keys(spark, 0, 100), path, "k")
    keys(spark, 500, 600).write.mode("append").parquet(path)  # not through the sink
    strange = opened(spark, path, keys(spark, 10_000, 10_001))
    assert strange and all(500 <= r["k"] < 600 for r in spark.read.parquet(*strange).collect())
    assert append_new(keys(spark, 550, 650), path, "k") == 50
    assert opened(spark, path, keys(spark, 10_000, 10_001)) == []
    # the index can be lost: it is made anew
    discard(spark, f"{path}/{keyindex.FOLDER}")
    assert append_new(keys(spark, 0, 700), path, "k") == 700 - 250
    assert opened(spark, path, keys(spark, 10_000, 10_001)) == []


def test_a_full_refresh_takes_its_index_along(spark):
    path = scratch_path(spark, "index")
    append_new(keys(spark, 0, 100), path, "k")
    full_refresh(keys(spark, 200, 300), path)
    assert keyindex.read_index(spark, path) is None
    assert append_new(keys(spark, 0, 300), path, "k") == 200


def test_rows_without_keys_and_empty_loads(spark):
    path = scratch_path(spark, "index")
    none = spark.createDataFrame([(None, 1), (None, 1)], "k bigint, v bigint")
    assert append_new(none, path, "k") == 2
    assert append_new(none.limit(0), path, "k") == 0
    assert append_new(none.union(keys(spark, 0, 2)), path, "k") == 2
    assert append_new(none.union(keys(spark, 0, 2)), path, "k") == 0


def test_index_sorts_keys_and_not_their_bits(spark, monkeypatch):
    """A key has many bits: they are set where the keys of a block meet, and blocks are dealt, not whole files."""
    path, written = scratch_path(spark, "index"), []
    keys(spark, 0, 2000).write.parquet(path)
    table = spark.read.parquet(path)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *args, **kwargs: written.append(self._df))
    keyindex.add(spark, path, table.schema["k"], table.inputFiles())
    text = written[0]._jdf.queryExecution().executedPlan().toString()
    above, construct, below = text.partition("bitmap_construct_agg")
    assert construct and "Generate explode" not in below  # no row per bit comes in
    assert "REPARTITION_BY_COL" in below and "SortMergeJoin" not in below


@pytest.mark.parametrize("hashed", [False, True])
def test_index_holds_the_bits_of_every_key(spark, hashed):
    """Several blocks in a file, repeated and missing keys, a file without any key and one without rows."""
    path = scratch_path(spark, "index")
    many = keys(spark, 0, 4000, hashed)
    hot = many.limit(1).crossJoin(spark.range(500)).drop("id")
    none = many.limit(30).withColumn("k", F.lit(None).cast(many.schema["k"].dataType))
    many.unionByName(hot).unionByName(none).coalesce(1).write.parquet(path)
    none.coalesce(1).write.mode("append").parquet(path)
    many.limit(0).coalesce(1).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    files = table.inputFiles()
    keyindex.add(spark, path, table.schema["k"], files)
    index = keyindex.read_index(spark, path).collect()
    assert {r["file"] for r in index} == set(keyindex.names_of(files)) and len(files) == 3
    whole = [r for r in index if r["bits"] is not None]
    assert sorted(r["block"] for r in whole) == list(range(whole[0]["blocks"])) and whole[0]["blocks"] == -(-4500 * 24 // (1 << 15))
    low, high = table.agg(F.min("k"), F.max("k")).first()
    assert {(r["least"], r["greatest"]) for r in whole} == {(low, high)}
    assert all(r["least"] is None and r["block"] is None for r in index if r["bits"] is None) and len(index) == len(whole) + 2
    expected = {}
    for r in many.select(keyindex._block("k", F.lit(whole[0]["blocks"])).alias("block"), keyindex._bits("k").alias("bits")).collect():
        expected.setdefault(r["block"], set()).update(r["bits"])
    for r in whole:
        assert {8 * i + j for i, byte in enumerate(r["bits"]) for j in range(8) if byte >> j & 1} == expected[r["block"]]
