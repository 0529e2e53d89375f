"""Sharding by jump consistent hashing, in DataFrame functions alone.

The hash walks a pseudo-random chain that depends on the key only; the last element below the
number of shards is the shard. With one more shard a key stays or goes to the new shard, so the
shard tables need no ring and no stored state. Law: ``key`` (key and shard count decide).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.base import parts_for, stored

# Fixed values of the published algorithm.
MULTIPLIER = 2862933555777941757
WORD = 1 << 64


@dataclass(frozen=True)
class Settings:
    """``range_rows``: rows numbered in one task; ``run``: copies of a row that are numbered at once."""

    shards: int = 16
    range_rows: int = 20_000
    run: int = 10_000


def jump_shards(key: Column, shards: int) -> Column:
    """Struct of ``shard`` among ``shards`` and ``grown`` among one more, for a bigint key.

    The chain is computed in decimals, since 64-bit products must wrap and not overflow. A null key
    counts as 0.
    """
    start = F.coalesce(key.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    start = F.when(start < 0, start + F.lit(str(WORD)).cast("decimal(20,0)")).otherwise(start).cast("decimal(20,0)")
    state = F.struct(
        start.alias("k"), F.lit(-1).cast("bigint").alias("shard"), F.lit(-1).cast("bigint").alias("grown"), F.lit(0).cast("bigint").alias("j")
    )

    def step(a: Column, _: Column) -> Column:
        k = F.pmod(
            (a["k"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")).cast("decimal(38,0)"),
            F.lit(str(WORD)).cast("decimal(20,0)"),
        ).cast("decimal(20,0)")
        high = F.floor(k / F.lit(1 << 33).cast("decimal(10,0)")).cast("double")
        following = ((a["j"] + 1) * (F.lit(float(1 << 31)) / (high + 1.0))).cast("bigint")
        moved = F.struct(
            k.alias("k"),
            F.when(a["j"] < shards, a["j"]).otherwise(a["shard"]).alias("shard"),
            a["j"].alias("grown"),
            following.alias("j"),
        )
        return F.when(a["j"] <= shards, moved).otherwise(a)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), state, step, lambda a: F.struct(a["shard"].cast("int").alias("shard"), a["grown"].cast("int").alias("grown")))


def assign(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1 and ``slot`` the row's place in its shard, gapless
    from 0. A null text has no bytes and checksum 0, a null id goes where key 0 goes. Rows of equal
    id, size and checksum are one entry with a count until the end, so that a row repeated any
    number of times needs no task of its own. Documents of equal text and different id are apart,
    as the law wants. An empty table gives an empty result.
    """
    s = settings
    content = F.col("text").cast("binary")
    rows = (
        docs.select(
            F.col("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1).alias("size"),
            F.coalesce(F.crc32(content), F.lit(0)).cast("bigint").alias("text_crc32"),
        )
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
        .withColumn("at", jump_shards(F.col("doc_id"), s.shards))
        .select("doc_id", "size", "text_crc32", "copies", F.col("at.shard").alias("shard"), F.col("at.grown").alias("grown_shard"))
    )
    rows = stored(rows, "sharding-rows")
    ranges = parts_for(rows.count(), s.range_rows * s.shards)
    ranged = rows.withColumn("range", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(ranges)))
    earlier = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("shard", "range")
        .agg(F.sum("copies").alias("held"))
        .select("shard", "range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"))
    )
    before = Window.partitionBy("shard", "range").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ranged.withColumn("first", F.coalesce(F.sum("copies").over(before), F.lit(0)))
        .join(starts, ["shard", "range"])
        .withColumn("first", F.col("first") + F.col("start"))
    )
    runs = placed.withColumn("run", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(s.run))))
    single = runs.withColumn("copy", F.explode(F.sequence("run", F.least(F.col("run") + s.run, F.col("copies")) - 1)))
    return single.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("first") + F.col("copy")).alias("slot"),
        "grown_shard",
    )
