"""Sinks: full refresh, idempotent append, partitioned and clustered tables, JSON and CSV exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketloom.session import brief_shuffles, settle, unsettle


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range layout for Parquet min/max skipping; a hot value spreads over several files."""
    if not columns:
        return df
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def slices_of(df: DataFrame, column: str, slices: int) -> list[DataFrame]:
    """The rows in up to ``slices`` frames, each of some consecutive values of ``column``; missing ones are in the first."""
    with brief_shuffles(df.sparkSession):
        values = [row[0] for row in df.select(column).distinct().collect()]  # as many as the table has partitions
    known = sorted(v for v in values if v is not None)
    if slices < 2 or len(known) < 2:
        return [df]
    size = -(-len(known) // slices)
    inside = [F.col(column).between(F.lit(part[0]), F.lit(part[-1])) for part in (known[i : i + size] for i in range(0, len(known), size))]
    return [df.where(inside[0] | F.col(column).isNull()), *(df.where(rows) for rows in inside[1:])]


def full_refresh(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), slices: int = 1
) -> None:
    """Replace the table: static overwrite, so partitions that vanished are removed too.

    With ``slices`` the partitions are made and written in so many groups, one after the other. A filter on the
    partition column reaches the scan of the rows it comes from, so only the rows of one group are shuffled at a time.
    """
    mode = "overwrite"
    for part in slices_of(df, partition_by[0], slices) if partition_by and slices > 1 else [df]:
        writer = clustered(part, [*partition_by, *cluster_by]).write.mode(mode)
        with brief_shuffles(df.sparkSession):
            writer.option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)
        mode = "append"


def monthly_partitioned(
    df: DataFrame, path: str, date_column: str, cluster_by: Sequence[str] = (), name: str | None = None
) -> str:
    """Full refresh partitioned by the month of ``date_column``; returns the partition column.

    A range layout reads its rows twice, first for its borders. They are stored before, so that what ``df`` joins and
    groups runs once.
    """
    month = name or f"{date_column}_month"
    staged = settle(df.withColumn(month, F.trunc(date_column, "MM")))
    full_refresh(staged, path, [month], cluster_by)
    unsettle(staged)
    return month


COPIES = 10_000  # copies of a repeated row that one step of an append writes


def _not_stored(df: DataFrame, existing: DataFrame, audit: Sequence[str]) -> DataFrame:
    """Rows of ``df`` less those of ``existing``, as multisets; ``audit`` columns are not compared."""
    data = [c for c in df.columns if c not in audit]
    counted = df.groupBy(*data).agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in audit])
    known = existing.groupBy(*data).agg((-F.count(F.lit(1))).alias("_n"))
    left_over = (
        counted.unionByName(known, allowMissingColumns=True)
        .groupBy(*data)
        .agg(F.sum("_n").alias("_n"), *[F.max(c).alias(c) for c in audit])
        .where(F.col("_n") > 0)
    )
    # Copies in steps, so that a row with very many of them is never one long array.
    steps = F.explode(F.sequence(F.lit(1), F.col("_n"), F.lit(COPIES)))
    copies = F.explode(F.sequence(F.col("_step"), F.least(F.col("_step") + COPIES - 1, F.col("_n"))))
    stepped = left_over.withColumn("_step", steps)
    return stepped.select(*df.columns, copies.alias("_copy")).drop("_copy")


def append_new(
    df: DataFrame, path: str, key: str | None = None, audit: Sequence[str] = (), within: str | None = None
) -> int:
    """Append rows not stored yet and return their number; a repeated load adds nothing.

    With a ``key``, rows whose key is stored are left out. An index of the table's files tells which of
    them may hold a key of the load (see ``keyindex``); only these are opened, their key column only. Equal keys inside one load are all stored. Rows without a key, and all rows
    of a table without one, are subtracted as a multiset, so equal rows are kept as often as they occur;
    ``audit`` columns (load time, file) take no part in that comparison. Equal rows have equal
    values of ``within``, the table's incremental column, so only the stored rows between the
    least and the greatest value of the load are read for it.
    """
    from marketloom.sources import keyindex

    spark = df.sparkSession
    existing = stored(spark, path)
    new = df
    if existing is not None:
        bounded = existing
        if within:
            with brief_shuffles(spark):
                low, high = df.agg(F.min(within), F.max(within)).first()
            column = F.col(within)
            inside = column.isNull() if low is None else column.isNull() | column.between(F.lit(low), F.lit(high))
            bounded = existing.where(inside)
        if key:
            keyed, bare = F.col(key).isNotNull(), F.col(key).isNull()
            known = keyindex.stored_keys(spark, path, existing, df.where(keyed).select(key).distinct(), key)
            fresh = df.where(keyed).join(known, key, "left_anti").select(*df.columns)
            new = fresh.unionByName(_not_stored(df.where(bare), bounded.where(bare), audit))
        else:
            new = _not_stored(df, bounded, audit)
    written = Observation()
    with brief_shuffles(spark):
        new.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    if key:
        keyindex.catch_up(spark, path, key)
    return written.get["rows"]


def materialize(
    df: DataFrame,
    name: str,
    path: str | None = None,
    kind: str = "table",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    unique_key: Sequence[str] = (),
    slices: int = 1,
) -> DataFrame:
    """Materialise a model as ``view``, ``table`` (full refresh) or ``incremental`` (keyed merge)."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if path is None:
        raise ValueError("a stored model needs a path")
    if kind == "table":
        full_refresh(df, path, partition_by, cluster_by, slices)
    elif kind == "incremental":
        from marketloom.streaming.incremental import upsert

        upsert(df, path, unique_key, partition_by[0], cluster_by)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    result = spark.read.parquet(path)
    result.createOrReplaceTempView(name)
    return result


def export_json(df: DataFrame, path: str) -> None:
    """Newline-delimited JSON, NULL fields kept so that every line has all names."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
