"""Global order without one-task windows.

A window without PARTITION BY moves all rows into one task, and a window over a hot
key moves that key into one task. Here rows are range-partitioned into ordered slices,
each slice is numbered on its own, and the row counts (and sums) of the slices before
it are added. Slices are cut by row order, not by key, so a hot key spreads over many.

The sliced frame is stored: slice borders come from sampling, and every branch
must see the same borders, also when tasks are run again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import settle

_SLICE, _POS = "_slice", "_pos"
_POS_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def slice_in_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Ordered slices: adds ``_slice`` (ascending with the order) and ``_pos`` within it.

    ``order`` must end in a unique key, so that the order is total and slices are even.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    row_id = F.monotonically_increasing_id()
    numbered = ordered.withColumn("_row_id", row_id)
    return settle(
        numbered.select(
            *df.columns,
            F.shiftright("_row_id", _POS_BITS).alias(_SLICE),
            F.col("_row_id").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias(_POS),
        )
    )


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    keys: Sequence[str] = (),
    sums: Sequence[str] = (),
) -> DataFrame:
    """Row number, group size, running and total sums per ``keys`` group (or globally).

    Adds ``row_no``, ``group_rows`` and, for each measure m, ``running_m`` and ``total_m``.
    """
    group = [F.struct(*keys).alias("_group")] if keys else []
    group_names = ["_group"] if keys else []
    sliced = slice_in_order(df, [*[F.col(k).asc() for k in keys], *order])
    sliced = sliced.select("*", *group)
    part = [*group_names, _SLICE]

    # One row per (group, slice); each group has at most as many rows as there are slices.
    slices = sliced.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(m).alias(f"_s_{m}") for m in sums]
    )
    group_window = Window.partitionBy(*group_names)
    before = group_window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        *part,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.sum("_n").over(group_window).alias("group_rows"),
        *[F.sum(f"_s_{m}").over(before).alias(f"_before_{m}") for m in sums],
        *[F.sum(f"_s_{m}").over(group_window).alias(f"total_{m}") for m in sums],
    )
    if not keys:
        offsets = F.broadcast(offsets)  # one row per slice: at most spark.sql.shuffle.partitions rows

    inside = Window.partitionBy(*part).orderBy(_POS)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local_no = F.row_number().over(inside) if keys else F.col(_POS) + 1
    local = sliced.select(
        *sliced.columns,
        local_no.alias("_local_no"),
        *[F.sum(m).over(upto).alias(f"_local_{m}") for m in sums],
    )
    return local.join(offsets, part).select(
        *df.columns,
        (F.col("_n_before") + F.col("_local_no")).cast("bigint").alias("row_no"),
        "group_rows",
        *[
            (F.col(f"_local_{m}") + F.coalesce(F.col(f"_before_{m}"), F.lit(0))).alias(f"running_{m}")
            for m in sums
        ],
        *[f"total_{m}" for m in sums],
    )


def ntile_bucket(row_no: Column, rows: Column, buckets: int) -> Column:
    """NTILE from a row number: the first ``rows % buckets`` buckets hold one row more."""
    small = F.floor(rows / buckets)
    larger = rows % buckets
    in_larger = larger * (small + 1)
    return (
        F.when(row_no <= in_larger, F.ceil(row_no / (small + 1)))
        .otherwise(larger + F.ceil((row_no - in_larger) / F.greatest(small, F.lit(1))))
        .cast("int")
    )


def qcut_bucket(row_no: Column, rows: Column, buckets: int) -> Column:
    """Equal-width cut of the ranks 1..n into right-closed buckets, lowest rank included."""
    return F.greatest(
        F.lit(1), F.ceil((row_no - 1) * buckets / F.greatest(rows - 1, F.lit(1)))
    ).cast("int")


def ntile_ends(rows: int, buckets: int) -> list[int]:
    """Row number of the last row of each bucket but the last."""
    small, larger = divmod(rows, buckets)
    return [b * small + min(b, larger) for b in range(1, buckets)]


def qcut_ends(rows: int, buckets: int) -> list[int]:
    return [b * (rows - 1) // buckets + 1 for b in range(1, buckets)]


@dataclass(frozen=True)
class Score:
    """One bucket score: bucket 1 holds the first rows in the order of ``column``."""

    column: str
    buckets: int
    descending: bool = False
    ends: Callable[[int, int], list[int]] = ntile_ends


def _is_after(score: Score, key: str, border) -> Column:
    """Whether a row comes after the border row; missing scores come last when descending, else first."""
    value, bound = F.col(score.column), border[score.column]
    if bound is None:
        beyond, level = F.lit(False) if score.descending else value.isNotNull(), value.isNull()
    else:
        last = F.lit(bound)
        beyond = (value < last) | value.isNull() if score.descending else value > last
        level = value == last
    return F.coalesce(beyond, F.lit(False)) | (F.coalesce(level, F.lit(False)) & (F.col(key) > F.lit(border[key])))


def _bucket_borders(df: DataFrame, key: str, score: Score) -> list:
    """The last row of every bucket but the last: at most ``buckets - 1`` rows."""
    value = F.col(score.column)
    sliced = slice_in_order(
        df.select(score.column, key), [value.desc() if score.descending else value.asc(), F.col(key).asc()]
    )
    # One count per slice reaches the driver, at most spark.sql.shuffle.partitions numbers.
    counts = sorted(sliced.groupBy(_SLICE).count().collect())
    places, seen = [], 0
    ends = [e for e in score.ends(sum(n for _, n in counts), score.buckets) if e > 0]
    for slice_id, n in counts:
        places += [(slice_id, e - seen - 1) for e in ends if seen < e <= seen + n]
        seen += n
    if not places:
        return []
    at_border = F.lit(False)
    for slice_id, pos in set(places):
        at_border = at_border | ((F.col(_SLICE) == slice_id) & (F.col(_POS) == pos))
    rows = {(r[_SLICE], r[_POS]): r for r in sliced.where(at_border).collect()}
    return [rows[place] for place in places]


def assign_buckets(df: DataFrame, key: str, scores: Mapping[str, Score]) -> DataFrame:
    """Several global NTILE-like scores on one frame, ties broken by the unique ``key``.

    Only (score column, key) pairs are ordered, one skinny shuffle per score. The wide
    frame is then scored by comparing each row with the few border rows, so it is neither
    shuffled nor joined. A missing score ranks as a descending or ascending sort places it: last
    or first. The key must not be NULL.
    """
    stable = settle(df)
    bucket_columns = []
    for name, score in scores.items():
        bucket = F.lit(1)
        for border in _bucket_borders(stable, key, score):
            bucket = bucket + F.when(_is_after(score, key, border), 1).otherwise(0)
        bucket_columns.append(bucket.cast("int").alias(name))
    return stable.select("*", *bucket_columns)


def global_ntile(df: DataFrame, order: Sequence[Column], buckets: int, name: str) -> DataFrame:
    """NTILE over the whole frame; ``order`` must end in a unique key."""
    ranked = running_totals(df, order)
    return ranked.select(
        *df.columns, ntile_bucket(F.col("row_no"), F.col("group_rows"), buckets).alias(name)
    )
