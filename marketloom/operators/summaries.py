"""Per-group summaries built from mergeable aggregates, so a hot group never meets one task whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.operators.ranking import running_totals
from marketloom.session import brief_shuffles, settle


def top_values(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], count_nulls: bool = False
) -> DataFrame:
    """Most frequent value of each (text) column per key, the smallest value on ties.

    Counts per (key, column, value) come first, so the second step sees distinct values
    only. With ``count_nulls`` a missing value competes like any other.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])
    counted = (
        df.select(*keys, F.explode(pairs).alias("_pair"))
        .select(*keys, F.col("_pair.name").alias("_name"), F.col("_pair.value").alias("_value"))
        .groupBy(*keys, "_name", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    if not count_nulls:
        counted = counted.where(F.col("_value").isNotNull())
    best = F.struct((-F.col("_n")).alias("n"), F.col("_value").alias("value"))
    return (
        counted.groupBy(*keys)
        .agg(*[F.min(F.when(F.col("_name") == c, best)).alias(f"_best_{c}") for c in columns])
        .select(*keys, *[F.col(f"_best_{c}")["value"].alias(c) for c in columns])
    )


def frequent_values(df: DataFrame, column: str, share: float = 0.001, least: int = 10_000) -> list:
    """Values of ``column`` in more than ``share`` of the rows and more than ``least`` rows; a missing value is None.

    At most ``1 / share`` values, found in one pass by a sketch of bounded size whose error is a quarter of ``share``. For
    plans that keep such values out of a task of their own; a result must not depend on which values are named.
    """
    most = round(1 / share)
    top = F.expr(f"approx_top_k(`{column}`, {most}, {10 * most})").alias("top")
    with brief_shuffles(df.sparkSession):
        found = df.agg(F.count(F.lit(1)).alias("n"), top).first()
    return [t["item"] for t in found["top"] if t["count"] > max(least, share * found["n"])]


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """First row per key in the given (ascending) order, as a MIN over a struct.

    Unlike a row-number window this merges on the map side. Negate numbers for a
    descending order.
    """
    ordered = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    picked = F.min(F.struct(*ordered, *columns)).alias("_first")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col("_first")[c].alias(c) for c in columns])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    probabilities: Mapping[str, float],
) -> DataFrame:
    """Exact quantiles with linear interpolation, per ``keys`` group or for the whole frame.

    Values are counted first, then the counts are summed along the value order over
    ordered slices. The built-in exact percentile would hold all distinct values of a
    group in one buffer.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_weight"))
    walked = running_totals(counted, [F.col(column).asc()], keys=keys, sums=["_weight"])
    last_index = F.col("running__weight") - 1
    first_index = F.col("running__weight") - F.col("_weight")

    picks, results = [], []
    for name, p in probabilities.items():
        position = F.lit(float(p)) * (F.col("total__weight") - 1)
        for side, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (first_index <= index) & (index <= last_index)
            picks.append(F.max(F.when(here, F.col(column).cast("double"))).alias(f"_{name}_{side}"))
        picks.append(F.max(position - F.floor(position)).alias(f"_{name}_part"))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        results.append((low + (high - low) * F.col(f"_{name}_part")).alias(name))
    return walked.groupBy(*keys).agg(*picks).select(*keys, *results)


def approx_quantile(c: Column | str, p: float, accuracy: int = 100_000) -> Column:
    """Mergeable quantile sketch; returns a value that occurs in the data."""
    return F.percentile_approx(c, p, accuracy)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width histogram between the smallest and largest value, last bin closed.

    Every bin is listed, also an empty one. The input is read once, for counts per value; those are
    stored, and the value range is one row of them.
    """
    value = F.col("value")
    counts = settle(df.groupBy(F.col(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n")))
    low, high = counts.agg(F.min(value), F.max(value)).first()
    low, high = (0.0, 0.0) if low is None else (low, high)
    width = (high - low) / bins
    place = F.floor((value - F.lit(low)) / F.lit(width)) if width else F.lit(0)
    counted = (
        counts.where(value.isNotNull())
        .groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.sum("n").alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counted), "bin", "left").select(  # at most ``bins`` rows
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
        (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str], name: str = "duplicates") -> DataFrame:
    """Rows beyond the first of each key, NULL keys equal to each other; one row."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(name))
    )
