from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketloom.operators.ranking import (
    Score,
    assign_buckets,
    global_ntile,
    ntile_bucket,
    ntile_ends,
    qcut_bucket,
    qcut_ends,
    running_totals,
)


def ntile_by_hand(n: int, k: int) -> list[int]:
    """Deal n rows into k buckets, the first n % k buckets one row larger."""
    out = []
    for bucket in range(1, k + 1):
        out += [bucket] * (n // k + (1 if bucket <= n % k else 0))
    return out


@pytest.mark.parametrize("k", [1, 3, 4, 10])
def test_bucket_formulas_for_every_size(spark, k):
    sizes = list(range(1, 60)) + [999, 1500]
    rows = [(n, i) for n in sizes for i in range(1, n + 1)]
    df = spark.createDataFrame(rows, "n bigint, i bigint")
    got = df.select(
        "n", "i", ntile_bucket(F.col("i"), F.col("n"), k).alias("b"), qcut_bucket(F.col("i"), F.col("n"), 4).alias("q")
    ).toPandas()
    for n, part in got.sort_values(["n", "i"]).groupby("n"):
        assert part["b"].tolist() == ntile_by_hand(n, k)
        if n >= 4:
            want = pd.qcut(pd.Series(range(1, n + 1)), 4, labels=[1, 2, 3, 4]).astype(int).tolist()
            assert part["q"].tolist() == want


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 11, 100, 1501])
def test_bucket_ends_agree_with_formulas(n):
    ends = ntile_ends(n, 4)
    assert [1 + sum(e < i for e in ends) for i in range(1, n + 1)] == ntile_by_hand(n, 4)
    if n >= 4:
        want = pd.qcut(pd.Series(range(1, n + 1)), 4, labels=[1, 2, 3, 4]).astype(int).tolist()
        assert [1 + sum(e < i for e in qcut_ends(n, 4)) for i in range(1, n + 1)] == want


def test_six_rows_tell_the_two_methods_apart():
    assert ntile_by_hand(6, 4) == [1, 1, 2, 2, 3, 4]
    assert [1 + sum(e < i for e in qcut_ends(6, 4)) for i in range(1, 7)] == [1, 1, 2, 3, 4, 4]


def hot_frame(n: int, seed: int = 7) -> pd.DataFrame:
    """Two thirds of the rows share one group and one value."""
    rng = np.random.default_rng(seed)
    hot = rng.random(n) < 0.66
    return pd.DataFrame(
        {
            "id": rng.permutation(n),
            "grp": np.where(hot, "hot", rng.choice(list("abcde"), n)),
            "v": np.where(hot, 1, rng.integers(0, 50, n)),
            "w": rng.integers(1, 9, n),
        }
    )


def test_global_row_numbers_and_running_sums(spark):
    pdf = hot_frame(5000)
    df = spark.createDataFrame(pdf).repartition(7)
    got = running_totals(df, [F.col("v").desc(), F.col("id").asc()], sums=["w"]).toPandas().sort_values("row_no")
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert got["id"].tolist() == want["id"].tolist()
    assert got["row_no"].tolist() == list(range(1, 5001))
    assert got["running_w"].tolist() == want["w"].cumsum().tolist()
    assert set(got["group_rows"]) == {5000} and set(got["total_w"]) == {pdf["w"].sum()}


def test_grouped_running_sums_with_a_hot_and_a_missing_group(spark):
    pdf = hot_frame(4000)
    pdf.loc[pdf["grp"] == "e", "grp"] = None
    df = spark.createDataFrame(pdf, "id bigint, grp string, v bigint, w bigint")
    got = running_totals(df, [F.col("v").asc(), F.col("id").asc()], keys=["grp"], sums=["w"]).toPandas()
    assert len(got) == len(pdf)
    for name, part in got.groupby("grp", dropna=False):
        mine = pdf[pdf["grp"].isna()] if pd.isna(name) else pdf[pdf["grp"] == name]
        want = mine.sort_values(["v", "id"])
        part = part.sort_values("row_no")
        assert part["id"].tolist() == want["id"].tolist()
        assert part["running_w"].tolist() == want["w"].cumsum().tolist()
        assert set(part["group_rows"]) == {len(mine)} and set(part["total_w"]) == {mine["w"].sum()}


@pytest.mark.parametrize("n", [1, 3, 10, 997])
def test_global_ntile_matches_window(spark, n):
    df = spark.createDataFrame(hot_frame(n))
    got = global_ntile(df, [F.col("v").asc(), F.col("id").asc()], 4, "b").toPandas()
    want = df.selectExpr("id", "ntile(4) OVER (ORDER BY v, id) AS b").toPandas()
    assert dict(zip(got["id"], got["b"])) == dict(zip(want["id"], want["b"]))


@pytest.mark.parametrize("n", [2, 5, 1234])
def test_several_scores_at_once(spark, n):
    df = spark.createDataFrame(hot_frame(n))
    got = assign_buckets(df, "id", {"up": Score("v", 4), "down": Score("w", 10, descending=True)}).toPandas()
    want = df.selectExpr(
        "id", "ntile(4) OVER (ORDER BY v, id) AS up", "ntile(10) OVER (ORDER BY w DESC, id) AS down"
    ).toPandas()
    merged = got.merge(want, on="id", suffixes=("", "_want"))
    assert (merged["up"] == merged["up_want"]).all() and (merged["down"] == merged["down_want"]).all()


def test_no_rows(spark):
    empty = spark.createDataFrame([], "id bigint, v bigint, w bigint")
    assert assign_buckets(empty, "id", {"b": Score("v", 4)}).count() == 0
    assert running_totals(empty, [F.col("v").asc(), F.col("id").asc()], sums=["w"]).count() == 0


def test_hot_value_spreads_over_slices(spark):
    from marketloom.operators.ranking import slice_in_order

    df = spark.range(40_000).select(F.col("id"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [n for _, n in slice_in_order(df, [F.col("v").asc(), F.col("id").asc()]).groupBy("_slice").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 40_000 / 4


@pytest.mark.parametrize("missing", [1, 3, 40])
def test_missing_scores_rank_as_a_sort_places_them(spark, missing):
    rows = [(i, None if i % 41 < missing else i * 7 % 11) for i in range(123)]
    df = spark.createDataFrame(rows, "id int, v int")
    got = assign_buckets(df, "id", {"up": Score("v", 4), "down": Score("v", 4, descending=True)}).toPandas()
    want = df.selectExpr("id", "ntile(4) OVER (ORDER BY v, id) AS up", "ntile(4) OVER (ORDER BY v DESC, id) AS down").toPandas()
    merged = got.merge(want, on="id", suffixes=("", "_want"))
    assert (merged["up"] == merged["up_want"]).all() and (merged["down"] == merged["down_want"]).all()


def test_scores_read_two_columns_each(spark):
    df = spark.range(200).selectExpr("id", "id % 17 AS v", "repeat('x', 50) AS wide", "id * 2 AS other")
    seen = []
    from marketloom.operators import ranking

    slices = ranking.slice_in_order
    try:
        ranking.slice_in_order = lambda part, order: seen.append(part._jdf.queryExecution().executedPlan().toString()) or slices(part, order)
        assign_buckets(df, "id", {"b": Score("v", 4)})
    finally:
        ranking.slice_in_order = slices
    assert len(seen) == 1 and "ReadSchema: struct<id:bigint,v:bigint>" in seen[0]
