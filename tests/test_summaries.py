from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketloom.operators.summaries import (
    duplicate_rows,
    exact_quantiles,
    first_per_key,
    histogram,
    top_values,
)


def test_top_value_ties_and_missing_values(spark):
    rows = [(1, "b"), (1, "a"), (2, "x"), (2, None), (2, None), (3, None)]
    df = spark.createDataFrame(rows, "k int, v string")
    plain = dict(top_values(df, ["k"], ["v"]).collect())
    assert plain == {1: "a", 2: "x"}  # a key without any value is left out
    counted = dict(top_values(df, ["k"], ["v"], count_nulls=True).collect())
    assert counted == {1: "a", 2: None, 3: None}


def test_top_values_of_two_columns(spark):
    df = spark.createDataFrame([(1, "a", "p"), (1, "b", "p"), (1, "b", "q")], "k int, v string, w string")
    assert top_values(df, ["k"], ["v", "w"]).collect() == [(1, "b", "p")]


def test_first_per_key_with_a_hot_key(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": np.where(rng.random(3000) < 0.5, 0, rng.integers(1, 40, 3000)),
                        "t": rng.integers(0, 30, 3000), "id": range(3000), "s": rng.integers(0, 5, 3000)})
    got = first_per_key(spark.createDataFrame(pdf), ["k"], [F.col("t"), F.col("id")], ["s"]).toPandas()
    want = pdf.sort_values(["t", "id"]).drop_duplicates("k")
    assert dict(zip(got["k"], got["s"])) == dict(zip(want["k"], want["s"]))


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_exact_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    n = 3000
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.5, 0, rng.integers(1, 60, n)),
                        "v": np.round(rng.normal(0, 10, n), rng.integers(0, 3))})
    pdf.loc[rng.random(n) < 0.05, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    probs = {"p01": 0.01, "med": 0.5, "p99": 0.99}
    got = exact_quantiles(df, ["k"], "v", probs).toPandas().set_index("k")
    for k, part in pdf.dropna().groupby("k"):
        for name, p in probs.items():
            assert got.loc[k, name] == pytest.approx(np.quantile(part["v"], p), abs=1e-9)
    whole = exact_quantiles(df, [], "v", probs).first()
    for name, p in probs.items():
        assert whole[name] == pytest.approx(np.quantile(pdf["v"].dropna(), p), abs=1e-9)


def test_exact_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "k int, v double")
    assert exact_quantiles(empty, ["k"], "v", {"m": 0.5}).count() == 0
    assert exact_quantiles(empty, [], "v", {"m": 0.5}).first()["m"] is None


@pytest.mark.parametrize("values", [[5], [0, 60], list(range(61)), [1, 1, 2, 3, 3, 3, 9, 60, 60]])
def test_histogram_matches_numpy(spark, values):
    got = histogram(spark.createDataFrame([(v,) for v in values], "v int"), "v", 40).orderBy("bin").toPandas()
    if len(set(values)) == 1:
        assert got["n"].sum() == len(values)
        return
    counts, edges = np.histogram(values, bins=40)
    assert got["n"].tolist() == counts.tolist()
    assert np.allclose(got["bin_start"], edges[:-1]) and np.allclose(got["bin_end"], edges[1:])


def test_duplicates_count_missing_keys_as_equal(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert duplicate_rows(df, ["k"]).first()[0] == 3
    assert duplicate_rows(df.limit(0), ["k"]).first()[0] == 0
