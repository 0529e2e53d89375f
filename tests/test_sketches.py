from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators.sketches import SIZE, merged_sketch, quantile_sketch, sketch_count, sketch_quantile
from marketloom.plans.delivery_times import monthly_sketches, quantiles_over
from marketloom.session import scratch_path
from marketloom.streaming import incremental

SHARES = (0.0, 0.01, 0.1, 0.5, 0.9, 0.999, 1.0)


def ranks_of(value, values):
    return np.searchsorted(values, value, "left"), np.searchsorted(values, value, "right")


@pytest.mark.parametrize("rows", [1, 2, 10, 999, SIZE])
def test_exact_up_to_its_size(spark, rows):
    values = np.sort(np.random.default_rng(rows).integers(-(10**12), 10**12, rows))
    frame = spark.createDataFrame([(int(v),) for v in values], "v long").repartition(5)
    found = frame.agg(quantile_sketch("v").alias("s")).select(*[sketch_quantile("s", p) for p in SHARES]).first()
    assert list(found) == [values[max(0, int(np.ceil(p * rows)) - 1)] for p in SHARES]


def test_rank_error_of_merged_parts(spark):
    """Forty parts, one with a third of all rows, stored and merged: ranks within 0.07 %, size far below the rows'."""
    spread = spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("part"), (F.xxhash64("id") % 100_000_007).alias("v")
    )
    path = scratch_path(spark, "sketches")
    spread.groupBy("part").agg(quantile_sketch("v").alias("s")).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.agg(F.max(F.length("s"))).first()[0] < 100_000
    merged = stored.agg(merged_sketch("s").alias("s"))
    found = merged.select(sketch_count("s"), *[sketch_quantile("s", p) for p in SHARES]).first()
    values = np.sort(spread.select("v").toPandas()["v"].to_numpy())
    assert found[0] == len(values) == 600_000
    for share, value in zip(SHARES, found[1:]):
        low, high = ranks_of(value, values)
        assert low < high  # a value that occurs
        assert low - 0.0015 * len(values) <= share * len(values) <= high + 0.0015 * len(values)


def test_size_does_not_follow_the_rows(spark):
    sizes = [spark.range(n).agg(F.length(quantile_sketch("id"))).first()[0] for n in (100_000, 3_000_000)]
    assert max(sizes) < 100_000


def test_missing_values_and_empty_groups(spark):
    frame = spark.createDataFrame([("a", 3), ("a", None), ("a", 1), ("b", None)], "k string, v long")
    sketched = frame.groupBy("k").agg(quantile_sketch("v").alias("s"))
    found = sketched.select("k", sketch_count("s"), sketch_quantile("s", 0.5)).collect()
    assert {tuple(r) for r in found} == {("a", 2, 1), ("b", 0, None)}
    assert sketched.agg(merged_sketch("s").alias("s")).select(sketch_quantile("s", 1)).first()[0] == 3
    nothing = frame.limit(0).agg(quantile_sketch("v").alias("s")).select(sketch_count("s"), sketch_quantile("s", 0.5)).first()
    assert nothing[1] is None


def delivered(spark, first, last):
    rows = []
    for m in range(first, last):
        rows += [(100 * m + i, i % 4, "delivered", dt.date(2018 + m // 12, m % 12 + 1, 1 + i), (7 * i + m) % 30) for i in range(20)]
        rows += [(100 * m + 50, 1, "canceled", dt.date(2018 + m // 12, m % 12 + 1, 3), 500), (100 * m + 51, 1, "delivered", None, 4)]
        rows += [(100 * m + 52, 99, "delivered", dt.date(2018 + m // 12, m % 12 + 1, 3), 400), (100 * m + 53, 1, "delivered", dt.date(2018 + m // 12, m % 12 + 1, 3), None)]
    return spark.createDataFrame(rows, "order_id long, customer_id long, order_status string, purchase_date date, delivery_days int")


def test_refreshed_sketches_equal_those_of_all_orders(spark):
    customers = spark.createDataFrame([(i, f"S{i % 2}") for i in range(4)], "customer_id long, customer_state string")
    path = scratch_path(spark, "delivery")

    def run(orders):
        def build(recent, cut):
            return monthly_sketches(recent, cut(customers, "customer_id"))

        return incremental.refresh(build, orders, path, "purchase_date", ["customer_state", "order_month"])

    run(delivered(spark, 0, 5).where("order_id % 7 <> 0 OR purchase_date < '2018-04-01'"))
    stored = run(delivered(spark, 0, 9))
    want = delivered(spark, 0, 9).where("order_status = 'delivered' AND purchase_date IS NOT NULL").join(customers, "customer_id").toPandas()
    for keys, group in ((["customer_state"], "customer_state"), ([F.year("order_month").alias("y")], None)):
        found = {r[0]: tuple(r)[1:] for r in quantiles_over(stored, keys).collect()}
        names = want[group] if group else want["purchase_date"].map(lambda d: d.year)
        exact = {}
        for name, part in want.groupby(names):
            days = np.sort(part["delivery_days"].dropna().to_numpy())
            exact[name] = (len(days), *[days[int(np.ceil(p * len(days))) - 1] for p in (0.1, 0.5, 0.9)])
        assert found == exact
