from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.session import scratch_path
from marketloom.streaming import history, incremental


def partitions_read(df) -> int:
    """Partitions that the scans of an executed plan have read."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    total, waiting = 0, [execution.executedPlan()]
    while waiting:
        node = waiting.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            waiting.append(node.executedPlan())
        elif "QueryStage" in name:
            waiting.append(node.plan())
        elif name.startswith("Scan parquet"):
            total += node.metrics().apply("numPartitions").value()
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return total


def orders(spark, months, per_month=4):
    rows = [(100 * m + i, dt.date(2018 + m // 12, m % 12 + 1, 5)) for m in range(months) for i in range(per_month)]
    return spark.createDataFrame(rows, "order_id int, day date")


def items(spark, known):
    return known.select("order_id", F.lit(1).alias("n")).union(known.select("order_id", F.lit(2)))


@pytest.mark.parametrize("months", [3, 9, 20])
def test_partitions_read_do_not_grow_with_the_history(spark, months):
    path, landed = scratch_path(spark, "mart"), scratch_path(spark, "landed")
    known = orders(spark, months)
    history.land_by_month(items(spark, known), known, landed, "order_id", "day")
    assert spark.read.parquet(landed).count() == 8 * months
    read = []

    def build(recent, cut):
        details = cut(spark.read.parquet(landed), "order_id")
        read.append(partitions_read(details.select("n")))
        return recent.join(details, "order_id").groupBy(F.trunc("day", "MM").alias("order_month")).agg(F.sum("n").alias("n"))

    incremental.refresh(build, known, path, "day", ["order_month"])
    got = incremental.refresh(build, known, path, "day", ["order_month"])
    assert read == [months, 2]  # everything, then the months of the lookback
    assert {r["n"] for r in got.collect()} == {12} and got.count() == months


def test_late_and_unknown_details(spark):
    landed = scratch_path(spark, "landed")
    known = orders(spark, 2)
    history.land_by_month(items(spark, known.where("order_id < 100")), known, landed, "order_id", "day")
    late = spark.createDataFrame([(1, 9), (999, 9), (None, 9), (101, 9)], "order_id int, n int")
    repeated = known.union(known)  # repeated orders do not repeat their details
    history.land_by_month(late, repeated, landed, "order_id", "day")
    rows = sorted((str(r["order_month"]), str(r["order_id"])) for r in spark.read.parquet(landed).where("n = 9").collect())
    assert rows == [("2018-01-01", "1"), ("2018-02-01", "101"), ("None", "999"), ("None", "None")]
    assert history.since(spark, landed, dt.date(2018, 2, 17)).count() == 1
    assert history.since(spark, landed, None).count() == 12
