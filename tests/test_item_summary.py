"""Items of an order in one shuffle, frequent orders apart; rows stored before a range layout reads them twice."""

from __future__ import annotations

from functools import partial

import pytest
from pyspark.sql import functions as F

from marketloom.operators import summaries
from marketloom.plans import star
from marketloom.session import scratch_path
from marketloom.sources import sinks

ROWS = [
    *[(1, s, p, price, "0.50") for s, p, price in [(7, 1, "1.10"), (7, 2, "2.20"), (8, 2, None), (None, 3, "4.00"), (9, None, "n/a")]],
    *[(2, 5, 5, "3.00", None)] * 3,  # equal rows count as often as they occur, their values once
    (3, None, None, None, None),
    *[(4, i % 40, i % 30, "1.25", "0.25") for i in range(600)],
    *[(None, i, 1, "1.00", "1.00") for i in range(300)],
]


def items(spark):
    return spark.createDataFrame(ROWS, "order_id bigint, seller_id bigint, product_id bigint, price string, freight_value string").repartition(5)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_are_dealt_once_for_sums_and_distinct_counts(spark, monkeypatch):
    stored, settle = [], star.settle
    monkeypatch.setattr(star, "settle", lambda df: stored.append(plan(df)) or settle(df))
    star.order_item_summary(items(spark))
    text = "".join(stored)
    assert text.count("Exchange hashpartitioning(order_id") == text.count("Exchange hashpartitioning") == 1
    assert "Expand" not in text


@pytest.mark.parametrize("crowded", [[], [4, None], [4], [None], [1, 2, 3, 4, None]])
def test_summary_is_the_same_whichever_orders_are_set_apart(spark, monkeypatch, crowded):
    monkeypatch.setattr(star, "frequent_values", lambda df, column: crowded)
    found = {r["order_id"]: r for r in star.order_item_summary(items(spark)).collect()}
    assert sorted(found) == [1, 2, 3, 4]  # rows without an order are no order
    cents = lambda v: None if v is None else int(v * 100)
    assert [found[1][c] for c in ("item_count", "seller_count", "distinct_products")] == [5, 3, 3]
    assert [found[2][c] for c in ("item_count", "seller_count", "distinct_products")] == [3, 1, 1]
    assert [found[3][c] for c in ("item_count", "seller_count", "distinct_products")] == [1, 0, 0]
    assert [found[4][c] for c in ("item_count", "seller_count", "distinct_products")] == [600, 40, 30]
    money = ("product_revenue", "freight_revenue", "total_order_value")
    assert [[cents(found[o][c]) for c in money] for o in (1, 2, 3, 4)] == [
        [730, 250, 880], [900, None, None], [None, None, None], [75_000, 15_000, 90_000],
    ]


def test_frequent_values_are_named_with_missing_ones(spark):
    values = items(spark)
    assert summaries.frequent_values(values, "order_id") == []  # few rows are never too many for a task
    some = partial(summaries.frequent_values, values, "order_id", share=0.05, least=20)
    assert sorted(some(), key=str) == [4, None]
    assert summaries.frequent_values(values.limit(0), "order_id", share=0.05, least=0) == []


def test_a_monthly_table_computes_its_rows_once(spark, monkeypatch):
    """The borders of a range layout are found by a pass of their own; it must not repeat joins and groupings."""
    laid_out, refresh = [], sinks.full_refresh
    monkeypatch.setattr(sinks, "full_refresh", lambda df, *args: laid_out.append(plan(df)) or refresh(df, *args))
    day = F.when(F.col("id") % 7 != 0, F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")))
    rows = spark.range(90).select("id", day.alias("day")).groupBy("id", "day").count()
    path = scratch_path(spark, "monthly")
    assert sinks.monthly_partitioned(rows, path, "day", ["id"]) == "day_month"
    assert "FileScan parquet" in laid_out[0] and "Exchange" not in laid_out[0]
    stored = spark.read.parquet(path)
    assert sorted(map(str, stored.select("id", "day", "count").collect())) == sorted(map(str, rows.collect()))
    assert stored.where("day_month IS NULL").count() == 13
    empty = scratch_path(spark, "monthly")
    sinks.monthly_partitioned(rows.limit(0), empty, "day", ["id"])
