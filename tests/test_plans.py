"""Plans stay distributed: pushed filters, pruned columns, no one-task stage over table-sized input."""

from __future__ import annotations

import re

import pytest

from marketloom import catalog
from marketloom.plans import marts


@pytest.fixture
def shuffled(spark):
    """No broadcast joins and no adaptive rewriting, as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n.startswith(("stg_", "dim_", "fact_", "mart_", "product_", "repeat_"))])
def test_no_single_task_stage(shuffled, sf_dir, name):
    text = plan(catalog.QUERIES[name](shuffled, sf_dir))
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    if name in ("mart_product_performance", "dim_payment_type", "dim_marketing_channel"):
        # Only the offsets of the slices, one row per shuffle partition.
        after = text[text.index("SinglePartition"):]
        assert len(single) == 1 and "_slice" in after.splitlines()[1]
    else:
        assert not single
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python", text)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = catalog.QUERIES["mart_monthly_revenue"](spark, sf_dir)._jdf.queryExecution().toString()
    items = next(line for line in text.splitlines() if "FileScan parquet" in line and "l_extendedprice" in line)
    assert "l_returnflag" not in items and "l_shipdate" not in items and "l_quantity" not in items
    assert "IsNotNull(l_orderkey)" in items and "IsNotNull(l_partkey)" in items


def test_points_are_read_once_where_their_middle_is_not_used(shuffled, sf_dir):
    scans = lambda df: sum("FileScan parquet" in line and "event_type" in line or "FileScan parquet [event_id" in line for line in plan(df).splitlines())
    customers = catalog.QUERIES["dim_customer"](shuffled, sf_dir)
    assert scans(customers) == 2
    assert scans(customers.select("customer_id", "state_code", "region")) == 1


def test_distinct_counts_along_the_hierarchy_need_no_expand(shuffled, sf_dir):
    for name in ("mart_monthly_revenue", "mart_geo_performance", "mart_customer_lifetime_value"):
        assert "Expand" not in plan(catalog.QUERIES[name](shuffled, sf_dir))


def test_items_are_summed_before_they_meet_their_order(shuffled, sf_dir):
    text = plan(catalog.QUERIES["mart_monthly_revenue"](shuffled, sf_dir))
    join = text.index("SortMergeJoin [order_id")
    assert "HashAggregate(keys=[order_id" in text[join:] and "partial_sum" in text[join:]


def test_category_figures_are_not_mixed_with_sketches(shuffled, sf_dir):
    spark = shuffled
    inputs = catalog.product_inputs(spark, sf_dir)
    text = plan(marts.category_summary(*inputs))
    for line in text.splitlines():
        if "kll_sketch_agg" in line:
            assert "count(distinct" not in line and "gid" not in line


def test_hot_order_is_split_by_adaptive_execution(spark):
    """A third of the item rows in one order: the join still splits that partition."""
    from pyspark.sql import functions as F

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        money = "decimal(18,2)"
        items = spark.range(0, n, 1, 6).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("order_id"),
            F.col("id").alias("order_item_id"),
            (F.col("id") % 500).alias("product_id"),
            (F.col("id") % 97).alias("seller_id"),
            *[F.lit(1).cast(money).alias(c) for c in ("item_price", "freight_value", "item_total")],
        )
        orders = spark.range(n).select(
            F.col("id").alias("order_id"), F.lit("2018-01-01").cast("date").alias("purchase_date"),
            F.lit("delivered").alias("order_status"), F.lit(True).alias("is_on_time"),
        )
        reviews = orders.select("order_id", F.lit(5).alias("review_score"))
        summary = marts.seller_summary(items, orders, reviews)
        rows = summary.collect()
        assert sum(r["total_items_sold"] for r in rows) == n and all(r["score_sum"] == 5 * r["scored"] for r in rows)
        assert sum(r["unique_products"] for r in rows) == items.select("seller_id", "product_id").distinct().count()
        assert "SortMergeJoin(skew=true)" in plan(summary)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
