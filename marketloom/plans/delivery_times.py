"""Delivery times as stored sketches: one per state and month, merged for any longer span.

A median over years cannot be made of monthly medians. The monthly table keeps a sketch of the delivery days
instead, is refreshed like any incremental mart (only the months of the lookback are computed again), and answers
quantiles per state, year or in total by merging a few sketches, without the orders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.dates import month_start
from marketloom.operators.sketches import merged_sketch, quantile_sketch, sketch_count, sketch_quantile

SHARES = {"p10_delivery_days": 0.1, "median_delivery_days": 0.5, "p90_delivery_days": 0.9}


def monthly_sketches(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """State x month: sketch of the days of delivered orders.

    An order of an unknown customer, or without a purchase date and so without a month, does not count.
    """
    dated = orders.where(F.col("purchase_date").isNotNull())
    delivered = dated.where((F.col("order_status") == "delivered") & (F.col("delivery_days") >= 0)).select(
        "customer_id", month_start("purchase_date").alias("order_month"), F.col("delivery_days").cast("bigint").alias("days")
    )
    return (
        delivered.join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state", "order_month")
        .agg(quantile_sketch("days").alias("days_sketch"))
    )


def quantiles_over(sketches: DataFrame, keys: Sequence[Column | str], shares: Mapping[str, float] = SHARES) -> DataFrame:
    """Delivered orders and quantiles of their days for each group of ``keys`` (columns of the monthly table)."""
    merged = sketches.groupBy(*keys).agg(merged_sketch("days_sketch").alias("_sketch"))
    names = [c for c in merged.columns if c != "_sketch"]
    found = [sketch_quantile("_sketch", share).alias(name) for name, share in shares.items()]
    return merged.select(*names, sketch_count("_sketch").alias("delivered_orders"), *found)
