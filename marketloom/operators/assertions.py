"""Table assertions: each returns the violating rows, none means the test passes.

A NULL outcome passes an expression or range test (unlike the rules of the quality
suites), as ``WHERE NOT (...)`` keeps only rows known to violate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.operators.quality import union_each
from marketloom.plans.staging import in_box


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is ignored."""
    return combination_violations(df.where(F.col(column).isNotNull()), [column])


def combination_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values_violations(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Unlisted values with their number of rows."""
    return (
        df.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    )


def expression_violations(df: DataFrame, expression: str) -> DataFrame:
    return df.where(~F.expr(expression))


def range_violations(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def orphan_rows(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent; a child row with a NULL key has none either."""
    return child.join(parent.select(key), key, "left_anti").select(key)


def payment_total_violations(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders whose paid total differs from the sum of their payment lines, to the cent."""
    paid = payments.groupBy("order_id").agg(F.sum("payment_value").alias("sum_paid"))
    total, lines = F.col("total_payment_value"), F.col("sum_paid")
    return (
        orders.select("order_id", "total_payment_value")
        .join(paid, "order_id")
        .where(F.round(total, 2) != F.round(lines, 2))
        .select("order_id", "total_payment_value", "sum_paid", F.abs(total - lines).alias("abs_diff"))
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_each(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("mart"), "row_count")
         for n, df in tables.items()]
    )


def empty_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    return row_counts(tables).where(F.col("row_count") == 0)


def unsegmented(customers: DataFrame) -> DataFrame:
    missing = F.col("rfm_segment").isNull() | F.col("value_tier").isNull()
    return customers.where(missing).select("customer_unique_id")


def outside_box(geography: DataFrame, box: Sequence[float]) -> DataFrame:
    inside = in_box(F.col("latitude"), F.col("longitude"), box)
    return geography.where(~inside).select("zip_code_prefix", "latitude", "longitude", "state_code")


def orders_after(orders: DataFrame, end_date: str) -> DataFrame:
    return orders.where(F.col("purchase_date") > F.lit(end_date).cast("date")).select("order_id", "purchase_date")
