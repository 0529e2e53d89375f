"""Detail tables stored by the month of their order, so that an incremental mart reads recent months only.

Items and reviews carry no order date, so a run that wants those of the lookback would read them all and
throw most away. Here they take the month of their order when they land: a batch of details is joined with the
orders it belongs to and appended to the partitions of those months. Landing costs what the batch costs, and a
run reads the partitions from the first month of its lookback on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.sources.sinks import clustered

MONTH = "order_month"


def land_by_month(details: DataFrame, orders: DataFrame, path: str, key: str, date_column: str) -> None:
    """Append a batch of ``details`` under the month of their order; ``orders`` may hold more than the batch needs.

    Details of an order that is not known, or has no date, go to the partition without a month. Rows are
    laid out by key inside a month, so files hold ranges of keys. A detail meets one order; a repeated
    order row does not repeat it.
    """
    months = orders.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.trunc(date_column, "MM")).alias(MONTH))
    dated = details.join(months, key, "left").select(*details.columns, MONTH)
    clustered(dated, [MONTH, key]).write.mode("append").partitionBy(MONTH).parquet(path)


def since(spark: SparkSession, path: str, first: dt.date | None) -> DataFrame:
    """The stored details of orders from the month of ``first`` on; all of them without a first day.

    The bound is a literal on the partition column: other months are neither listed nor read.
    """
    details = spark.read.parquet(path)
    if first is None:
        return details
    return details.where(F.col(MONTH) >= F.lit(first.replace(day=1)))
