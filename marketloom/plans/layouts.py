"""How every star table and mart is stored: kind, partitions, clustering and key, declared once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.sources.sinks import materialize


@dataclass(frozen=True)
class Layout:
    """``date`` partitions by its month; a day each would leave thousands of small Parquet files.

    ``slices``: the months are made and written in so many groups, for a table whose rows are shuffled several times.
    """

    kind: str = "table"
    date: str | None = None
    cluster_by: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    slices: int = 1


#: The published settings of each model.
LAYOUTS: dict[str, Layout] = {
    "dim_date": Layout(cluster_by=("year", "month")),
    "dim_geography": Layout(cluster_by=("state_code", "region")),
    "dim_customer": Layout(cluster_by=("state_code",)),
    "dim_product": Layout(cluster_by=("category_english",)),
    "dim_seller": Layout(cluster_by=("state_code",)),
    "dim_payment_type": Layout(),
    "dim_marketing_channel": Layout(),
    "fact_orders": Layout(date="purchase_date", cluster_by=("customer_state", "order_status")),
    "fact_order_items": Layout(date="shipping_limit_date", cluster_by=("seller_id", "product_id"), slices=6),
    "fact_marketing_funnel": Layout(date="first_contact_date", cluster_by=("channel_code", "business_segment")),
    "fact_payments": Layout(cluster_by=("payment_type",)),
    "mart_monthly_revenue": Layout(cluster_by=("year", "month")),
    "mart_customer_lifetime_value": Layout(date="first_order_date", cluster_by=("customer_state", "rfm_segment")),
    "mart_geo_performance": Layout("incremental", "order_month", ("region", "state_code"), ("state_code", "order_month")),
    "mart_logistics_performance": Layout(
        "incremental", "order_month", ("customer_state", "region"), ("customer_state", "order_month")
    ),
    "mart_marketing_funnel": Layout(cluster_by=("origin", "conversion_tier")),
    "mart_product_performance": Layout(cluster_by=("category_english", "performance_tier")),
    "mart_seller_performance": Layout(cluster_by=("seller_state", "seller_tier")),
}


def partition_column(layout: Layout) -> str | None:
    """The month column a table is partitioned by; a column that is a month already serves itself."""
    if layout.date is None or layout.date.endswith("_month"):
        return layout.date
    return f"{layout.date}_month"


def store(df: DataFrame, name: str, path: str) -> DataFrame:
    """Materialise a model at ``path`` as declared and read it back."""
    layout = LAYOUTS[name]
    month = partition_column(layout)
    if month and month != layout.date:
        df = df.withColumn(month, F.trunc(layout.date, "MM"))
    return materialize(df, name, path, layout.kind, [month] if month else [], layout.cluster_by, layout.key, layout.slices)
