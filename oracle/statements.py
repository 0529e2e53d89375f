"""Query name -> DuckDB SQL over the given tables."""

from oracle import quality, reports
from oracle.compose import compose

_PLAIN = (
    "stg_orders", "stg_order_items", "stg_customers", "stg_products", "stg_sellers", "stg_payments", "stg_reviews",
    "stg_marketing_leads", "stg_geolocation", "stg_geolocation_exact",
    "dim_date", "dim_geography", "dim_customer", "dim_product", "dim_seller", "dim_payment_type", "dim_marketing_channel",
    "fact_orders", "fact_order_items", "fact_marketing_funnel", "fact_payments",
    "mart_monthly_revenue", "mart_monthly_revenue_repeated", "mart_customer_lifetime_value", "mart_geo_performance", "mart_seller_performance",
    "mart_marketing_funnel", "mart_marketing_funnel_any", "mart_logistics_performance", "mart_product_performance",
    "product_aggregate", "repeat_buyers",
)


_MONEY = {
    "stg_order_items": ("item_price", "freight_value", "item_total"),
    "stg_payments": ("payment_value",),
    "stg_marketing_leads": ("declared_monthly_revenue",),
    "fact_orders": ("product_revenue", "freight_revenue", "total_order_value", "total_payment_value"),
    "fact_order_items": ("item_price", "freight_value", "item_total"),
    "fact_marketing_funnel": ("declared_monthly_revenue",),
    "fact_payments": ("payment_value",),
    "mart_geo_performance": ("total_revenue",),
}


def _edge(name: str) -> str:
    """Whole relation; decimals leave as doubles, as on the Spark side."""
    if name not in _MONEY:
        return f"SELECT * FROM {name}"
    doubles = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MONEY[name])
    return f"SELECT * REPLACE ({doubles}) FROM {name}"


_FACT_COPIES = ("write_read_partitioned", "export_orders_json")


def _body(name: str, body: str) -> str:
    if name in _FACT_COPIES:
        doubles = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MONEY["fact_orders"])
        return body.replace("SELECT *", f"SELECT * REPLACE ({doubles})")
    if name == "append_new_items":
        return _edge("stg_order_items")
    return body


STATEMENTS: dict[str, str] = {name: compose(_edge(name)) for name in _PLAIN}
STATEMENTS |= {name: compose(_body(name, body)) for name, body in {**reports.BODIES, **quality.BODIES}.items()}
