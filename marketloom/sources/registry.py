"""The raw datasets: file, table, key, incremental column and required columns."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dataset:
    name: str
    file: str
    table: str
    required: tuple[str, ...]
    primary_key: str | None = None
    incremental_column: str | None = None
    multi_line: bool = False  # quoted text with line breaks; such files are read whole, one task each


# --- Fixed values: dataset registry ------------------------------------------------------
DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset("orders", "orders.csv", "raw_orders", ("order_id", "customer_id", "order_status"),
                "order_id", "order_purchase_timestamp"),
        Dataset("order_items", "order_items.csv", "raw_order_items", ("order_id", "product_id", "seller_id", "price"),
                None, "shipping_limit_date"),
        Dataset("customers", "customers.csv", "raw_customers", ("customer_id", "customer_unique_id"), "customer_id"),
        Dataset("products", "products.csv", "raw_products", ("product_id",), "product_id"),
        Dataset("sellers", "sellers.csv", "raw_sellers", ("seller_id",), "seller_id"),
        Dataset("payments", "order_payments.csv", "raw_order_payments", ("order_id", "payment_type", "payment_value")),
        Dataset("reviews", "order_reviews.csv", "raw_order_reviews", ("review_id", "order_id", "review_score"),
                None, "review_creation_date", multi_line=True),
        Dataset("category_translation", "category_name_translation.csv", "raw_category_translation",
                ("product_category_name", "product_category_name_english"), "product_category_name"),
        Dataset("mql", "marketing_qualified_leads.csv", "raw_marketing_qualified_leads",
                ("mql_id", "first_contact_date", "origin"), "mql_id", "first_contact_date"),
        Dataset("closed_deals", "closed_deals.csv", "raw_closed_deals", ("mql_id", "seller_id", "won_date"),
                "mql_id", "won_date"),
    )
}

# --- Fixed values: typed geolocation schema (zip stays text, it has leading zeros) --------
GEOLOCATION_FILE = "geolocation.csv"
GEOLOCATION_SCHEMA = (
    "geolocation_zip_code_prefix STRING, geolocation_lat DOUBLE, geolocation_lng DOUBLE, "
    "geolocation_city STRING, geolocation_state STRING"
)
GEOLOCATION_COLUMNS = tuple(part.split()[0] for part in GEOLOCATION_SCHEMA.split(", "))

# --- Fixed values: columns read as dates by the reports -----------------------------------
DATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"),
    "order_items": ("shipping_limit_date",),
    "reviews": ("review_creation_date", "review_answer_timestamp"),
    "mql": ("first_contact_date",),
    "closed_deals": ("won_date",),
}
