"""Pre-load expectations of the core datasets (45 checks in eight suites)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from marketloom.functions import as_timestamp
from marketloom.functions.labels import ORDER_STATUSES, PAYMENT_TYPES, UNDEFINED_PAYMENT
from marketloom.operators.quality import Between, InSet, NotNull, References, Rule, Unique, run_checks, union_all

Tables = Mapping[str, DataFrame]


def orders(t: Tables) -> list[DataFrame]:
    return [
        run_checks(
            t["orders"],
            "orders",
            [
                NotNull("order_id"),
                NotNull("customer_id"),
                NotNull("order_status"),
                NotNull("order_purchase_timestamp"),
                Unique("order_id"),
                InSet("order_status", ORDER_STATUSES),
                # An unknown status counts as "not approved", hence the null-safe test.
                Rule("approved_needs_timestamp", "NOT (order_status <=> 'approved') OR order_approved_at IS NOT NULL"),
            ],
        )
    ]


def order_items(t: Tables) -> list[DataFrame]:
    return [
        run_checks(
            t["order_items"],
            "order_items",
            [
                NotNull("order_id"),
                NotNull("product_id"),
                NotNull("seller_id"),
                NotNull("price"),
                Between("price", low=0),
                Between("freight_value", low=0),
                References("order_id", t["orders"], "order_id", "orders"),
                References("product_id", t["products"], "product_id", "products"),
                References("seller_id", t["sellers"], "seller_id", "sellers"),
            ],
        )
    ]


def customers(t: Tables) -> list[DataFrame]:
    checks = [NotNull("customer_id"), NotNull("customer_unique_id"), Unique("customer_id")]
    return [run_checks(t["customers"], "customers", checks)]


def products(t: Tables) -> list[DataFrame]:
    checks = [
        NotNull("product_id"),
        Unique("product_id"),
        Between("product_weight_g", low=0),
        Between("product_photos_qty", low=0),
    ]
    return [run_checks(t["products"], "products", checks)]


def sellers(t: Tables) -> list[DataFrame]:
    return [run_checks(t["sellers"], "sellers", [NotNull("seller_id"), Unique("seller_id"), NotNull("seller_state")])]


def payments(t: Tables) -> list[DataFrame]:
    return [
        run_checks(
            t["payments"],
            "payments",
            [
                NotNull("order_id"),
                NotNull("payment_type"),
                NotNull("payment_value"),
                Between("payment_value", low=0),
                Between("payment_installments", low=0, high=24),
                InSet("payment_type", (*PAYMENT_TYPES, UNDEFINED_PAYMENT)),
                References("order_id", t["orders"], "order_id", "orders"),
            ],
        )
    ]


def reviews(t: Tables) -> list[DataFrame]:
    checks = [
        NotNull("review_id"),
        NotNull("order_id"),
        NotNull("review_score"),
        Between("review_score", low=1, high=5),
    ]
    return [run_checks(t["reviews"], "reviews", checks)]


def won_after_contact(leads: DataFrame, deals: DataFrame, allowed: int = 1) -> DataFrame:
    """Cross-table rule on leads with a deal: won on or after the first contact."""
    both = leads.select("mql_id", as_timestamp("first_contact_date").alias("first_contact_date")).join(
        deals.select("mql_id", as_timestamp("won_date").alias("won_date")), "mql_id"
    )
    rule = Rule("won_after_contact", "won_date >= first_contact_date", max_violations=allowed)
    return run_checks(both, "marketing_funnel", [rule])


def marketing(t: Tables) -> list[DataFrame]:
    leads, deals = t["mql"], t["closed_deals"]
    return [
        run_checks(
            leads,
            "mql",
            [
                NotNull("mql_id"),
                Unique("mql_id"),
                NotNull("first_contact_date"),
                NotNull("origin", max_null_rate=0.01),
            ],
        ),
        run_checks(
            deals,
            "closed_deals",
            [NotNull("mql_id"), NotNull("seller_id"), References("mql_id", leads, "mql_id", "mql")],
        ),
        won_after_contact(leads, deals),
    ]


SUITES: dict[str, Callable[[Tables], list[DataFrame]]] = {
    "orders": orders,
    "order_items": order_items,
    "customers": customers,
    "products": products,
    "sellers": sellers,
    "payments": payments,
    "reviews": reviews,
    "mql": marketing,
}


def core_suite(tables: Tables) -> DataFrame:
    """Results of every suite whose dataset was loaded."""
    frames = [frame for name, suite in SUITES.items() if name in tables for frame in suite(tables)]
    if not frames:
        raise ValueError("no dataset loaded, nothing to validate")
    return union_all(frames)
