"""Declared tests of the staging and mart tables (109) and their one-pass evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.labels import (
    BOX,
    CONVERSION_TIERS,
    ORDER_STATUSES,
    PAYMENT_TYPES,
    PRODUCT_TIERS,
    REGIONS,
    RFM_SEGMENTS,
    SELLER_TIERS,
    SLA_BANDS,
    STATE_CODES,
    VALUE_TIERS,
)
from marketloom.operators.quality import union_each


@dataclass(frozen=True)
class TableTest:
    """kind: unique, not_null, accepted_values, expression, accepted_range or unique_combination."""

    table: str
    kind: str
    column: str
    argument: object = None
    severity: str = "error"


def _tests(table: str, unique=(), not_null=(), values=None, expressions=None, ranges=None) -> list[TableTest]:
    return [
        *[TableTest(table, "unique", c) for c in unique],
        *[TableTest(table, "not_null", c) for c in not_null],
        *[TableTest(table, "accepted_values", c, tuple(v)) for c, v in (values or {}).items()],
        *[TableTest(table, "expression", c, e) for c, e in (expressions or {}).items()],
        *[TableTest(table, "accepted_range", c, r) for c, r in (ranges or {}).items()],
    ]


def declared_tests(states: Sequence[str] = STATE_CODES, regions: Sequence[str] = REGIONS) -> list[TableTest]:
    # --- Fixed values: declared tests ------------------------------------------------------
    return [
        *_tests("raw_orders", unique=["order_id"], not_null=["order_id"]),
        *_tests(
            "stg_orders",
            unique=["order_id"],
            not_null=["order_id", "customer_id"],
            values={"order_status": ORDER_STATUSES},
            expressions={"delivery_days": "delivery_days >= 0 OR delivery_days IS NULL"},
        ),
        TableTest("stg_order_items", "unique_combination", "order_id, order_item_id", ("order_id", "order_item_id")),
        *_tests(
            "stg_order_items",
            not_null=["order_id", "product_id", "seller_id", "item_price"],
            expressions={"item_price": "item_price > 0"},
        ),
        *_tests(
            "stg_customers",
            unique=["customer_id"],
            not_null=["customer_id", "customer_unique_id"],
            values={"customer_state": states},
        ),
        *_tests("stg_products", unique=["product_id"], not_null=["product_id"]),
        *_tests("stg_sellers", unique=["seller_id"], not_null=["seller_id"]),
        *_tests(
            "stg_payments",
            not_null=["order_id"],
            values={"payment_type": PAYMENT_TYPES},
            expressions={"payment_value": "payment_value >= 0"},
        ),
        *_tests("stg_reviews", not_null=["review_id", "order_id"], ranges={"review_score": (1, 5)}),
        *_tests("stg_marketing_leads", unique=["mql_id"], not_null=["mql_id"]),
        TableTest("stg_marketing_leads", "not_null", "origin", severity="warn"),
        *_tests(
            "stg_geolocation",
            unique=["zip_code_prefix"],
            not_null=["zip_code_prefix", "latitude", "longitude", "state_code"],
            values={"state_code": states, "region": regions},
            ranges={"zip_code_prefix": (1001, 99999), "latitude": BOX[:2], "longitude": BOX[2:]},
        ),
        *_tests(
            "mart_monthly_revenue",
            not_null=["revenue_month", "year", "month", "category", "total_revenue", "order_count"],
            expressions={
                "total_revenue": "total_revenue >= 0",
                "order_count": "order_count > 0",
                "avg_order_value": "avg_order_value >= 0 OR avg_order_value IS NULL",
            },
        ),
        *_tests(
            "mart_customer_lifetime_value",
            unique=["customer_unique_id"],
            not_null=["customer_unique_id", "customer_state", "first_order_date", "last_order_date", "order_count",
                      "total_spend", "rfm_segment"],
            values={"rfm_segment": RFM_SEGMENTS, "value_tier": VALUE_TIERS},
            expressions={
                "last_order_date": "last_order_date >= first_order_date",
                "order_count": "order_count >= 1",
                "total_spend": "total_spend > 0",
                "estimated_clv": "estimated_clv >= 0",
            },
        ),
        *_tests(
            "mart_geo_performance",
            not_null=["state_code", "order_month", "total_orders", "total_revenue", "region"],
            values={"region": regions},
            expressions={"total_orders": "total_orders > 0", "total_revenue": "total_revenue >= 0"},
        ),
        *_tests(
            "mart_seller_performance",
            unique=["seller_id"],
            not_null=["seller_id", "seller_tier", "performance_score", "gross_merchandise_value"],
            values={"seller_tier": SELLER_TIERS},
            expressions={
                "performance_score": "performance_score BETWEEN 0 AND 100",
                "gross_merchandise_value": "gross_merchandise_value >= 0",
                "on_time_delivery_pct": "on_time_delivery_pct BETWEEN 0 AND 100 OR on_time_delivery_pct IS NULL",
                "avg_review_score": "avg_review_score BETWEEN 1 AND 5 OR avg_review_score IS NULL",
            },
        ),
        *_tests(
            "mart_marketing_funnel",
            not_null=["origin", "cohort_month", "total_leads", "converted_leads", "conversion_rate_pct"],
            values={"conversion_tier": CONVERSION_TIERS},
            expressions={
                "total_leads": "total_leads > 0",
                "converted_leads": "converted_leads >= 0",
                "conversion_rate_pct": "conversion_rate_pct BETWEEN 0 AND 100",
            },
        ),
        *_tests(
            "mart_logistics_performance",
            not_null=["customer_state", "order_month", "total_delivered_orders", "on_time_pct", "avg_delivery_days",
                      "sla_performance_band"],
            values={"sla_performance_band": SLA_BANDS},
            expressions={
                "total_delivered_orders": "total_delivered_orders > 0",
                "on_time_pct": "on_time_pct BETWEEN 0 AND 100",
                "avg_delivery_days": "avg_delivery_days > 0",
            },
        ),
        *_tests(
            "mart_product_performance",
            unique=["category_english"],
            not_null=["category_english", "performance_tier", "category_gross_revenue", "revenue_share_pct"],
            values={"performance_tier": PRODUCT_TIERS},
            expressions={
                "category_gross_revenue": "category_gross_revenue > 0",
                "revenue_share_pct": "revenue_share_pct BETWEEN 0 AND 100",
                "avg_review_score": "avg_review_score BETWEEN 1 AND 5 OR avg_review_score IS NULL",
            },
        ),
    ]


def _violates(test: TableTest) -> Column:
    value = F.col(test.column) if test.kind != "unique_combination" else None
    if test.kind == "not_null":
        return value.isNull()
    if test.kind == "accepted_values":
        return ~value.isin(*test.argument)
    if test.kind == "expression":
        return ~F.expr(test.argument)
    return ~value.between(*test.argument)


def _row(test: TableTest, failures: Column) -> Column:
    status = F.when(failures == 0, "PASS").otherwise("WARN" if test.severity == "warn" else "FAIL")
    return F.struct(
        F.lit(test.table).alias("table_name"),
        F.lit(test.column).alias("column_name"),
        F.lit(test.kind).alias("test"),
        F.lit(test.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
        status.alias("status"),
    )


def _keys(test: TableTest) -> list[str]:
    return list(test.argument) if test.kind == "unique_combination" else [test.column]


def _repeated(df: DataFrame, test: TableTest) -> DataFrame:
    """Number of key values that occur more than once."""
    present = df.dropna(subset=[test.column]) if test.kind == "unique" else df
    per_key = present.groupBy(*_keys(test)).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.count_if(F.col("_n") > 1).alias("failures")).select(
        F.inline(F.array(_row(test, F.col("failures"))))
    )


def run_table_tests(tables: Mapping[str, DataFrame], tests: Sequence[TableTest]) -> DataFrame:
    """One row per test: violating rows (or repeated keys) and status.

    All row-level tests of a table share one aggregation pass. The passes run one after the other.
    """
    frames = []
    for name, df in tables.items():
        mine = [t for t in tests if t.table == name]
        frames += [_repeated(df, t) for t in mine if t.kind.startswith("unique")]
        flat = [t for t in mine if not t.kind.startswith("unique")]
        if flat:
            counted = df.agg(*[F.count_if(_violates(t)).alias(f"f{i}") for i, t in enumerate(flat)])
            frames.append(counted.select(F.inline(F.array(*[_row(t, F.col(f"f{i}")) for i, t in enumerate(flat)]))))
    return union_each(frames)
