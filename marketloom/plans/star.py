"""Star schema: seven dimensions and four facts, each built from explicit inputs.

Facts are left joins of order-grain summaries; every right side is reduced to one row
per key first, so no join multiplies rows and all order-grain joins share one hash
partitioning on ``order_id``.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketloom.functions import (
    day_of,
    lower_trim,
    money,
    money_sum,
    month_start,
    rounded,
    title_words,
    to_int,
    upper_trim,
    week_from_sunday,
    zero_filled,
)
from marketloom.functions.fingerprint import fingerprint
from marketloom.functions.labels import (
    BOX,
    CALENDAR_DAYS,
    CALENDAR_START,
    CHANNEL_LABELS,
    HOLIDAYS,
    PAYMENT_LABELS,
    UNDEFINED_PAYMENT,
)
from marketloom.operators.joins import detached
from marketloom.operators.ranking import running_totals
from marketloom.operators.summaries import frequent_values
from marketloom.plans.staging import (
    clean_geolocation,
    order_timeline,
    stamped,
    stg_products,
    zip_summary,
    zone_of,
)
from marketloom.session import settle

_STAMP = "dw_inserted_at"


def label(code: Column, labels: dict, default: Column) -> Column:
    """Constant lookup inside the projection, with a default for unlisted codes."""
    pairs = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in labels.items()))
    return F.coalesce(F.try_element_at(pairs, code), default)


# --- dimensions -----------------------------------------------------------------------


def date_spine(spark: SparkSession, start: str = CALENDAR_START, days: int = CALENDAR_DAYS) -> DataFrame:
    return spark.range(days).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("full_date")
    )


def calendar_attributes(d: Column) -> list[Column]:
    """The 18 calendar columns of a date column named ``full_date``."""
    second_half = F.month(d) > 6
    year_start = F.trunc(d, "year")
    return [
        d,
        F.date_format(d, "yyyyMMdd").alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_abbr"),
        week_from_sunday(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).between(2, 6).alias("is_weekday"),
        F.date_format(d, "MM-dd").isin(*HOLIDAYS).alias("is_public_holiday"),
        month_start(d).alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        F.trunc(d, "quarter").alias("first_day_of_quarter"),
        F.when(second_half, F.add_months(year_start, 6)).otherwise(year_start).alias("first_day_of_half_year"),
        F.concat(F.lit("H"), F.when(second_half, "2").otherwise("1"), F.lit("-"), F.year(d).cast("string")).alias(
            "half_year_label"
        ),
    ]


def dim_date(spark: SparkSession, start: str = CALENDAR_START, days: int = CALENDAR_DAYS) -> DataFrame:
    return date_spine(spark, start, days).select(*calendar_attributes(F.col("full_date")))


def dim_geography(
    raw: DataFrame, state_table: DataFrame, box: Sequence[float] = BOX, stamp: bool = False
) -> DataFrame:
    zips = zip_summary(clean_geolocation(raw, box)).withColumnRenamed("city", "city_normalized")
    lat, lng = F.col("latitude"), F.col("longitude")
    out = zips.join(state_table.drop("state_population"), "state_code", "left").select(
        fingerprint("CAST(zip_code_prefix AS STRING)").alias("geo_key"),
        "zip_code_prefix",
        zero_filled(F.col("zip_code_prefix"), 5).alias("zip_code_formatted"),
        rounded(lat, 6).alias("latitude"),
        rounded(lng, 6).alias("longitude"),
        F.struct(lng.alias("lon"), lat.alias("lat")).alias("geo_point"),
        title_words(F.col("city_normalized"), "-").alias("city"),
        "city_normalized",
        "state_code",
        "state_name",
        "region",
        "is_frontier_market",
        zone_of(lat, lng).alias("geographic_zone"),
        "raw_row_count",
    )
    return stamped(out, stamp, _STAMP)


def _located(df: DataFrame, geography: DataFrame, who: str, attributes: Sequence[str]) -> DataFrame:
    """Zip, city and state of a party, with the attributes of its zip where known."""
    places = geography.select(
        "zip_code_prefix",
        "state_name",
        "region",
        F.col("latitude").alias(f"{who}_lat"),
        F.col("longitude").alias(f"{who}_lng"),
        "geographic_zone",
        "is_frontier_market",
    )
    party = df.select(
        *attributes,
        F.col(f"{who}_zip_code_prefix").cast("bigint").alias("zip_code_prefix"),
        lower_trim(f"{who}_city").alias("city"),
        upper_trim(f"{who}_state").alias("state_code"),
    )
    return party.join(detached(places, "zip_code_prefix"), "zip_code_prefix", "left")


def dim_customer(raw: DataFrame, geography: DataFrame, stamp: bool = False) -> DataFrame:
    out = _located(raw, geography, "customer", ["customer_id", "customer_unique_id"]).select(
        "customer_id", "customer_unique_id", "zip_code_prefix", "city", "state_code", "state_name", "region",
        "customer_lat", "customer_lng", "geographic_zone", "is_frontier_market",
    )
    return stamped(out, stamp, _STAMP)


def dim_seller(raw: DataFrame, geography: DataFrame, stamp: bool = False) -> DataFrame:
    out = _located(raw, geography, "seller", ["seller_id"]).select(
        "seller_id", "zip_code_prefix", "city", "state_code", "state_name", "region",
        "seller_lat", "seller_lng", "geographic_zone",
    )
    return stamped(out, stamp, _STAMP)


def dim_product(raw: DataFrame, translation: DataFrame, stamp: bool = False) -> DataFrame:
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    # The divisor gives cubic metres; name and value are kept for compatibility.
    out = stg_products(raw, translation).withColumn("volume_litres", rounded(volume / 1_000_000, 4))
    return stamped(out, stamp, _STAMP)


def _numbered(codes: DataFrame, code: str, key: str) -> DataFrame:
    """Surrogate key 1..n in code order."""
    return running_totals(codes, [F.col(code).asc()]).select(F.col("row_no").alias(key), code)


def dim_payment_type(raw_payments: DataFrame, stamp: bool = False) -> DataFrame:
    codes = raw_payments.where(F.col("payment_type") != UNDEFINED_PAYMENT).select("payment_type").distinct()
    code = F.col("payment_type")
    columns = {name: {k: v[i] for k, v in PAYMENT_LABELS.items()} for i, name in enumerate(
        ("payment_type_name", "payment_category", "supports_installments", "is_offline_payment"))}
    defaults = (title_words(code, "_"), F.lit("Other"), F.lit(False), F.lit(False))
    out = _numbered(codes, "payment_type", "payment_type_key").select(
        "payment_type_key",
        code.alias("payment_type_code"),
        *[label(code, labels, d).alias(name) for (name, labels), d in zip(columns.items(), defaults)],
    )
    return stamped(out, stamp, _STAMP)


def dim_marketing_channel(raw_leads: DataFrame, stamp: bool = False) -> DataFrame:
    codes = raw_leads.where(F.col("origin").isNotNull()).select("origin").distinct()
    code = F.col("origin")
    out = _numbered(codes, "origin", "channel_key").select(
        "channel_key",
        code.alias("channel_code"),
        label(code, {k: v[0] for k, v in CHANNEL_LABELS.items()}, title_words(code, "_")).alias("channel_name"),
        label(code, {k: v[1] for k, v in CHANNEL_LABELS.items()}, F.lit("Other")).alias("channel_type"),
    )
    return stamped(out, stamp, _STAMP)


# --- facts ----------------------------------------------------------------------------


def order_payment_summary(raw_payments: DataFrame) -> DataFrame:
    """Per order: paid total, most instalments, and the type of the largest payment."""
    value = money("payment_value")
    # Largest value first, type name on ties; a missing value ranks last.
    rank = F.struct(value.isNull().alias("missing"), (-value).alias("value"), "payment_type")
    return (
        raw_payments.where(F.col("payment_type") != UNDEFINED_PAYMENT)
        .groupBy("order_id")
        .agg(
            F.sum(value).alias("total_payment_value"),
            F.max(to_int("payment_installments")).alias("max_installments"),
            F.min(rank)["payment_type"].alias("primary_payment_type"),
        )
    )


def order_item_summary(raw_items: DataFrame) -> DataFrame:
    """Per order: rows, revenue, distinct sellers and products.

    Items are dealt by order once. There they are sorted by seller and by product, and a value counts where it
    differs from the one before it. Orders that hold a great part of all items would be too much for one
    task: they are grouped on the map side instead. Either is stored, so that what it shuffled
    is off the disks when the orders are joined.
    """
    items = raw_items.select("order_id", "seller_id", "product_id", money("price").alias("price"), money("freight_value").alias("freight"))
    crowded = frequent_values(raw_items, "order_id")
    if not crowded:
        return _items_by_order(items)
    ids = [v for v in crowded if v is not None]
    many = F.coalesce(F.col("order_id").isin(ids), F.lit(None in crowded)) if ids else F.col("order_id").isNull()
    return _items_by_order(items.where(~many)).unionByName(_items_of_crowded_orders(settle(items.where(many))))


def _item_sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("item_count"),
        F.sum("price").alias("product_revenue"),
        F.sum("freight").alias("freight_revenue"),
        F.sum(F.col("price") + F.col("freight")).alias("total_order_value"),
    ]


def _items_by_order(items: DataFrame) -> DataFrame:
    """The summary of orders of which each fits into a task, in one shuffle."""

    def is_new(column: str) -> Column:
        before = F.lag(column).over(Window.partitionBy("order_id").orderBy(column))
        return F.col(column).isNotNull() & ~F.col(column).eqNullSafe(before)

    marked = items.withColumns({"new_seller": is_new("seller_id"), "new_product": is_new("product_id")})
    summary = marked.groupBy("order_id").agg(
        *_item_sums(),
        F.count_if("new_seller").alias("seller_count"),
        F.count_if("new_product").alias("distinct_products"),
    )
    return settle(summary).where(F.col("order_id").isNotNull())


def _items_of_crowded_orders(items: DataFrame) -> DataFrame:
    """The same for a few orders with very many items.

    Sums and distinct counts are two groupings joined on their common key. In one
    grouping, every row would be tripled with its money columns to count two distincts.
    """
    sums = items.groupBy("order_id").agg(*_item_sums())
    variety = items.groupBy("order_id").agg(
        F.countDistinct("seller_id").alias("seller_count"),
        F.countDistinct("product_id").alias("distinct_products"),
    )
    return settle(sums).join(settle(variety), "order_id")


def best_review(reviews: DataFrame) -> DataFrame:
    """Reviews are not unique per order; the highest score stands for the order."""
    return reviews.groupBy("order_id").agg(F.max(to_int("review_score")).alias("review_score"))


def fact_orders(
    raw_orders: DataFrame,
    raw_items: DataFrame,
    raw_payments: DataFrame,
    raw_reviews: DataFrame,
    customers: DataFrame,
    stamp: bool = False,
) -> DataFrame:
    timing = order_timeline(raw_orders)
    buyers = customers.select(
        "customer_id", F.col("state_code").alias("customer_state"), F.col("region").alias("customer_region")
    )

    def filled(name: str, default: int) -> Column:
        return F.coalesce(name, F.lit(default)).alias(name)

    # The customer join runs on narrow order rows, before the order-grain joins that
    # share their partitioning on order_id.
    out = (
        timing.join(buyers, "customer_id", "left")
        .join(order_item_summary(raw_items), "order_id", "left")
        .join(order_payment_summary(raw_payments), "order_id", "left")
        .join(best_review(raw_reviews), "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "purchase_date",
            "approved_date",
            F.col("carrier_pickup_date").alias("carrier_date"),
            "delivered_date",
            "estimated_delivery_date",
            "order_status",
            filled("item_count", 0),
            filled("distinct_products", 0),
            filled("seller_count", 0),
            filled("product_revenue", 0),
            filled("freight_revenue", 0),
            filled("total_order_value", 0),
            filled("total_payment_value", 0),
            F.coalesce("max_installments", F.lit(1)).alias("payment_installments"),
            "primary_payment_type",
            "review_score",
            F.col("delivery_days").alias("actual_delivery_days"),
            "estimated_delivery_days",
            "is_on_time",
            "customer_state",
            "customer_region",
        )
    )
    return stamped(out, stamp, _STAMP)


def fact_order_items(
    raw_items: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    orders: DataFrame,
    stamp: bool = False,
) -> DataFrame:
    """Item rows with product, seller and order attributes (``orders`` is the orders fact)."""
    items = raw_items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        day_of("shipping_limit_date").alias("shipping_limit_date"),
        money("price").alias("item_price"),
        money("freight_value").alias("freight_value"),
        money_sum("price", "freight_value").alias("item_total"),
    )
    out = (
        items.join(
            products.select("product_id", F.col("category_english").alias("product_category"), "product_weight_g"),
            "product_id",
            "left",
        )
        .join(
            sellers.select(
                "seller_id", F.col("state_code").alias("seller_state"), F.col("region").alias("seller_region")
            ),
            "seller_id",
            "left",
        )
        .join(orders.select("order_id", "purchase_date", "order_status", "customer_state"), "order_id", "left")
        .select(
            "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "item_price",
            "freight_value", "item_total", "product_category", "product_weight_g", "seller_state",
            "seller_region", "purchase_date", "order_status", "customer_state",
        )
    )
    return stamped(out, stamp, _STAMP)


def order_attributes(raw_orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The order columns item and payment facts need, without the order summaries.

    Equal to the same columns of the orders fact, but free of its item, payment and
    review joins; use it when that fact is not already stored.
    """
    return order_timeline(raw_orders).join(
        customers.select("customer_id", F.col("state_code").alias("customer_state")), "customer_id", "left"
    ).select("order_id", "purchase_date", "order_status", "customer_state")


def fact_marketing_funnel(raw_leads: DataFrame, raw_deals: DataFrame, stamp: bool = False) -> DataFrame:
    deals = raw_deals.select(
        "mql_id", "seller_id", "won_date", "business_segment", "lead_type", "lead_behaviour_profile",
        "business_type", "declared_monthly_revenue",
    )
    first, won = day_of("first_contact_date"), day_of("won_date")
    out = raw_leads.join(deals, "mql_id", "left").select(
        "mql_id",
        "landing_page_id",
        F.col("origin").alias("channel_code"),
        first.alias("first_contact_date"),
        won.alias("won_date"),
        "seller_id",
        "business_segment",
        "lead_type",
        "lead_behaviour_profile",
        "business_type",
        F.coalesce(money("declared_monthly_revenue"), F.lit(0).cast("decimal(18,2)")).alias(
            "declared_monthly_revenue"
        ),
        F.col("seller_id").isNotNull().alias("is_converted"),
        F.datediff(won, first).alias("days_to_close"),
    )
    return stamped(out, stamp, _STAMP)


def fact_payments(raw_payments: DataFrame, orders: DataFrame, stamp: bool = False) -> DataFrame:
    lines = raw_payments.where(F.col("payment_type") != UNDEFINED_PAYMENT).select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        money("payment_value").alias("payment_value"),
    )
    out = lines.join(
        orders.select("order_id", "purchase_date", "customer_state", "order_status"), "order_id", "left"
    )
    return stamped(out, stamp, _STAMP)
