"""Report aggregates: the numbers behind the charts and the business summary.

They start from raw tables. Missing values follow dataframe habits: a missing group key
is left out, sums of nothing are zero, an undelivered order is not late.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import as_timestamp, clipped, elapsed_days, mean, money, month_start, ratio, rounded, to_int
from marketloom.operators.ranking import Score, assign_buckets, qcut_ends, running_totals
from marketloom.operators.summaries import first_per_key, histogram

# --- Fixed values: report labels --------------------------------------------------------
SEGMENTS = ("Champion", "Loyal", "At Risk", "Hibernating", "New", "One-Time Buyer")
CONCENTRATION_TIERS = (("Top 5%", 0.05), ("Mid 6-20%", 0.20), ("Long Tail", 1.0))


def share(numerator: Column, denominator: Column) -> Column:
    """Percentage, kept to six digits."""
    return rounded(ratio(numerator, denominator) * 100, 6)


def timed_orders(raw_orders: DataFrame) -> DataFrame:
    """Orders with elapsed delivery days, late flag and month."""
    bought = as_timestamp("order_purchase_timestamp")
    delivered = as_timestamp("order_delivered_customer_date")
    promised = as_timestamp("order_estimated_delivery_date")
    return raw_orders.select(
        "order_id",
        "customer_id",
        "order_status",
        bought.alias("purchased_at"),
        elapsed_days(delivered, bought).alias("delivery_days"),
        F.coalesce(delivered > promised, F.lit(False)).alias("is_late"),
        month_start(bought).alias("month"),
    )


def with_places(orders: DataFrame, raw_customers: DataFrame) -> DataFrame:
    return orders.join(raw_customers.select("customer_id", "customer_state", "customer_city"), "customer_id", "left")


def with_values(orders: DataFrame, raw_items: DataFrame) -> DataFrame:
    values = raw_items.groupBy("order_id").agg(
        F.sum(money("price")).alias("total_value"),
        F.sum(money("freight_value")).alias("freight"),
        F.count("order_item_id").alias("item_count"),
    )
    return orders.join(values, "order_id", "left")


def enriched_orders(
    raw_orders: DataFrame,
    raw_items: DataFrame,
    raw_reviews: DataFrame,
    raw_customers: DataFrame,
    review_order: Sequence[str] = ("review_creation_date", "review_id", "review_score"),
) -> DataFrame:
    """Orders with elapsed delivery days, late flag, month, value, first review and place.

    The first review of an order is taken in ``review_order``. A report that needs less starts
    from ``timed_orders`` and joins only the sides it uses.
    """
    first_review = first_per_key(
        raw_reviews.withColumn("review_score", to_int("review_score")),
        ["order_id"],
        [F.col(c) for c in review_order],
        ["review_score"],
    )
    return with_values(with_places(timed_orders(raw_orders), raw_customers), raw_items).join(first_review, "order_id", "left")


def delivered_only(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == "delivered")


def total_or_zero(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def monthly_trend(orders: DataFrame) -> DataFrame:
    return (
        delivered_only(orders)
        .where(F.col("month").isNotNull())
        .groupBy("month")
        .agg(total_or_zero("total_value").alias("revenue"), F.count("order_id").alias("orders"))
        .orderBy("month")
    )


def peak_month(orders: DataFrame) -> DataFrame:
    """The month with the highest revenue, the first one on ties."""
    best = F.min(F.struct((-F.col("revenue")).alias("minus"), "month", "revenue"))
    return monthly_trend(orders).agg(best.alias("best")).select("best.month", "best.revenue")


# --- customer segments ------------------------------------------------------------------


def rfm_scores(orders: DataFrame) -> DataFrame:
    """Per customer: recency to the day after the last order, frequency, spend, quartile scores."""
    last = orders.agg(F.max("purchased_at")).first()[0]  # one value
    snapshot = F.lit(last) + F.make_dt_interval(F.lit(1))
    customers = (
        delivered_only(orders)
        .where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.max("purchased_at").alias("last_purchase"),
            F.count("order_id").alias("frequency"),
            total_or_zero("total_value").alias("monetary"),
        )
        .withColumn("recency", elapsed_days(snapshot, F.col("last_purchase")))
        .drop("last_purchase")
    )
    scored = assign_buckets(
        customers,
        "customer_id",
        {name: Score(column, 4, ends=qcut_ends) for name, column in
         (("_recent", "recency"), ("F", "frequency"), ("M", "monetary"))},
    )
    scored = scored.withColumn("R", 5 - F.col("_recent"))
    r, f, m = F.col("R"), F.col("F"), F.col("M")
    champion, loyal, at_risk, hibernating, new, one_time = SEGMENTS
    segment = (
        F.when((r >= 3) & (f >= 3) & (m >= 3), champion)
        .when((r >= 3) & (f >= 2), loyal)
        .when((r <= 2) & (f >= 2), at_risk)
        .when((r == 1) & (f == 1), hibernating)
        .when(F.col("frequency") == 1, new)
        .otherwise(one_time)
    )
    return scored.select(
        "customer_id", "recency", "frequency", "monetary", "R", "F", "M", (r + f + m).alias("rfm_score"),
        segment.alias("segment"),
    )


def rfm_segments(orders: DataFrame) -> DataFrame:
    return (
        rfm_scores(orders)
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"), rounded(mean("monetary"), 6).alias("mean_spend"))
        .orderBy(F.desc("customers"), "segment")
    )


# --- marketing --------------------------------------------------------------------------


def lead_outcomes(raw_leads: DataFrame, raw_deals: DataFrame) -> DataFrame:
    won = raw_deals.select("mql_id", "seller_id")
    return raw_leads.select("mql_id", "origin").join(won, "mql_id", "left").withColumn(
        "converted", F.col("seller_id").isNotNull()
    )


def channel_conversion(raw_leads: DataFrame, raw_deals: DataFrame) -> DataFrame:
    won = F.count_if("converted")
    leads = F.count("mql_id")
    return (
        lead_outcomes(raw_leads, raw_deals)
        .where(F.col("origin").isNotNull())
        .groupBy("origin")
        .agg(leads.alias("leads"), won.alias("converted"), share(won, leads).alias("conversion_rate"))
        .orderBy("conversion_rate", "origin")
    )


def overall_conversion(raw_leads: DataFrame, raw_deals: DataFrame) -> DataFrame:
    won = F.count_if("converted")
    return lead_outcomes(raw_leads, raw_deals).agg(
        F.count(F.lit(1)).alias("leads"),
        won.alias("converted"),
        share(won, F.count(F.lit(1))).alias("conversion_rate"),
    )


# --- categories, delivery, sellers, states, payments ------------------------------------


def top_categories(
    raw_items: DataFrame, raw_products: DataFrame, translation: DataFrame, top: int = 12
) -> DataFrame:
    names = raw_products.select("product_id", "product_category_name").join(
        translation.select("product_category_name", F.col("product_category_name_english").alias("english")),
        "product_category_name",
        "left",
    )
    return (
        raw_items.select("order_id", "product_id", money("price").alias("price"))
        .join(names.select("product_id", "english"), "product_id", "left")
        .groupBy(F.coalesce("english", F.lit("unknown")).alias("category"))
        .agg(total_or_zero("price").alias("revenue"), F.countDistinct("order_id").alias("orders"))
        .orderBy(F.desc("revenue"), "category")
        .limit(top)
    )


def timed_deliveries(orders: DataFrame) -> DataFrame:
    return delivered_only(orders).dropna(subset=["delivery_days"])


def delivery_histogram(orders: DataFrame, bins: int = 40, longest: int = 60) -> DataFrame:
    days = timed_deliveries(orders).select(clipped(F.col("delivery_days"), 0, longest).alias("days"))
    return histogram(days, "days", bins)


def delivery_summary(orders: DataFrame) -> DataFrame:
    on_time = F.count_if(~F.col("is_late"))
    return timed_deliveries(orders).agg(
        F.median("delivery_days").alias("median_days"),  # whole days: a small set of distinct values
        share(on_time, F.count(F.lit(1))).alias("on_time_pct"),
        rounded(mean("delivery_days"), 6).alias("avg_delivery_days"),
    )


def late_rate_by_state(orders: DataFrame, top: int = 10) -> DataFrame:
    return (
        timed_deliveries(orders)
        .where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(rounded(ratio(F.count_if("is_late"), F.count(F.lit(1))), 6).alias("late_rate"))
        .orderBy(F.desc("late_rate"), "customer_state")
        .limit(top)
    )


def seller_lorenz(raw_items: DataFrame) -> DataFrame:
    """Sellers by revenue with cumulative share, position percentile and concentration tier."""
    revenue = (
        raw_items.where(F.col("seller_id").isNotNull())
        .groupBy("seller_id")
        .agg(F.coalesce(F.sum(money("price")), F.lit(0)).alias("revenue"), F.countDistinct("order_id").alias("orders"))
    )
    walked = running_totals(revenue, [F.col("revenue").desc(), F.col("seller_id").asc()], sums=["revenue"])
    position = ratio(F.col("row_no"), F.col("group_rows"))
    tier = F.lit(CONCENTRATION_TIERS[-1][0])
    for name, limit in reversed(CONCENTRATION_TIERS[:-1]):
        tier = F.when(position <= limit, name).otherwise(tier)
    return walked.select(
        "seller_id",
        "revenue",
        "orders",
        share(F.col("running_revenue"), F.col("total_revenue")).alias("cum_pct"),
        rounded(position * 100, 6).alias("seller_pct"),
        tier.alias("tier"),
        "total_revenue",
    )


def seller_tiers(raw_items: DataFrame) -> DataFrame:
    return (
        seller_lorenz(raw_items)
        .groupBy("tier")
        .agg(
            F.count(F.lit(1)).alias("sellers"),
            F.sum("revenue").alias("revenue"),
            share(F.sum("revenue"), F.max("total_revenue")).alias("revenue_share"),
        )
    )


def state_demand(orders: DataFrame, top: int = 15) -> DataFrame:
    return (
        orders.where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(F.count("order_id").alias("order_count"), rounded(mean("total_value"), 6).alias("avg_value"))
        .orderBy(F.desc("order_count"), "customer_state")
        .limit(top)
    )


def payment_types(raw_payments: DataFrame) -> DataFrame:
    return (
        raw_payments.where(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(F.count("order_id").alias("count"), F.coalesce(F.sum(money("payment_value")), F.lit(0)).alias("value"))
        .orderBy(F.desc("count"), "payment_type")
    )


def installments(raw_payments: DataFrame, payment_type: str = "credit_card") -> DataFrame:
    return (
        raw_payments.where(F.col("payment_type") == payment_type)
        .where(F.col("payment_installments").isNotNull())
        .groupBy(to_int("payment_installments").alias("payment_installments"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("payment_installments")
    )


def business_summary(orders: DataFrame, raw_leads: DataFrame, raw_deals: DataFrame) -> DataFrame:
    """One row: value, orders, review average, punctuality, delivery days, lead conversion."""
    facts = orders.select(
        F.lit("order").alias("kind"), "order_status", "total_value", "review_score", "is_late", "delivery_days"
    )
    leads, deals = (df.select(F.lit(kind).alias("kind")) for df, kind in ((raw_leads, "lead"), (raw_deals, "deal")))
    everything = facts.unionByName(leads, allowMissingColumns=True).unionByName(deals, allowMissingColumns=True)
    delivered = F.coalesce(F.col("order_status") == "delivered", F.lit(False))

    def count_of(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    return everything.agg(
        total_or_zero("total_value").alias("total_gmv"),
        count_of("order").alias("total_orders"),
        F.count_if(delivered).alias("delivered_orders"),
        rounded(mean("total_value"), 6).alias("avg_order_value"),
        rounded(mean("review_score"), 6).alias("avg_review_score"),
        share(F.count_if(delivered & ~F.col("is_late")), F.count_if(delivered)).alias("on_time_pct"),
        rounded(mean(F.when(delivered, F.col("delivery_days"))), 6).alias("avg_delivery_days"),
        share(count_of("deal"), count_of("lead")).alias("lead_conversion_pct"),
    )
