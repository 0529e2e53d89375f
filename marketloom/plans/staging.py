"""Staging: raw tables to typed, cleaned frames, one function per table.

Money columns are DECIMAL(18,2). ``stamp=True`` adds the load time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import (
    as_timestamp,
    day_of,
    days_between,
    lower_trim,
    money,
    money_sum,
    rounded,
    title_words,
    to_float,
    to_int,
    upper_trim,
    zero_filled,
)
from marketloom.functions.labels import BOX, STATES, UNDEFINED_PAYMENT, ZONES
from marketloom.operators.summaries import approx_quantile, exact_quantiles, top_values


def stamped(df: DataFrame, stamp: bool, name: str = "_stg_loaded_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp()) if stamp else df


def present(*columns: str) -> Column:
    """All columns are set; written as single tests, so that they reach the file scan."""
    test = F.col(columns[0]).isNotNull()
    for c in columns[1:]:
        test = test & F.col(c).isNotNull()
    return test


def states(spark: SparkSession) -> DataFrame:
    """The constant state table: code, name, region, frontier flag, population."""
    names = ("state_code", "state_name", "region", "is_frontier_market", "state_population")
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in STATES])
    return spark.range(1).select(F.inline(rows)).withColumn(
        "state_population", F.col("state_population").cast("bigint")
    )


def order_timeline(raw: DataFrame) -> DataFrame:
    """Order dates and delivery measures of every raw order row."""
    bought = day_of("order_purchase_timestamp")
    delivered = as_timestamp("order_delivered_customer_date")
    promised = as_timestamp("order_estimated_delivery_date")
    known = F.col("order_delivered_customer_date").isNotNull()
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        bought.alias("purchase_date"),
        day_of("order_approved_at").alias("approved_date"),
        day_of("order_delivered_carrier_date").alias("carrier_pickup_date"),
        delivered.cast("date").alias("delivered_date"),
        promised.cast("date").alias("estimated_delivery_date"),
        days_between(delivered.cast("date"), bought).alias("delivery_days"),
        days_between(promised.cast("date"), bought).alias("estimated_delivery_days"),
        # Times are compared, not days: late by hours on the promised day is late.
        F.when(known, F.coalesce(delivered <= promised, F.lit(False))).alias("is_on_time"),
        F.coalesce(delivered > promised, F.lit(False)).alias("is_late"),
    )


def stg_orders(raw: DataFrame, stamp: bool = False) -> DataFrame:
    return stamped(order_timeline(raw.where(present("order_id", "customer_id"))), stamp)


def stg_order_items(raw: DataFrame, stamp: bool = False) -> DataFrame:
    out = raw.where(present("order_id", "product_id", "seller_id")).select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        day_of("shipping_limit_date").alias("shipping_limit_date"),
        money("price").alias("item_price"),
        money("freight_value").alias("freight_value"),
        money_sum("price", "freight_value").alias("item_total"),
    )
    return stamped(out, stamp)


def stg_customers(raw: DataFrame, stamp: bool = False) -> DataFrame:
    out = raw.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").cast("bigint").alias("zip_code_prefix"),
        lower_trim("customer_city").alias("customer_city"),
        upper_trim("customer_state").alias("customer_state"),
    )
    return stamped(out, stamp)


def stg_products(raw: DataFrame, translation: DataFrame, stamp: bool = False) -> DataFrame:
    whole = {
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
        "product_photos_qty": "product_photos_qty",
    }
    sizes = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
    english = translation.select("product_category_name", "product_category_name_english")
    out = raw.join(english, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        F.coalesce("product_category_name_english", "product_category_name", F.lit("Unknown")).alias(
            "category_english"
        ),
        *[to_int(source).alias(name) for source, name in whole.items()],
        *[to_float(name).alias(name) for name in sizes],
    )
    return stamped(out, stamp)


def stg_sellers(raw: DataFrame, stamp: bool = False) -> DataFrame:
    out = raw.where(F.col("seller_id").isNotNull()).select(
        "seller_id",
        F.col("seller_zip_code_prefix").cast("bigint").alias("zip_code_prefix"),
        lower_trim("seller_city").alias("seller_city"),
        upper_trim("seller_state").alias("seller_state"),
    )
    return stamped(out, stamp)


def stg_payments(raw: DataFrame, stamp: bool = False) -> DataFrame:
    defined = F.col("payment_type") != UNDEFINED_PAYMENT  # also drops a missing type
    out = raw.where(defined & F.col("order_id").isNotNull()).select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        money("payment_value").alias("payment_value"),
    )
    return stamped(out, stamp)


def stg_reviews(raw: DataFrame, stamp: bool = False) -> DataFrame:
    out = raw.where(present("review_id", "order_id")).select(
        "review_id",
        "order_id",
        to_int("review_score").alias("review_score"),
        F.col("review_creation_date").try_cast("date").alias("review_creation_date"),
        F.col("review_answer_timestamp").try_cast("date").alias("review_answer_date"),
    )
    return stamped(out, stamp)


def stg_marketing_leads(leads: DataFrame, deals: DataFrame, stamp: bool = False) -> DataFrame:
    deal_columns = ("seller_id", "won_date", "business_segment", "lead_type", "lead_behaviour_profile",
                    "business_type", "declared_monthly_revenue")
    out = (
        leads.where(F.col("mql_id").isNotNull())
        .join(deals.select("mql_id", *deal_columns), "mql_id", "left")
        .select(
            "mql_id",
            "landing_page_id",
            "origin",
            day_of("first_contact_date").alias("first_contact_date"),
            "seller_id",
            day_of("won_date").alias("won_date"),
            *deal_columns[2:6],
            F.coalesce(money("declared_monthly_revenue"), F.lit(0).cast("decimal(18,2)")).alias(
                "declared_monthly_revenue"
            ),
            F.col("seller_id").isNotNull().alias("is_converted"),
        )
    )
    return stamped(out, stamp)


# --- geolocation ----------------------------------------------------------------------


def in_box(lat: Column, lng: Column, box: Sequence[float] = BOX) -> Column:
    return lat.between(box[0], box[1]) & lng.between(box[2], box[3])


def zone_of(lat: Column, lng: Column) -> Column:
    """Zone by coordinates; the order of the rules matters."""
    coastal, amazon, plateau, south = ZONES
    return (
        F.when((lat < -15) & (lng > -50), coastal)
        .when(lat > -5, amazon)
        .when(lat >= -15, plateau)
        .otherwise(south)
    )


def clean_geolocation(raw: DataFrame, box: Sequence[float] = BOX) -> DataFrame:
    """Typed points inside the box, with normalised city and state."""
    return raw.where(
        F.col("geolocation_zip_code_prefix").isNotNull()
        & in_box(F.col("geolocation_lat"), F.col("geolocation_lng"), box)
    ).select(
        F.col("geolocation_zip_code_prefix").cast("bigint").alias("zip_code_prefix"),
        F.col("geolocation_lat").alias("lat"),
        F.col("geolocation_lng").alias("lng"),
        lower_trim("geolocation_city").alias("city"),
        upper_trim("geolocation_state").alias("state_code"),
    )


def zip_summary(points: DataFrame, exact: bool = False) -> DataFrame:
    """One row per zip: median point, most frequent city and state, source row count."""
    key = ["zip_code_prefix"]
    tops = top_values(points, key, ["city", "state_code"], count_nulls=not exact)
    if not exact:
        middle = points.groupBy(*key).agg(
            approx_quantile("lat", 0.5).alias("latitude"),
            approx_quantile("lng", 0.5).alias("longitude"),
            F.count(F.lit(1)).alias("raw_row_count"),
        )
        # Both have the same zips. By a left join the points are read for the middle only where that is used.
        found = tops.where(F.col(key[0]).isNotNull()).join(middle, key, "left")
        return found.select(*key, "latitude", "longitude", "raw_row_count", "city", "state_code")
    counts = points.groupBy(*key).agg(F.count("lat").alias("source_row_count"))
    lat = exact_quantiles(points, key, "lat", {"latitude": 0.5})
    lng = exact_quantiles(points, key, "lng", {"longitude": 0.5})
    return counts.join(lat, key).join(lng, key).join(tops, key, "left")


def stg_geolocation(
    raw: DataFrame,
    state_table: DataFrame,
    box: Sequence[float] = BOX,
    default_region: str = "North",
    stamp: bool = False,
) -> DataFrame:
    """Points of known states inside the box, reduced to one enriched row per zip."""
    known = clean_geolocation(raw, box).join(state_table.select("state_code"), "state_code", "left_semi")
    zips = zip_summary(known)
    out = zips.join(state_table.drop("state_population"), "state_code", "left").select(
        "zip_code_prefix",
        zero_filled(F.col("zip_code_prefix"), 5).alias("zip_code_formatted"),
        rounded(F.col("latitude"), 6).alias("latitude"),
        rounded(F.col("longitude"), 6).alias("longitude"),
        title_words(F.col("city"), "-").alias("city"),
        F.col("city").alias("city_normalized"),
        "state_code",
        F.coalesce("state_name", F.lit("Unknown")).alias("state_name"),
        F.coalesce("region", F.lit(default_region)).alias("region"),
        F.coalesce("is_frontier_market", F.lit(True)).alias("high_ecomm_penetration"),
        zone_of(F.col("latitude"), F.col("longitude")).alias("geographic_zone"),
        "raw_row_count",
    )
    return stamped(out, stamp, "_dbt_loaded_at")


def stg_geolocation_exact(
    raw: DataFrame,
    state_table: DataFrame,
    box: Sequence[float] = BOX,
    default_region: str = "Unknown",
    stamp: bool = False,
) -> DataFrame:
    """Loader variant: exact medians and modes, any state code, unknown ones labelled."""
    points = clean_geolocation(
        raw.withColumn("geolocation_zip_code_prefix", to_int("geolocation_zip_code_prefix")), box
    )
    lat, lng = F.col("latitude"), F.col("longitude")
    out = zip_summary(points, exact=True).join(state_table.drop("state_population"), "state_code", "left").select(
        "zip_code_prefix",
        "latitude",
        "longitude",
        "city",
        "state_code",
        "source_row_count",
        F.coalesce("state_name", F.lit("Unknown")).alias("state_name"),
        F.coalesce("region", F.lit(default_region)).alias("region"),
        F.coalesce("is_frontier_market", F.lit(True)).alias("is_frontier_market"),
        zone_of(lat, lng).alias("geographic_zone"),
        zero_filled(F.col("zip_code_prefix"), 5).alias("zip_code_formatted"),
    )
    return stamped(out, stamp, "dw_inserted_at")
