"""Raw marketplace tables derived from the generated star-schema test tables.

Each function takes the folder of one scale factor and returns a lazy frame with the raw
schema of that table; all rows come from the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END_DATE = "2001-12-31"  # last day of the generated order dates, instead of the default end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_status = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        """CASE WHEN o_orderkey % 50 = 0 THEN 'canceled'
                WHEN o_orderkey % 97 = 0 THEN 'unavailable'
                WHEN o_orderstatus IN ('F', 'P') THEN 'delivered'
                ELSE 'shipped' END AS order_status""",
        "CAST(o_orderdate AS timestamp_ntz) AS bought",
    )
    return with_status.selectExpr(
        "order_id",
        "customer_id",
        "order_status",
        "bought AS order_purchase_timestamp",
        "bought + INTERVAL 1 DAY AS order_approved_at",
        "bought + INTERVAL 2 DAY AS order_delivered_carrier_date",
        """CASE WHEN order_status = 'delivered' THEN bought + make_dt_interval(
               CAST(IF(order_id % 13 = 0, order_id % 60, 1 + order_id % 14) AS INT), 12) END
           AS order_delivered_customer_date""",
        "bought + make_dt_interval(CAST(15 + order_id % 11 AS INT)) AS order_estimated_delivery_date",
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = "CAST(l_extendedprice AS DECIMAL(18,2))"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "CAST(l_linenumber AS BIGINT) AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "CAST(l_shipdate AS timestamp_ntz) AS shipping_limit_date",
        f"round({price} * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS price",
        f"round({price} * CAST(l_tax AS DECIMAL(4,2)), 2) AS freight_value",
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "c_custkey AS customer_id",
            "c_custkey - c_custkey % 2 AS customer_unique_id",
            "1001 + c_custkey % 600 AS customer_zip_code_prefix",
            "concat(' ', c_mktsegment, ' ') AS customer_city",
            "n_name AS customer_state",
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS product_category_name",
        "CAST(length(p_name) AS BIGINT) AS product_name_lenght",
        "CAST(p_size * 10 AS BIGINT) AS product_description_lenght",
        "CAST(p_size % 6 AS BIGINT) AS product_photos_qty",
        "CAST(p_size * 100 AS DOUBLE) AS product_weight_g",
        "CAST(p_size AS DOUBLE) AS product_length_cm",
        "CAST(p_size + 1 AS DOUBLE) AS product_height_cm",
        "CAST(p_size + 2 AS DOUBLE) AS product_width_cm",
    )


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-case names for every product type but LARGE, which keeps its native name."""
    return (
        table(spark, sf_dir, "part")
        .where("p_type <> 'LARGE'")
        .selectExpr("p_type AS product_category_name", "lower(p_type) AS product_category_name_english")
        .distinct()
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "s_suppkey AS seller_id",
            "1001 + s_suppkey % 600 AS seller_zip_code_prefix",
            "s_name AS seller_city",
            "n_name AS seller_state",
        )
    )


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = "CAST(o_totalprice AS DECIMAL(18,2))"
    first = f"IF(o_orderkey % 5 = 0, round({total} * 0.70, 2), CAST({total} AS DECIMAL(20,2)))"
    kind = """CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
              WHEN '3-MEDIUM' THEN 'debit_card' WHEN '4-NOT SPECIFIED' THEN 'not_defined'
              ELSE 'voucher' END"""
    lines = f"""filter(array(
        named_struct('seq', 1L, 'kind', {kind}, 'paid', CAST({first} AS DECIMAL(18,2))),
        named_struct('seq', 2L, 'kind', 'voucher', 'paid', CAST({total} - {first} AS DECIMAL(18,2)))
    ), x -> x.seq = 1 OR o_orderkey % 5 = 0)"""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey", f"explode({lines}) AS line")
        .selectExpr(
            "o_orderkey AS order_id",
            "line.seq AS payment_sequential",
            "line.kind AS payment_type",
            "1 + o_orderkey % 12 AS payment_installments",
            "line.paid AS payment_value",
        )
    )


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = """filter(array(
        IF(o_orderkey % 10 <> 0, 1 + o_orderkey % 5, NULL),
        IF(o_orderkey % 7 = 0, 1 + (o_orderkey + 2) % 5, NULL)
    ), x -> x IS NOT NULL)"""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey", "CAST(o_orderdate AS timestamp_ntz) AS bought", f"explode({scores}) AS score")
        .selectExpr(
            "o_orderkey div 2 AS review_id",
            "o_orderkey AS order_id",
            "score AS review_score",
            "CAST(bought + INTERVAL 20 DAY AS DATE) AS review_creation_date",
            "bought + INTERVAL 22 DAY AS review_answer_timestamp",
        )
    )


_CHANNELS = "array('paid_search', 'organic_search', 'social', 'email', 'referral', 'direct_traffic')"


def _lead_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .withColumn("first_contact_date", F.expr("date_add(CAST(ts AS DATE), CAST(event_id % 12 * 30 AS INT))"))
    )


def raw_marketing_qualified_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lead_events(spark, sf_dir).selectExpr(
        "event_id AS mql_id",
        "first_contact_date",
        "get_json_object(props, '$.k') AS landing_page_id",
        f"CASE WHEN event_id % 133 <> 0 THEN element_at({_CHANNELS}, CAST(user_id % 6 AS INT) + 1) END AS origin",
    )


def raw_closed_deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _lead_events(spark, sf_dir)
        .where("event_id % (5 + 4 * (user_id % 6)) = 0")
        .selectExpr(
            "event_id AS mql_id",
            "user_id AS seller_id",
            "CAST(date_add(first_contact_date, CAST(event_id % 45 AS INT)) AS timestamp_ntz) AS won_date",
            "concat('seg_', user_id % 5) AS business_segment",
            "concat('type_', event_id % 3) AS lead_type",
            "concat('profile_', event_id % 4) AS lead_behaviour_profile",
            "concat('business_', user_id % 2) AS business_type",
            """IF(event_id % 20 = 0, 'n/a',
                  CAST(CAST(value AS DECIMAL(18,2)) * 100 AS STRING)) AS declared_monthly_revenue""",
        )
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "events")
        .join(nation, F.expr("event_id % 500 % 25 = n_nationkey"))
        .selectExpr(
            "lpad(CAST(1001 + event_id % 500 AS STRING), 5, '0') AS geolocation_zip_code_prefix",
            "IF(event_id % 400 = 0, 40.0D, -33.0D + (event_id % 997) * 0.0301D) AS geolocation_lat",
            "-70.0D + (event_id % 991) * 0.0411D AS geolocation_lng",
            "concat(event_type, '-do campo ', event_type) AS geolocation_city",
            "n_name AS geolocation_state",
        )
    )


def state_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "n_name AS state_code",
            "n_name AS state_name",
            "r_name AS region",
            "n_nationkey % 3 <> 0 AS is_frontier_market",
            "CAST((n_nationkey + 1) * 1000000 AS BIGINT) AS state_population",
        )
    )
