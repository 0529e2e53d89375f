"""Raw marketplace tables from the generated tables, as SQL."""

_PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
_TOTAL = "CAST(o_totalprice AS DECIMAL(18,2))"
_FIRST = f"CAST(CASE WHEN o_orderkey % 5 = 0 THEN ROUND({_TOTAL} * 0.70, 2) ELSE {_TOTAL} END AS DECIMAL(18,2))"

FRAGMENTS = {
    "raw_orders": """
        SELECT order_id, customer_id, order_status,
               bought AS order_purchase_timestamp,
               bought + INTERVAL 1 DAY AS order_approved_at,
               bought + INTERVAL 2 DAY AS order_delivered_carrier_date,
               CASE WHEN order_status = 'delivered' THEN bought + INTERVAL 12 HOUR
                    + to_days(CAST(CASE WHEN order_id % 13 = 0 THEN order_id % 60 ELSE 1 + order_id % 14 END AS INT))
               END AS order_delivered_customer_date,
               bought + to_days(CAST(15 + order_id % 11 AS INT)) AS order_estimated_delivery_date
        FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS bought,
                     CASE WHEN o_orderkey % 50 = 0 THEN 'canceled' WHEN o_orderkey % 97 = 0 THEN 'unavailable'
                          WHEN o_orderstatus IN ('F', 'P') THEN 'delivered' ELSE 'shipped' END AS order_status
              FROM orders)""",
    "raw_order_items": f"""
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               ROUND({_PRICE} * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS price,
               ROUND({_PRICE} * CAST(l_tax AS DECIMAL(4,2)), 2) AS freight_value
        FROM lineitem""",
    "raw_customers": """
        SELECT c_custkey AS customer_id, c_custkey - c_custkey % 2 AS customer_unique_id,
               1001 + c_custkey % 600 AS customer_zip_code_prefix, ' ' || c_mktsegment || ' ' AS customer_city,
               n_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_products": """
        SELECT p_partkey AS product_id, CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS product_category_name,
               CAST(LENGTH(p_name) AS BIGINT) AS product_name_lenght,
               CAST(p_size * 10 AS BIGINT) AS product_description_lenght,
               CAST(p_size % 6 AS BIGINT) AS product_photos_qty, CAST(p_size * 100 AS DOUBLE) AS product_weight_g,
               CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size + 1 AS DOUBLE) AS product_height_cm,
               CAST(p_size + 2 AS DOUBLE) AS product_width_cm
        FROM part""",
    "raw_category_translation": """
        SELECT DISTINCT p_type AS product_category_name, LOWER(p_type) AS product_category_name_english
        FROM part WHERE p_type <> 'LARGE'""",
    "raw_sellers": """
        SELECT s_suppkey AS seller_id, 1001 + s_suppkey % 600 AS seller_zip_code_prefix, s_name AS seller_city,
               n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_order_payments": f"""
        SELECT o_orderkey AS order_id, CAST(1 AS BIGINT) AS payment_sequential,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
                    WHEN '3-MEDIUM' THEN 'debit_card' WHEN '4-NOT SPECIFIED' THEN 'not_defined'
                    ELSE 'voucher' END AS payment_type,
               1 + o_orderkey % 12 AS payment_installments, {_FIRST} AS payment_value
        FROM orders
        UNION ALL
        SELECT o_orderkey, 2, 'voucher', 1 + o_orderkey % 12, CAST({_TOTAL} - {_FIRST} AS DECIMAL(18,2))
        FROM orders WHERE o_orderkey % 5 = 0""",
    "raw_order_reviews": """
        SELECT o_orderkey // 2 AS review_id, o_orderkey AS order_id, score AS review_score,
               CAST(o_orderdate + INTERVAL 20 DAY AS DATE) AS review_creation_date,
               o_orderdate + INTERVAL 22 DAY AS review_answer_timestamp
        FROM (SELECT o_orderkey, o_orderdate, 1 + o_orderkey % 5 AS score FROM orders WHERE o_orderkey % 10 <> 0
              UNION ALL
              SELECT o_orderkey, o_orderdate, 1 + (o_orderkey + 2) % 5 FROM orders WHERE o_orderkey % 7 = 0)""",
    "lead_events": """
        SELECT *, CAST(CAST(ts AS DATE) + CAST(event_id % 12 * 30 AS INT) AS DATE) AS first_contact_date
        FROM events""",
    "raw_marketing_qualified_leads": """
        SELECT event_id AS mql_id, first_contact_date, json_extract_string(props, '$.k') AS landing_page_id,
               CASE WHEN event_id % 133 <> 0 THEN
                   (['paid_search', 'organic_search', 'social', 'email', 'referral', 'direct_traffic'])[user_id % 6 + 1]
               END AS origin
        FROM lead_events""",
    "raw_closed_deals": """
        SELECT event_id AS mql_id, user_id AS seller_id,
               CAST(first_contact_date + CAST(event_id % 45 AS INT) AS TIMESTAMP) AS won_date,
               'seg_' || (user_id % 5) AS business_segment, 'type_' || (event_id % 3) AS lead_type,
               'profile_' || (event_id % 4) AS lead_behaviour_profile, 'business_' || (user_id % 2) AS business_type,
               CASE WHEN event_id % 20 = 0 THEN 'n/a'
                    ELSE CAST(CAST(value AS DECIMAL(18,2)) * 100 AS VARCHAR) END AS declared_monthly_revenue
        FROM lead_events WHERE event_id % (5 + 4 * (user_id % 6)) = 0""",
    "raw_geolocation": """
        SELECT LPAD(CAST(1001 + event_id % 500 AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
               CASE WHEN event_id % 400 = 0 THEN 40.0::DOUBLE
                    ELSE -33.0::DOUBLE + (event_id % 997) * 0.0301::DOUBLE END AS geolocation_lat,
               -70.0::DOUBLE + (event_id % 991) * 0.0411::DOUBLE AS geolocation_lng,
               event_type || '-do campo ' || event_type AS geolocation_city, n_name AS geolocation_state
        FROM events JOIN nation ON event_id % 500 % 25 = n_nationkey""",
    "state_meta": """
        SELECT n_name AS state_code, n_name AS state_name, r_name AS region,
               n_nationkey % 3 <> 0 AS is_frontier_market, CAST((n_nationkey + 1) * 1000000 AS BIGINT) AS state_population
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
}
