from oracle.sqlkit import money, r, titled, top

_BOX = "geolocation_lat BETWEEN -35.0 AND 5.3 AND geolocation_lng BETWEEN -74.0 AND -28.0"
ZONE = """CASE WHEN latitude < -15 AND longitude > -50 THEN 'Coastal' WHEN latitude > -5 THEN 'Amazon Basin'
          WHEN latitude BETWEEN -15 AND -5 THEN 'Central Plateau' ELSE 'Southern Cone' END"""


def _points(extra: str) -> str:
    return f"""
        SELECT CAST(geolocation_zip_code_prefix AS BIGINT) AS zip_code_prefix, geolocation_lat AS lat,
               geolocation_lng AS lng, LOWER(TRIM(geolocation_city)) AS city,
               UPPER(TRIM(geolocation_state)) AS state_code
        FROM raw_geolocation WHERE geolocation_zip_code_prefix IS NOT NULL AND {_BOX} {extra}"""


def _zips(points: str, lat: str, lng: str, count: str, count_nulls: bool) -> str:
    return f"""
        SELECT m.*, c.city, s.state_code
        FROM (SELECT zip_code_prefix, {lat} AS latitude, {lng} AS longitude, COUNT(*) AS {count}
              FROM {points} GROUP BY zip_code_prefix) m
        LEFT JOIN ({top(points, 'zip_code_prefix', 'city', 'city', count_nulls)}) c USING (zip_code_prefix)
        LEFT JOIN ({top(points, 'zip_code_prefix', 'state_code', 'state_code', count_nulls)}) s USING (zip_code_prefix)"""


FRAGMENTS = {
    "stg_orders": """
        SELECT order_id, customer_id, order_status,
               CAST(order_purchase_timestamp AS DATE) AS purchase_date,
               CAST(order_approved_at AS DATE) AS approved_date,
               CAST(order_delivered_carrier_date AS DATE) AS carrier_pickup_date,
               CAST(order_delivered_customer_date AS DATE) AS delivered_date,
               CAST(order_estimated_delivery_date AS DATE) AS estimated_delivery_date,
               CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_delivered_customer_date AS DATE)) AS INT) AS delivery_days,
               CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_estimated_delivery_date AS DATE)) AS INT) AS estimated_delivery_days,
               CASE WHEN order_delivered_customer_date IS NULL THEN NULL
                    WHEN order_delivered_customer_date <= order_estimated_delivery_date THEN TRUE ELSE FALSE END AS is_on_time,
               COALESCE(order_delivered_customer_date > order_estimated_delivery_date, FALSE) AS is_late
        FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL""",
    "stg_order_items": f"""
        SELECT order_id, order_item_id, product_id, seller_id, CAST(shipping_limit_date AS DATE) AS shipping_limit_date,
               {money('price')} AS item_price, {money('freight_value')} AS freight_value,
               {money('price + freight_value')} AS item_total
        FROM raw_order_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL""",
    "stg_customers": """
        SELECT customer_id, customer_unique_id, CAST(customer_zip_code_prefix AS BIGINT) AS zip_code_prefix,
               LOWER(TRIM(customer_city)) AS customer_city, UPPER(TRIM(customer_state)) AS customer_state
        FROM raw_customers WHERE customer_id IS NOT NULL""",
    "stg_products": """
        SELECT p.product_id, p.product_category_name,
               COALESCE(t.product_category_name_english, p.product_category_name, 'Unknown') AS category_english,
               product_name_lenght AS product_name_length, product_description_lenght AS product_description_length,
               product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm
        FROM raw_products p LEFT JOIN raw_category_translation t ON p.product_category_name = t.product_category_name""",
    "stg_sellers": """
        SELECT seller_id, CAST(seller_zip_code_prefix AS BIGINT) AS zip_code_prefix,
               LOWER(TRIM(seller_city)) AS seller_city, UPPER(TRIM(seller_state)) AS seller_state
        FROM raw_sellers WHERE seller_id IS NOT NULL""",
    "stg_payments": f"""
        SELECT order_id, payment_sequential, payment_type, payment_installments, {money('payment_value')} AS payment_value
        FROM raw_order_payments WHERE payment_type <> 'not_defined' AND order_id IS NOT NULL""",
    "stg_reviews": """
        SELECT review_id, order_id, review_score, review_creation_date,
               CAST(review_answer_timestamp AS DATE) AS review_answer_date
        FROM raw_order_reviews WHERE review_id IS NOT NULL AND order_id IS NOT NULL""",
    "stg_marketing_leads": f"""
        SELECT m.mql_id, landing_page_id, origin, first_contact_date, seller_id, CAST(won_date AS DATE) AS won_date,
               business_segment, lead_type, lead_behaviour_profile, business_type,
               COALESCE({money('declared_monthly_revenue')}, 0) AS declared_monthly_revenue,
               seller_id IS NOT NULL AS is_converted
        FROM raw_marketing_qualified_leads m LEFT JOIN raw_closed_deals d ON m.mql_id = d.mql_id""",
    "geo_points": _points("AND UPPER(TRIM(geolocation_state)) IN (SELECT state_code FROM state_meta)"),
    "geo_points_any": _points(""),
    "geo_zips": _zips("geo_points", "quantile_disc(lat, 0.5)", "quantile_disc(lng, 0.5)", "raw_row_count", True),
    "geo_zips_any": _zips("geo_points_any", "quantile_disc(lat, 0.5)", "quantile_disc(lng, 0.5)", "raw_row_count", True),
    "geo_zips_exact": _zips("geo_points_any", "median(lat)", "median(lng)", "source_row_count", False),
    "stg_geolocation": f"""
        SELECT zip_code_prefix, LPAD(CAST(zip_code_prefix AS VARCHAR), 5, '0') AS zip_code_formatted,
               {r('latitude', 6)} AS latitude, {r('longitude', 6)} AS longitude,
               {titled("REPLACE(city, '-', ' ')")} AS city,
               city AS city_normalized, z.state_code, COALESCE(state_name, 'Unknown') AS state_name,
               COALESCE(region, 'North') AS region, COALESCE(is_frontier_market, TRUE) AS high_ecomm_penetration,
               {ZONE} AS geographic_zone, raw_row_count
        FROM geo_zips z LEFT JOIN state_meta s ON z.state_code = s.state_code""",
    "stg_geolocation_exact": f"""
        SELECT zip_code_prefix, latitude, longitude, city, z.state_code, source_row_count,
               COALESCE(state_name, 'Unknown') AS state_name, COALESCE(region, 'Unknown') AS region,
               COALESCE(is_frontier_market, TRUE) AS is_frontier_market, {ZONE} AS geographic_zone,
               LPAD(CAST(zip_code_prefix AS VARCHAR), 5, '0') AS zip_code_formatted
        FROM geo_zips_exact z LEFT JOIN state_meta s ON z.state_code = s.state_code""",
}
