from marketloom.functions import labels
from oracle.sqlkit import fingerprint, money, r, titled
from oracle.staging import ZONE

_HOLIDAYS = ", ".join(f"'{day}'" for day in labels.HOLIDAYS)


def _cases(code: str, values: dict[str, object], default: str) -> str:
    """CASE from the library's own table of labels."""
    def literal(value: object) -> str:
        return str(value).upper() if isinstance(value, bool) else f"'{value}'"

    return f"CASE {code} " + " ".join(f"WHEN '{k}' THEN {literal(v)}" for k, v in values.items()) + f" ELSE {default} END"


def _part(table: dict[str, tuple], place: int) -> dict[str, object]:
    return {k: v[place] for k, v in table.items()}


FRAGMENTS = {
    "dim_date": f"""
        SELECT full_date, strftime(full_date, '%Y%m%d') AS date_key, CAST(year(full_date) AS INT) AS year,
               CAST(quarter(full_date) AS INT) AS quarter, CAST(month(full_date) AS INT) AS month,
               strftime(full_date, '%B') AS month_name, strftime(full_date, '%b') AS month_abbr,
               CAST(strftime(full_date, '%U') AS INT) AS week_of_year, CAST(day(full_date) AS INT) AS day_of_month,
               CAST(dayofweek(full_date) + 1 AS INT) AS day_of_week, strftime(full_date, '%A') AS day_name,
               dayofweek(full_date) NOT IN (0, 6) AS is_weekday,
               strftime(full_date, '%m-%d') IN ({_HOLIDAYS}) AS is_public_holiday,
               CAST(date_trunc('month', full_date) AS DATE) AS first_day_of_month,
               CAST(last_day(full_date) AS DATE) AS last_day_of_month,
               CAST(date_trunc('quarter', full_date) AS DATE) AS first_day_of_quarter,
               CAST(make_date(year(full_date), CASE WHEN month(full_date) <= 6 THEN 1 ELSE 7 END, 1) AS DATE) AS first_day_of_half_year,
               'H' || CASE WHEN month(full_date) <= 6 THEN '1' ELSE '2' END || '-' || year(full_date) AS half_year_label,
               (SELECT COUNT(*) FROM stg_orders WHERE purchase_date = full_date) AS orders_placed
        FROM (SELECT CAST(unnest(generate_series((SELECT MIN(purchase_date) FROM stg_orders),
                  (SELECT MAX(purchase_date) FROM stg_orders), INTERVAL 1 DAY)) AS DATE) AS full_date)""",
    "dim_geography": f"""
        SELECT {fingerprint("CAST(zip_code_prefix AS VARCHAR)")} AS geo_key,
               zip_code_prefix, LPAD(CAST(zip_code_prefix AS VARCHAR), 5, '0') AS zip_code_formatted,
               {r('latitude', 6)} AS latitude, {r('longitude', 6)} AS longitude,
               longitude AS point_lon, latitude AS point_lat,
               {titled("REPLACE(city, '-', ' ')")} AS city,
               city AS city_normalized, z.state_code, state_name, region, is_frontier_market,
               {ZONE} AS geographic_zone, raw_row_count
        FROM geo_zips_any z LEFT JOIN state_meta s ON z.state_code = s.state_code""",
    "dim_customer": """
        SELECT customer_id, customer_unique_id, c.zip_code_prefix, customer_city AS city, customer_state AS state_code,
               state_name, region, latitude AS customer_lat, longitude AS customer_lng, geographic_zone, is_frontier_market
        FROM stg_customers c LEFT JOIN dim_geography g ON c.zip_code_prefix = g.zip_code_prefix""",
    "dim_seller": """
        SELECT seller_id, s.zip_code_prefix, seller_city AS city, seller_state AS state_code, state_name, region,
               latitude AS seller_lat, longitude AS seller_lng, geographic_zone
        FROM stg_sellers s LEFT JOIN dim_geography g ON s.zip_code_prefix = g.zip_code_prefix""",
    "dim_product": f"""
        SELECT *, {r('product_length_cm * product_height_cm * product_width_cm / 1000000', 4)} AS volume_litres
        FROM stg_products""",
    "dim_payment_type": f"""
        SELECT ROW_NUMBER() OVER (ORDER BY payment_type) AS payment_type_key, payment_type AS payment_type_code,
               {_cases('payment_type', _part(labels.PAYMENT_LABELS, 0), titled("REPLACE(payment_type, '_', ' ')"))} AS payment_type_name,
               {_cases('payment_type', _part(labels.PAYMENT_LABELS, 1), "'Other'")} AS payment_category,
               {_cases('payment_type', _part(labels.PAYMENT_LABELS, 2), 'FALSE')} AS supports_installments,
               {_cases('payment_type', _part(labels.PAYMENT_LABELS, 3), 'FALSE')} AS is_offline_payment
        FROM (SELECT DISTINCT payment_type FROM raw_order_payments WHERE payment_type <> 'not_defined')""",
    "dim_marketing_channel": f"""
        SELECT ROW_NUMBER() OVER (ORDER BY origin) AS channel_key, origin AS channel_code,
               {_cases('origin', _part(labels.CHANNEL_LABELS, 0), titled("REPLACE(origin, '_', ' ')"))} AS channel_name,
               {_cases('origin', _part(labels.CHANNEL_LABELS, 1), "'Other'")} AS channel_type
        FROM (SELECT DISTINCT origin FROM raw_marketing_qualified_leads WHERE origin IS NOT NULL)""",
    "order_payment_summary": """
        SELECT order_id, SUM(payment_value) AS total_payment_value, MAX(payment_installments) AS max_installments,
               FIRST(payment_type ORDER BY payment_value DESC NULLS LAST, payment_type) AS primary_payment_type
        FROM stg_payments GROUP BY order_id""",
    "order_item_summary": f"""
        SELECT order_id, COUNT(*) AS item_count, SUM({money('price')}) AS product_revenue,
               SUM({money('freight_value')}) AS freight_revenue,
               SUM({money('price')} + {money('freight_value')}) AS total_order_value,
               COUNT(DISTINCT seller_id) AS seller_count, COUNT(DISTINCT product_id) AS distinct_products
        FROM raw_order_items GROUP BY order_id""",
    "order_review": "SELECT order_id, MAX(review_score) AS review_score FROM raw_order_reviews GROUP BY order_id",
    "fact_orders": """
        SELECT o.order_id, o.customer_id, purchase_date, approved_date, carrier_pickup_date AS carrier_date,
               delivered_date, estimated_delivery_date, order_status,
               COALESCE(item_count, 0) AS item_count, COALESCE(distinct_products, 0) AS distinct_products,
               COALESCE(seller_count, 0) AS seller_count,
               COALESCE(product_revenue, 0) AS product_revenue, COALESCE(freight_revenue, 0) AS freight_revenue,
               COALESCE(total_order_value, 0) AS total_order_value,
               COALESCE(total_payment_value, 0) AS total_payment_value,
               COALESCE(max_installments, 1) AS payment_installments, primary_payment_type, review_score,
               delivery_days AS actual_delivery_days, estimated_delivery_days, is_on_time,
               c.state_code AS customer_state, c.region AS customer_region
        FROM stg_orders o LEFT JOIN order_item_summary i ON o.order_id = i.order_id
        LEFT JOIN order_payment_summary p ON o.order_id = p.order_id
        LEFT JOIN order_review v ON o.order_id = v.order_id
        LEFT JOIN dim_customer c ON o.customer_id = c.customer_id""",
    "fact_order_items": """
        SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.item_price,
               i.freight_value, i.item_total, p.category_english AS product_category, p.product_weight_g,
               s.state_code AS seller_state, s.region AS seller_region, o.purchase_date, o.order_status, o.customer_state
        FROM stg_order_items i LEFT JOIN dim_product p ON i.product_id = p.product_id
        LEFT JOIN dim_seller s ON i.seller_id = s.seller_id LEFT JOIN fact_orders o ON i.order_id = o.order_id""",
    "fact_marketing_funnel": """
        SELECT mql_id, landing_page_id, origin AS channel_code, first_contact_date, won_date, seller_id,
               business_segment, lead_type, lead_behaviour_profile, business_type, declared_monthly_revenue,
               is_converted, CAST(date_diff('day', first_contact_date, won_date) AS INT) AS days_to_close
        FROM stg_marketing_leads""",
    "fact_payments": """
        SELECT p.order_id, payment_sequential, payment_type, p.payment_installments, payment_value, purchase_date,
               customer_state, order_status
        FROM stg_payments p LEFT JOIN fact_orders o ON p.order_id = o.order_id""",
}
