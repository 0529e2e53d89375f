from oracle.sqlkit import avg, div, money, r


def share(a: str, b: str) -> str:
    return r(f"{div(a, b)} * 100", 6)


_ELAPSED = """CAST(floor(date_diff('microsecond', {b}, {a}) / 86400000000.0) AS INT)"""


def elapsed(a: str, b: str) -> str:
    return _ELAPSED.format(a=a, b=b)


FRAGMENTS = {
    "enriched_orders": f"""
        SELECT o.order_id, o.customer_id, order_status, order_purchase_timestamp AS purchased_at,
               {elapsed('order_delivered_customer_date', 'order_purchase_timestamp')} AS delivery_days,
               COALESCE(order_delivered_customer_date > order_estimated_delivery_date, FALSE) AS is_late,
               CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month,
               customer_state, customer_city, total_value, freight, item_count, review_score
        FROM raw_orders o
        LEFT JOIN raw_customers c ON o.customer_id = c.customer_id
        LEFT JOIN (SELECT order_id, SUM({money('price')}) AS total_value, SUM({money('freight_value')}) AS freight,
                          COUNT(order_item_id) AS item_count FROM raw_order_items GROUP BY 1) i ON o.order_id = i.order_id
        LEFT JOIN (SELECT order_id, FIRST(review_score ORDER BY review_creation_date, review_id, review_score) AS review_score
                   FROM raw_order_reviews GROUP BY 1) v ON o.order_id = v.order_id""",
    "monthly_trend": """
        SELECT month, COALESCE(SUM(total_value), 0) AS revenue, COUNT(order_id) AS orders
        FROM enriched_orders WHERE order_status = 'delivered' GROUP BY 1""",
    "rfm_customers": f"""
        SELECT customer_id, {elapsed("(SELECT MAX(purchased_at) FROM enriched_orders) + INTERVAL 1 DAY", "MAX(purchased_at)")} AS recency,
               COUNT(order_id) AS frequency, COALESCE(SUM(total_value), 0) AS monetary
        FROM enriched_orders WHERE order_status = 'delivered' GROUP BY 1""",
    "rfm_ranked": """
        SELECT *, COUNT(*) OVER () AS n, ROW_NUMBER() OVER (ORDER BY recency, customer_id) AS rr,
               ROW_NUMBER() OVER (ORDER BY frequency, customer_id) AS rf,
               ROW_NUMBER() OVER (ORDER BY monetary, customer_id) AS rm
        FROM rfm_customers""",
    "rfm_bucketed": """
        SELECT customer_id, recency, frequency, monetary,
               CAST(5 - GREATEST(1, ceil((rr - 1) * 4 / (n - 1))) AS INT) AS r4,
               CAST(GREATEST(1, ceil((rf - 1) * 4 / (n - 1))) AS INT) AS f4,
               CAST(GREATEST(1, ceil((rm - 1) * 4 / (n - 1))) AS INT) AS m4
        FROM rfm_ranked""",
    "rfm_scores": """
        SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary, r4 AS "R", f4 AS "F", m4 AS "M",
               CAST(r4 + f4 + m4 AS INT) AS rfm_score,
               CASE WHEN r4 >= 3 AND f4 >= 3 AND m4 >= 3 THEN 'Champion' WHEN r4 >= 3 AND f4 >= 2 THEN 'Loyal'
                    WHEN r4 <= 2 AND f4 >= 2 THEN 'At Risk' WHEN r4 = 1 AND f4 = 1 THEN 'Hibernating'
                    WHEN frequency = 1 THEN 'New' ELSE 'One-Time Buyer' END AS segment
        FROM rfm_bucketed""",
    "lead_outcomes": """
        SELECT m.mql_id, origin, d.seller_id IS NOT NULL AS converted
        FROM raw_marketing_qualified_leads m LEFT JOIN raw_closed_deals d ON m.mql_id = d.mql_id""",
    "timed_deliveries": "SELECT * FROM enriched_orders WHERE order_status = 'delivered' AND delivery_days IS NOT NULL",
    "clipped_days": "SELECT CAST(LEAST(GREATEST(delivery_days, 0), 60) AS DOUBLE) AS v FROM timed_deliveries",
    "days_span": "SELECT MIN(v) AS low, (MAX(v) - MIN(v)) / 40 AS width FROM clipped_days",
    "seller_revenue": f"""
        SELECT seller_id, SUM({money('price')}) AS revenue, COUNT(DISTINCT order_id) AS orders
        FROM raw_order_items GROUP BY 1""",
    "seller_curve": """
        SELECT *, SUM(revenue) OVER (ORDER BY revenue DESC, seller_id ROWS UNBOUNDED PRECEDING) AS running,
               SUM(revenue) OVER () AS total, ROW_NUMBER() OVER (ORDER BY revenue DESC, seller_id) AS rn,
               COUNT(*) OVER () AS n
        FROM seller_revenue""",
    "seller_lorenz": f"""
        SELECT seller_id, CAST(revenue AS DOUBLE) AS revenue, orders, {share('running', 'total')} AS cum_pct,
               {r(div('rn', 'n') + ' * 100', 6)} AS seller_pct,
               CASE WHEN {div('rn', 'n')} <= 0.05::DOUBLE THEN 'Top 5%'
                    WHEN {div('rn', 'n')} <= 0.20::DOUBLE THEN 'Mid 6-20%' ELSE 'Long Tail' END AS tier,
               CAST(total AS DOUBLE) AS total_revenue
        FROM seller_curve""",
}

BODIES = {
    "report_enriched_orders": """
        SELECT * REPLACE (CAST(total_value AS DOUBLE) AS total_value, CAST(freight AS DOUBLE) AS freight) FROM enriched_orders""",
    "report_monthly_trend": "SELECT month, CAST(revenue AS DOUBLE) AS revenue, orders FROM monthly_trend",
    "report_peak_month": """
        SELECT month, CAST(revenue AS DOUBLE) AS revenue FROM monthly_trend ORDER BY monthly_trend.revenue DESC, month LIMIT 1""",
    "rfm_qcut_scores": "SELECT * FROM rfm_scores",
    "report_rfm_segments": f"""
        SELECT segment, COUNT(*) AS customers,
               {r(div('SUM(CAST(monetary AS DECIMAL(18,2)))', 'COUNT(*)'), 6)} AS mean_spend FROM rfm_scores GROUP BY 1""",
    "report_channel_conversion": f"""
        SELECT origin, COUNT(mql_id) AS leads, COUNT(*) FILTER (WHERE converted) AS converted,
               {share('COUNT(*) FILTER (WHERE converted)', 'COUNT(mql_id)')} AS conversion_rate
        FROM lead_outcomes WHERE origin IS NOT NULL GROUP BY 1""",
    "report_overall_conversion": f"""
        SELECT COUNT(*) AS leads, COUNT(*) FILTER (WHERE converted) AS converted,
               {share('COUNT(*) FILTER (WHERE converted)', 'COUNT(*)')} AS conversion_rate FROM lead_outcomes""",
    "report_top_categories": f"""
        SELECT COALESCE(product_category_name_english, 'unknown') AS category,
               CAST(SUM({money('price')}) AS DOUBLE) AS revenue, COUNT(DISTINCT order_id) AS orders
        FROM raw_order_items i LEFT JOIN raw_products p ON i.product_id = p.product_id
        LEFT JOIN raw_category_translation t ON p.product_category_name = t.product_category_name
        GROUP BY 1 ORDER BY revenue DESC, category LIMIT 12""",
    "report_delivery_histogram": """
        SELECT CAST(b.bin AS INT) AS bin, low + b.bin * width AS bin_start, low + (b.bin + 1) * width AS bin_end,
               (SELECT COUNT(*) FROM clipped_days, days_span s
                WHERE LEAST(CAST(floor((v - s.low) / s.width) AS INT), 39) = b.bin) AS n
        FROM range(40) b(bin), days_span""",
    "report_delivery_summary": f"""
        SELECT CAST(median(delivery_days) AS DOUBLE) AS median_days,
               {share('COUNT(*) FILTER (WHERE NOT is_late)', 'COUNT(*)')} AS on_time_pct,
               {r(avg('delivery_days'), 6)} AS avg_delivery_days FROM timed_deliveries""",
    "report_late_rate_by_state": f"""
        SELECT customer_state, {r(div('COUNT(*) FILTER (WHERE is_late)', 'COUNT(*)'), 6)} AS late_rate
        FROM timed_deliveries GROUP BY 1 ORDER BY late_rate DESC, customer_state LIMIT 10""",
    "report_seller_lorenz": "SELECT * FROM seller_lorenz",
    "report_seller_tiers": f"""
        SELECT tier, COUNT(*) AS sellers, CAST(SUM(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
               {share('SUM(CAST(revenue AS DECIMAL(18,2)))', 'MAX(total_revenue)')} AS revenue_share
        FROM seller_lorenz GROUP BY 1""",
    "report_state_demand": f"""
        SELECT customer_state, COUNT(order_id) AS order_count, {r(avg('total_value'), 6)} AS avg_value
        FROM enriched_orders GROUP BY 1 ORDER BY order_count DESC, customer_state LIMIT 15""",
    "report_payment_types": f"""
        SELECT payment_type, COUNT(order_id) AS count, CAST(SUM({money('payment_value')}) AS DOUBLE) AS value
        FROM raw_order_payments GROUP BY 1""",
    "report_installments": """
        SELECT payment_installments, COUNT(*) AS count FROM raw_order_payments
        WHERE payment_type = 'credit_card' GROUP BY 1""",
    "report_business_summary": f"""
        SELECT CAST(SUM(total_value) AS DOUBLE) AS total_gmv, COUNT(*) AS total_orders,
               COUNT(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
               {r(avg('total_value'), 6)} AS avg_order_value, {r(avg('review_score'), 6)} AS avg_review_score,
               {share("COUNT(*) FILTER (WHERE order_status = 'delivered' AND NOT is_late)", "COUNT(*) FILTER (WHERE order_status = 'delivered')")} AS on_time_pct,
               {r(avg("CASE WHEN order_status = 'delivered' THEN delivery_days END"), 6)} AS avg_delivery_days,
               {share('(SELECT COUNT(*) FROM raw_closed_deals)', '(SELECT COUNT(*) FROM raw_marketing_qualified_leads)')} AS lead_conversion_pct
        FROM enriched_orders""",
}
