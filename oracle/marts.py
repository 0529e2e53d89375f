from oracle.sqlkit import avg, div, pct, r, top

END_DATE = "DATE '2001-12-31'"
VALID = "order_status NOT IN ('canceled', 'unavailable')"
MONTH = "CAST(date_trunc('month', purchase_date) AS DATE)"


def _days(later: str, earlier: str) -> str:
    return f"CAST(date_diff('day', {earlier}, {later}) AS INT)"


def cents(*names: str) -> str:
    return ", ".join(f"{r(n, 2)} AS {n}" for n in names)


FRAGMENTS = {
    "revenue_base": f"""
        SELECT {MONTH} AS revenue_month, category_english AS category, SUM(item_price) AS product_revenue,
               SUM(freight_value) AS freight_revenue, SUM(item_total) AS total_revenue,
               COUNT(DISTINCT i.order_id) AS order_count, COUNT(DISTINCT customer_unique_id) AS unique_customers,
               {avg('item_price')} AS avg_item_price
        FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id
        JOIN stg_products p ON i.product_id = p.product_id JOIN stg_customers c ON o.customer_id = c.customer_id
        WHERE {VALID} GROUP BY 1, 2""",
    "revenue_grown": """
        SELECT *, LAG(total_revenue) OVER (PARTITION BY category ORDER BY revenue_month) AS prev_month_revenue,
               SUM(total_revenue) OVER (PARTITION BY category, year(revenue_month) ORDER BY revenue_month
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ytd_revenue
        FROM revenue_base""",
    "mart_monthly_revenue": f"""
        SELECT revenue_month, CAST(year(revenue_month) AS INT) AS year, CAST(month(revenue_month) AS INT) AS month,
               category, {cents('product_revenue', 'freight_revenue', 'total_revenue')}, order_count, unique_customers,
               {r('avg_item_price', 2)} AS avg_item_price, {r(div('total_revenue', 'order_count'), 2)} AS avg_order_value,
               {cents('prev_month_revenue')},
               {pct('total_revenue - prev_month_revenue', 'prev_month_revenue', 1)} AS mom_growth_pct,
               {cents('ytd_revenue')}
        FROM revenue_grown""",
    "delivered_order_sums": """
        SELECT o.order_id, o.customer_id, o.purchase_date, SUM(item_price) AS goods, SUM(freight_value) AS freight
        FROM stg_orders o JOIN stg_order_items i ON o.order_id = i.order_id
        WHERE order_status = 'delivered' GROUP BY 1, 2, 3""",
    "customer_sums": f"""
        SELECT customer_unique_id, MAX(customer_state) AS customer_state, MAX(customer_city) AS customer_city,
               MAX(purchase_date) AS last_order_date, MIN(purchase_date) AS first_order_date,
               COUNT(DISTINCT order_id) AS order_count, SUM(goods) AS total_product_spend,
               SUM(freight) AS total_freight_spend, SUM(goods + freight) AS total_spend, {avg('goods')} AS avg_order_value,
               {_days('MAX(purchase_date)', 'MIN(purchase_date)')} AS customer_tenure_days,
               {_days(END_DATE, 'MAX(purchase_date)')} AS recency_days
        FROM stg_customers c JOIN delivered_order_sums d ON c.customer_id = d.customer_id GROUP BY 1""",
    "customer_scores": """
        SELECT *, CAST(NTILE(4) OVER (ORDER BY recency_days DESC, customer_unique_id) AS INT) AS r_score,
               CAST(NTILE(4) OVER (ORDER BY order_count, customer_unique_id) AS INT) AS f_score,
               CAST(NTILE(4) OVER (ORDER BY total_spend, customer_unique_id) AS INT) AS m_score
        FROM customer_sums""",
    "mart_customer_lifetime_value": f"""
        SELECT customer_unique_id, customer_state, customer_city, first_order_date, last_order_date, order_count,
               {cents('total_product_spend', 'total_freight_spend', 'total_spend', 'avg_order_value')},
               customer_tenure_days, recency_days, r_score, f_score, m_score,
               CASE WHEN r_score = 4 AND f_score = 4 THEN 'Champions'
                    WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
                    WHEN r_score = 4 THEN 'New Customers' WHEN r_score = 3 THEN 'Potential Loyalists'
                    WHEN f_score >= 3 THEN 'At Risk' WHEN m_score >= 3 THEN 'Sleeping Giants'
                    ELSE 'Hibernating' END AS rfm_segment,
               CASE WHEN r_score = 4 AND f_score = 4 THEN 'High Value'
                    WHEN r_score >= 3 AND m_score >= 3 THEN 'Medium Value' ELSE 'Low Value' END AS value_tier,
               {r('CAST(total_spend AS DECIMAL(18,2)) * (1 + CAST(0.3 AS DECIMAL(6,4)) * LEAST(order_count - 1, 5))', 2)} AS estimated_clv
        FROM customer_scores""",
    "geo_customers": """
        SELECT customer_id, COALESCE(g.state_code, customer_state) AS state_code,
               COALESCE(g.state_name, customer_state) AS state_name, COALESCE(g.region, f.region, 'North') AS region,
               COALESCE(high_ecomm_penetration, f.is_frontier_market, TRUE) AS is_frontier_market,
               CAST(latitude AS DECIMAL(18,6)) AS latitude, CAST(longitude AS DECIMAL(18,6)) AS longitude
        FROM stg_customers c LEFT JOIN stg_geolocation g ON c.zip_code_prefix = g.zip_code_prefix
        LEFT JOIN state_meta f ON c.customer_state = f.state_code""",
    "geo_grouped": f"""
        SELECT c.state_code, MAX(state_name) AS state_name, MAX(region) AS region,
               bool_or(is_frontier_market) AS is_frontier_market, {avg('latitude')} AS state_lat_center,
               {avg('longitude')} AS state_lng_center, {MONTH} AS order_month,
               COUNT(DISTINCT o.order_id) AS total_orders, COUNT(DISTINCT o.customer_id) AS unique_customers,
               SUM(item_price + freight_value) AS total_revenue, {avg('item_price + freight_value')} AS avg_order_value
        FROM stg_orders o JOIN stg_order_items i ON o.order_id = i.order_id
        JOIN geo_customers c ON o.customer_id = c.customer_id
        WHERE {VALID} GROUP BY c.state_code, order_month""",
    "mart_geo_performance": f"""
        SELECT g.state_code, g.state_name, g.region, g.is_frontier_market, state_lat_center, state_lng_center,
               order_month, total_orders, unique_customers, total_revenue, avg_order_value,
               {div('total_revenue', 'unique_customers')} AS revenue_per_customer, state_population,
               {div('total_orders * 1000', 'state_population')} AS orders_per_1k_pop,
               {div('total_revenue', 'state_population')} AS revenue_per_capita
        FROM geo_grouped g LEFT JOIN state_meta s ON g.state_code = s.state_code""",
    "seller_sums": f"""
        SELECT seller_id, COUNT(DISTINCT i.order_id) AS total_orders, COUNT(order_item_id) AS total_items_sold,
               COUNT(DISTINCT product_id) AS unique_products, SUM(item_price) AS gmv, SUM(freight_value) AS freight,
               SUM(item_total) AS revenue, {r(avg('item_price'), 2)} AS avg_item_price,
               {r(avg('item_total'), 2)} AS avg_order_value,
               COUNT(*) FILTER (WHERE is_on_time) AS on_time_deliveries,
               COUNT(*) FILTER (WHERE NOT is_on_time) AS late_deliveries,
               {pct('COUNT(*) FILTER (WHERE is_on_time)', 'COUNT(is_on_time)', 1)} AS on_time_delivery_pct,
               {r(avg('review_score'), 2)} AS avg_review_score,
               COUNT(*) FILTER (WHERE review_score >= 4) AS positive_reviews,
               COUNT(*) FILTER (WHERE review_score <= 2) AS negative_reviews,
               COUNT(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
               COUNT(*) FILTER (WHERE order_status = 'canceled') AS canceled_orders,
               {pct("COUNT(*) FILTER (WHERE order_status = 'canceled')", 'COUNT(DISTINCT i.order_id)', 1)} AS cancellation_rate_pct,
               MIN(purchase_date) AS first_sale_date, MAX(purchase_date) AS last_sale_date,
               {_days('MAX(purchase_date)', 'MIN(purchase_date)')} AS active_selling_days
        FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id
        LEFT JOIN order_review v ON i.order_id = v.order_id GROUP BY seller_id""",
    "seller_ranked": "SELECT *, NTILE(10) OVER (ORDER BY gmv DESC NULLS LAST, seller_id) AS d FROM seller_sums",
    "mart_seller_performance": f"""
        SELECT t.seller_id, seller_state, seller_city, g.region AS seller_region,
               CASE WHEN d = 1 THEN 'Platinum' WHEN d <= 3 THEN 'Gold' WHEN d <= 6 THEN 'Silver' ELSE 'Bronze' END AS seller_tier,
               {r('''COALESCE(avg_review_score / 5, 0) * 40 + COALESCE(on_time_delivery_pct / 100, 0) * 35
                     + GREATEST(0, 1 - COALESCE(cancellation_rate_pct / 100, 0)) * 25''', 1)} AS performance_score,
               total_orders, total_items_sold, unique_products, {r('gmv', 2)} AS gross_merchandise_value,
               {r('freight', 2)} AS total_freight_charged, {r('revenue', 2)} AS total_revenue, avg_item_price,
               avg_order_value, on_time_deliveries, late_deliveries, on_time_delivery_pct, avg_review_score,
               positive_reviews, negative_reviews, delivered_orders, canceled_orders, cancellation_rate_pct,
               first_sale_date, last_sale_date, active_selling_days
        FROM seller_ranked t LEFT JOIN stg_sellers s ON t.seller_id = s.seller_id
        LEFT JOIN stg_geolocation g ON s.zip_code_prefix = g.zip_code_prefix""",
    "lead_base": f"""
        SELECT mql_id, origin, CAST(date_trunc('month', first_contact_date) AS DATE) AS cohort_month, is_converted,
               CASE WHEN is_converted THEN {_days('won_date', 'first_contact_date')} END AS days,
               CASE WHEN is_converted THEN declared_monthly_revenue END AS revenue,
               CASE WHEN is_converted THEN business_segment END AS segment,
               CASE WHEN is_converted THEN lead_type END AS kind
        FROM stg_marketing_leads WHERE origin IS NOT NULL""",
    "lead_top_segment": top("lead_base", "origin, cohort_month", "segment", "top_converted_segment", False),
    "lead_top_kind": top("lead_base", "origin, cohort_month", "kind", "top_converted_lead_type", False),
    "lead_top_segment_any": top("lead_base", "origin, cohort_month", "segment", "top_converted_segment", True),
    "lead_top_kind_any": top("lead_base", "origin, cohort_month", "kind", "top_converted_lead_type", True),
    "lead_monthly": f"""
        SELECT origin, cohort_month, COUNT(mql_id) AS total_leads, COUNT(*) FILTER (WHERE is_converted) AS converted_leads,
               {r(avg('days'), 1)} AS avg_days_to_close, MIN(days) AS min_days_to_close, MAX(days) AS max_days_to_close,
               {r(avg('revenue'), 2)} AS avg_declared_monthly_revenue,
               {r('COALESCE(SUM(revenue), 0)', 2)} AS total_declared_monthly_revenue
        FROM lead_base GROUP BY 1, 2""",
    "lead_totals": f"""
        SELECT origin, CAST(SUM(total_leads) AS BIGINT) AS all_time_leads,
               CAST(SUM(converted_leads) AS BIGINT) AS all_time_conversions,
               {pct('SUM(converted_leads)', 'SUM(total_leads)', 2)} AS all_time_conversion_pct
        FROM lead_monthly GROUP BY 1""",
    "lead_growth": """
        SELECT *, LAG(total_leads) OVER (PARTITION BY origin ORDER BY cohort_month) AS prev_month_leads FROM lead_monthly""",
    "order_logistics": f"""
        SELECT o.order_id, customer_state, g.region, {MONTH} AS order_month, delivery_days, is_on_time,
               CASE WHEN is_late THEN {_days('delivered_date', 'estimated_delivery_date')} END AS delay, review_score
        FROM stg_orders o LEFT JOIN order_review v ON o.order_id = v.order_id
        JOIN stg_customers c ON o.customer_id = c.customer_id
        LEFT JOIN stg_geolocation g ON c.zip_code_prefix = g.zip_code_prefix
        WHERE order_status = 'delivered' AND delivery_days >= 0""",
    "logistics_grouped": f"""
        SELECT customer_state, order_month, MAX(region) AS region, COUNT(DISTINCT order_id) AS total_delivered_orders,
               {r(avg('delivery_days'), 1)} AS avg_delivery_days,
               CAST(quantile_disc(delivery_days, 0.5) AS DOUBLE) AS median_delivery_days,
               CAST(quantile_disc(delivery_days, 0.9) AS DOUBLE) AS p90_delivery_days,
               MIN(delivery_days) AS min_delivery_days, MAX(delivery_days) AS max_delivery_days,
               COUNT(*) FILTER (WHERE is_on_time) AS on_time_orders,
               COUNT(*) FILTER (WHERE NOT is_on_time) AS late_orders,
               {pct('COUNT(*) FILTER (WHERE is_on_time)', 'COUNT(DISTINCT order_id)', 2)} AS on_time_pct,
               {r(avg('delay'), 1)} AS avg_delay_days_when_late, MAX(delay) AS max_delay_days,
               {r(avg('review_score'), 3)} AS avg_review_score,
               {r(avg('CASE WHEN is_on_time THEN review_score END'), 3)} AS avg_review_on_time,
               {r(avg('CASE WHEN NOT is_on_time THEN review_score END'), 3)} AS avg_review_late,
               COUNT(*) FILTER (WHERE delivery_days <= 5) AS orders_0_5_days,
               COUNT(*) FILTER (WHERE delivery_days BETWEEN 6 AND 10) AS orders_6_10_days,
               COUNT(*) FILTER (WHERE delivery_days BETWEEN 11 AND 20) AS orders_11_20_days,
               COUNT(*) FILTER (WHERE delivery_days BETWEEN 21 AND 30) AS orders_21_30_days,
               COUNT(*) FILTER (WHERE delivery_days > 30) AS orders_over_30_days
        FROM order_logistics GROUP BY 1, 2""",
    "mart_logistics_performance": f"""
        SELECT *, CASE WHEN on_time_pct >= 95 THEN 'Excellent' WHEN on_time_pct >= 90 THEN 'Good'
                       WHEN on_time_pct >= 80 THEN 'Needs Improvement' ELSE 'Critical' END AS sla_performance_band,
               {r('avg_review_on_time - avg_review_late', 3)} AS review_score_delta_on_time_vs_late
        FROM logistics_grouped""",
    "sold_items": f"""
        SELECT i.*, p.category_english, p.product_weight_g, p.product_photos_qty, p.product_name_length,
               o.customer_id, o.purchase_date, o.is_on_time, v.review_score
        FROM stg_order_items i JOIN stg_products p ON i.product_id = p.product_id
        JOIN stg_orders o ON i.order_id = o.order_id LEFT JOIN order_review v ON i.order_id = v.order_id
        WHERE {VALID}""",
    "product_aggregate": f"""
        SELECT product_id, category_english, COUNT(DISTINCT order_id) AS total_orders,
               COUNT(order_item_id) AS total_units_sold, COUNT(DISTINCT customer_id) AS unique_customers,
               {r('SUM(item_price)', 2)} AS gross_revenue, {r(avg('item_price'), 2)} AS avg_selling_price,
               {r('MIN(item_price)', 2)} AS min_price, {r('MAX(item_price)', 2)} AS max_price,
               {r(avg('review_score'), 3)} AS avg_review_score,
               COUNT(*) FILTER (WHERE review_score >= 4) AS positive_reviews,
               COUNT(*) FILTER (WHERE review_score <= 2) AS negative_reviews,
               {r(avg('CAST(product_weight_g AS DECIMAL(18,6))'), 0)} AS avg_weight_g,
               MAX(product_photos_qty) AS product_photos_qty, MAX(product_name_length) AS product_name_length,
               MIN(purchase_date) AS first_sold_date, MAX(purchase_date) AS last_sold_date
        FROM sold_items GROUP BY 1, 2""",
    "repeat_buyers": """
        SELECT product_id, COUNT(*) FILTER (WHERE n > 1) AS repeat_buyer_count, COUNT(customer_id) AS total_distinct_buyers
        FROM (SELECT product_id, customer_id, COUNT(*) AS n FROM sold_items GROUP BY 1, 2) GROUP BY 1""",
    "category_sums": f"""
        SELECT category_english, COUNT(DISTINCT product_id) AS total_skus, COUNT(DISTINCT order_id) AS total_orders,
               COUNT(order_item_id) AS total_units_sold, COUNT(DISTINCT customer_id) AS unique_customers,
               SUM(item_price) AS gross, SUM(freight_value) AS freight, {r(avg('item_price'), 2)} AS avg_item_price,
               {r('quantile_disc(item_price, 0.5)', 2)} AS median_item_price,
               {r(avg('review_score'), 3)} AS avg_review_score,
               COUNT(*) FILTER (WHERE review_score >= 4) AS positive_reviews,
               COUNT(*) FILTER (WHERE review_score <= 2) AS negative_reviews,
               {pct('COUNT(*) FILTER (WHERE is_on_time)', 'COUNT(is_on_time)', 2)} AS on_time_delivery_pct,
               MIN(purchase_date) AS first_sale_date, MAX(purchase_date) AS last_sale_date
        FROM sold_items GROUP BY 1""",
    "category_ranked": """
        SELECT *, CAST(NTILE(4) OVER (ORDER BY gross DESC, category_english) AS INT) AS gmv_quartile,
               SUM(gross) OVER () AS total,
               SUM(gross) OVER (ORDER BY gross DESC, category_english ROWS UNBOUNDED PRECEDING) AS running
        FROM category_sums""",
    "mart_product_performance": f"""
        SELECT category_english,
               (['Tier 1 — Core', 'Tier 2 — Growth', 'Tier 3 — Niche', 'Tier 4 — Tail'])[gmv_quartile] AS performance_tier,
               gmv_quartile, total_skus, total_orders, total_units_sold, unique_customers,
               {r('gross', 2)} AS category_gross_revenue, {r('freight', 2)} AS category_freight_revenue,
               {r('gross + freight', 2)} AS total_category_revenue, avg_item_price, median_item_price,
               {pct('gross', 'total', 3)} AS revenue_share_pct, {pct('running', 'total', 2)} AS cumulative_revenue_pct,
               avg_review_score, positive_reviews, negative_reviews,
               {pct('positive_reviews', 'positive_reviews + negative_reviews', 2)} AS positive_review_rate_pct,
               on_time_delivery_pct, {r(div('total_units_sold', 'total_orders'), 2)} AS avg_units_per_order,
               {r(div('gross', 'total_orders'), 2)} AS revenue_per_order, first_sale_date, last_sale_date,
               {_days('last_sale_date', 'first_sale_date')} AS active_selling_days
        FROM category_ranked""",
}


def _funnel(suffix: str) -> str:
    return f"""
        SELECT g.origin, CASE WHEN all_time_conversion_pct >= 10 THEN 'High Converting'
                    WHEN all_time_conversion_pct >= 5 THEN 'Mid Converting' ELSE 'Low Converting' END AS conversion_tier,
               g.cohort_month, CAST(year(g.cohort_month) AS INT) AS cohort_year,
               CAST(month(g.cohort_month) AS INT) AS cohort_month_num, total_leads, converted_leads,
               total_leads - converted_leads AS dropped_leads,
               {pct('converted_leads', 'total_leads', 2)} AS conversion_rate_pct, avg_days_to_close, min_days_to_close,
               max_days_to_close, avg_declared_monthly_revenue, total_declared_monthly_revenue, top_converted_segment,
               top_converted_lead_type, prev_month_leads,
               {pct('total_leads - prev_month_leads', 'prev_month_leads', 1)} AS mom_lead_growth_pct,
               all_time_leads, all_time_conversions, all_time_conversion_pct
        FROM lead_growth g LEFT JOIN lead_totals t ON g.origin = t.origin
        LEFT JOIN lead_top_segment{suffix} s ON g.origin = s.origin AND g.cohort_month = s.cohort_month
        LEFT JOIN lead_top_kind{suffix} k ON g.origin = k.origin AND g.cohort_month = k.cohort_month"""


FRAGMENTS["mart_marketing_funnel"] = _funnel("")
FRAGMENTS["mart_marketing_funnel_any"] = _funnel("_any")

# The revenue mart over orders of which a third are stored twice.
for _name in ("revenue_base", "revenue_grown", "mart_monthly_revenue"):
    FRAGMENTS[f"{_name}_repeated"] = (
        FRAGMENTS[_name]
        .replace("JOIN stg_orders o", "JOIN (SELECT * FROM stg_orders UNION ALL SELECT * FROM stg_orders WHERE order_id % 3 = 0) o")
        .replace("FROM revenue_base", "FROM revenue_base_repeated")
        .replace("FROM revenue_grown", "FROM revenue_grown_repeated")
    )
