"""Reference SQL of the quality suites and table tests."""

from __future__ import annotations

from marketloom.functions import labels
from marketloom.plans.layouts import LAYOUTS
from marketloom.plans.table_tests import TableTest, declared_tests

STATES = tuple(f"NATION_{i}" for i in range(25))
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
TYPES = labels.PAYMENT_TYPES
STATUSES = labels.ORDER_STATUSES
DELIVERY = """COUNT(*) AS delivered_orders, CAST(quantile_disc(delivery_days, 0.1) AS BIGINT) AS p10_delivery_days,
    CAST(quantile_disc(delivery_days, 0.5) AS BIGINT) AS median_delivery_days, CAST(quantile_disc(delivery_days, 0.9) AS BIGINT) AS p90_delivery_days"""


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


class Suite:
    """Collects one SELECT per check of a dataset, numbered in order."""

    def __init__(self, dataset: str, table: str):
        self.dataset, self.table, self.selects = dataset, table, []

    def _add(self, rule: str, column: str, affected: str, passed: str, detail: str) -> Suite:
        check_id = f"{self.dataset}-{len(self.selects) + 1:02d}"
        self.selects.append(
            f"""SELECT '{check_id}' AS check_id, '{rule}' AS rule, '{self.dataset}' AS dataset, '{column}' AS "column",
                CASE WHEN {passed} THEN 'PASS' ELSE 'FAIL' END AS status, COALESCE({passed}, FALSE) AS passed,
                CAST(h AS BIGINT) AS rows_affected, {detail} AS detail FROM (SELECT {affected})"""
        )
        return self

    def not_null(self, *columns: str, rate: float = 0.0) -> Suite:
        for c in columns:
            self._add(
                "not_null", c, f"COUNT(*) FILTER (WHERE {c} IS NULL) AS h, COUNT(*) AS n FROM {self.table}",
                f"h::DOUBLE / n <= {rate}",
                f"h || ' of ' || n || ' rows, at most {rate:.1%} allowed'",
            )
        return self

    def unique(self, c: str) -> Suite:
        return self._add(
            "unique", c, f"COALESCE(SUM(n - 1), 0) AS h FROM (SELECT COUNT(*) AS n FROM {self.table} GROUP BY {c})",
            "h = 0", "CAST(h AS BIGINT) || ' rows repeat a value'",
        )

    def between(self, c: str, low=None, high=None) -> Suite:
        parts = [f"{c} < {low}"] * (low is not None) + [f"{c} > {high}"] * (high is not None)
        return self._add(
            "between", c, f"COUNT(*) FILTER (WHERE {' OR '.join(parts)}) AS h, COUNT(*) AS n FROM {self.table}", "h = 0",
            f"h || ' of ' || n || ' rows outside {'any' if low is None else low} to {'any' if high is None else high}'",
        )

    def in_set(self, c: str, values) -> Suite:
        bad = f"{c} NOT IN ({_list(values)})"
        return self._add(
            "accepted_values", c,
            f"""COUNT(*) AS h, (SELECT COALESCE(string_agg(v, ', ' ORDER BY v), '') FROM
                (SELECT DISTINCT {c} AS v FROM {self.table} WHERE {bad} ORDER BY 1 LIMIT 3)) AS ex
                FROM {self.table} WHERE {bad}""",
            "h = 0", "h || ' rows' || CASE WHEN ex <> '' THEN ', such as ' || ex ELSE '' END",
        )

    def references(self, c: str, parent: str, pk: str, name: str) -> Suite:
        return self._add(
            "referential_integrity", c,
            f"COUNT(DISTINCT {c}) AS h FROM {self.table} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pk} FROM {parent})",
            "h = 0", f"h || ' keys without a row in {name}.{pk}'",
        )

    def rule(self, name: str, violated: str, allowed: int = 0) -> Suite:
        return self._add(
            f"business_rule:{name}", "multiple", f"COUNT(*) FILTER (WHERE {violated}) AS h, COUNT(*) AS n FROM {self.table}",
            f"h <= {allowed}", f"h || ' of ' || n || ' rows, at most {allowed} allowed'",
        )


WON = Suite("marketing_funnel", "lead_deals").rule("won_after_contact", "NOT won_date >= first_contact_date", 1)

CORE = [
    Suite("orders", "raw_orders").not_null("order_id", "customer_id", "order_status", "order_purchase_timestamp")
    .unique("order_id").in_set("order_status", STATUSES)
    .rule("approved_needs_timestamp", "order_status = 'approved' AND order_approved_at IS NULL"),
    Suite("order_items", "raw_order_items").not_null("order_id", "product_id", "seller_id", "price")
    .between("price", 0).between("freight_value", 0).references("order_id", "raw_orders", "order_id", "orders")
    .references("product_id", "raw_products", "product_id", "products")
    .references("seller_id", "raw_sellers", "seller_id", "sellers"),
    Suite("customers", "raw_customers").not_null("customer_id", "customer_unique_id").unique("customer_id"),
    Suite("products", "raw_products").not_null("product_id").unique("product_id")
    .between("product_weight_g", 0).between("product_photos_qty", 0),
    Suite("sellers", "raw_sellers").not_null("seller_id").unique("seller_id").not_null("seller_state"),
    Suite("payments", "raw_order_payments").not_null("order_id", "payment_type", "payment_value")
    .between("payment_value", 0).between("payment_installments", 0, 24).in_set("payment_type", (*TYPES, "not_defined"))
    .references("order_id", "raw_orders", "order_id", "orders"),
    Suite("reviews", "raw_order_reviews").not_null("review_id", "order_id", "review_score").between("review_score", 1, 5),
    Suite("mql", "raw_marketing_qualified_leads").not_null("mql_id").unique("mql_id").not_null("first_contact_date")
    .not_null("origin", rate=0.01),
    Suite("closed_deals", "raw_closed_deals").not_null("mql_id", "seller_id")
    .references("mql_id", "raw_marketing_qualified_leads", "mql_id", "mql"),
    WON,
]

FAILING = [
    Suite("payments", "raw_order_payments").in_set("payment_type", TYPES),
    Suite("reviews", "raw_order_reviews").unique("review_id").unique("order_id"),
    Suite("orders", "raw_orders").not_null("order_delivered_customer_date", rate=0.2)
    .rule("needs_delivery", "order_delivered_customer_date IS NULL", 10),
    Suite("order_items", "raw_order_items").between("price", 1000, 90000)
    .references("order_id", "raw_closed_deals", "mql_id", "closed_deals"),
]


def _union(suites) -> str:
    return "\nUNION ALL\n".join(s for suite in suites for s in suite.selects)


FRAGMENTS = {
    "lead_deals": """
        SELECT m.mql_id, first_contact_date, won_date
        FROM raw_marketing_qualified_leads m JOIN raw_closed_deals d ON m.mql_id = d.mql_id""",
    "core_results": _union(CORE),
    "geo_facts": f"""
        SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE geolocation_lat NOT BETWEEN -35.0 AND 5.3) AS lat_box,
               COUNT(*) FILTER (WHERE geolocation_lng NOT BETWEEN -74.0 AND -28.0) AS lng_box,
               COUNT(*) FILTER (WHERE geolocation_lat > 10) AS north,
               COUNT(*) FILTER (WHERE LENGTH(split_part(CAST(geolocation_lat AS VARCHAR), '.', 2)) < 4) AS coarse,
               COUNT(*) FILTER (WHERE geolocation_state NOT IN ({_list(STATES)})) AS bad_state,
               COUNT(DISTINCT geolocation_state) AS states, COUNT(DISTINCT geolocation_zip_code_prefix) AS zips,
               quantile_cont(geolocation_lat, 0.01) AS lat1, quantile_cont(geolocation_lat, 0.99) AS lat99,
               quantile_cont(geolocation_lng, 0.01) AS lng1, quantile_cont(geolocation_lng, 0.99) AS lng99,
               stddev_samp(geolocation_lat) AS lat_std, stddev_samp(geolocation_lng) AS lng_std,
               (SELECT COUNT(*) FROM stg_geolocation) AS kept,
               (SELECT COUNT(DISTINCT customer_zip_code_prefix) FROM raw_customers) AS wanted,
               (SELECT COUNT(DISTINCT customer_zip_code_prefix) FROM raw_customers WHERE customer_zip_code_prefix NOT IN
                   (SELECT CAST(geolocation_zip_code_prefix AS BIGINT) FROM raw_geolocation)) AS uncovered,
               (SELECT geolocation_state FROM raw_geolocation GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS largest
        FROM raw_geolocation""",
    "geo_all": """
        SELECT *, (SELECT COUNT(*) FROM raw_geolocation WHERE geolocation_lat < lat1 OR geolocation_lat > lat99) AS lat_tail,
               (SELECT COUNT(*) FROM raw_geolocation WHERE geolocation_lng < lng1 OR geolocation_lng > lng99) AS lng_tail
        FROM geo_facts""",
}


_INSIDE = "WHERE geolocation_lat BETWEEN -35.0 AND 5.3 AND geolocation_lng BETWEEN -74.0 AND -28.0"


def _geo_checks() -> str:
    none = ("0", "TRUE", "'0 of ' || n || ' rows'")

    def rows(name: str, passed: str) -> tuple[str, str, str]:
        return name, passed, f"{name} || ' of ' || n || ' rows'"

    def few(name: str, limit: float) -> tuple[str, str, str]:
        share = f"CAST({name} AS DOUBLE) / n * 100"
        return name, f"{share} < {limit}", f"printf('%d of %d rows, %.4f%%', {name}, n, {share})"

    def within(value: str, low: float, high: float, form: str) -> tuple[str, str, str]:
        return "0", f"{value} BETWEEN {low} AND {high}", f"printf('{form}, expected {form} to {form}', {value}, {low}, {high})"

    def real(value: str, low: int, high: int, digits: int) -> tuple[str, str, str]:
        return within(value, f"{low}::DOUBLE", f"{high}::DOUBLE", f"%.{digits}f")

    checks = [
        ("CRITICAL", "0", "TRUE", "'absent: none'"),
        ("WARNING", "0", "TRUE", "'5, expected 5 to 5'"),
        ("CRITICAL", *none),
        ("CRITICAL", *none),
        ("WARNING", *none),
        ("CRITICAL", *none),
        ("CRITICAL", *none),
        ("CRITICAL", *none),
        ("WARNING", *few("0", 0.5)),
        ("CRITICAL", *none),
        ("CRITICAL", *none),
        ("CRITICAL", *none),
        ("WARNING", *few("lat_box", 0.01)),
        ("WARNING", *few("lng_box", 0.01)),
        ("CRITICAL", *none),
        ("WARNING", *rows("north", "north < 10")),
        ("INFO", *few("coarse", 5)),
        ("WARNING", *rows("bad_state", "bad_state = 0")),
        ("INFO", "0", "states >= 25", "states || ', expected 25 or more'"),
        ("WARNING", *none),
        ("WARNING", "uncovered", "uncovered * 100.0 / wanted < 5",
         "printf('%d of %d zips, %.4f%%', uncovered, wanted, CAST(uncovered AS DOUBLE) / wanted * 100)"),
        ("INFO", "0", "largest = 'NATION_0'", "largest || ', expected NATION_0'"),
        ("WARNING", *within("zips", 15000, 25000, "%d")),
        ("WARNING", *within("n", 900000, 1100000, "%d")),
        ("INFO", *real("(CAST(n AS DOUBLE) / kept)", 40, 60, 1)),
        ("WARNING", *few("0", 1.0)),
        ("INFO", *few("lat_tail", 2)),
        ("INFO", *few("lng_tail", 2)),
        ("INFO", *real("lat_std", 4, 8, 3)),
        ("INFO", *real("lng_std", 3, 6, 3)),
    ]
    return "\nUNION ALL\n".join(
        f"""SELECT 'GEO-{i:02d}' AS check_id, '{severity}' AS severity,
            CASE WHEN {passed} THEN 'PASS' ELSE '{'FAIL' if severity == 'CRITICAL' else 'WARN'}' END AS status,
            {passed} AS passed, CAST({affected} AS BIGINT) AS rows_affected, {detail} AS detail FROM geo_all"""
        for i, (severity, affected, passed, detail) in enumerate(checks, 1)
    )


def _failing_where(test: TableTest) -> str:
    c = test.column
    if test.kind == "not_null":
        return f"{c} IS NULL"
    if test.kind == "accepted_values":
        return f"{c} NOT IN ({_list(test.argument)})"
    if test.kind == "expression":
        return f"NOT ({test.argument})"
    return f"{c} NOT BETWEEN {test.argument[0]} AND {test.argument[1]}"


def _table_test(test: TableTest) -> str:
    if test.kind.startswith("unique"):
        where = f"WHERE {test.column} IS NOT NULL" if test.kind == "unique" else ""
        count = f"(SELECT COUNT(*) FROM (SELECT 1 FROM {test.table} {where} GROUP BY {test.column} HAVING COUNT(*) > 1))"
    else:
        count = f"(SELECT COUNT(*) FROM {test.table} WHERE {_failing_where(test)})"
    bad = "WARN" if test.severity == "warn" else "FAIL"
    return f"""SELECT '{test.table}' AS table_name, '{test.column}' AS column_name, '{test.kind}' AS test,
        '{test.severity}' AS severity, {count} AS failures, CASE WHEN {count} = 0 THEN 'PASS' ELSE '{bad}' END AS status"""


def _schema_row(name: str, table: str, key: str | None, nullable: str | None) -> str:
    """Rows, warnings and text; only the given key and column can warn in the test data."""
    dup = f"(SELECT COUNT(*) - COUNT(DISTINCT {key}) FROM {table})" if key else "0"
    rate = f"(SELECT AVG(CASE WHEN {nullable} IS NULL THEN 1.0::DOUBLE ELSE 0 END) FROM {table})" if nullable else "0"
    first = f"CASE WHEN {dup} > 0 THEN '[{name}] key {key}: ' || {dup} || ' rows repeat another row''s value' END"
    second = f"CASE WHEN {rate} > 0.05 THEN printf('[{name}] {nullable}: %.1f%% of the rows lack a value', {rate} * 100) END"
    return f"""SELECT '{name}' AS dataset, (SELECT COUNT(*) FROM {table}) AS rows,
        CAST(({dup} > 0)::INT + ({rate} > 0.05)::INT AS BIGINT) AS warnings, concat_ws('; ', {first}, {second}) AS detail"""


_MARTS = ("mart_monthly_revenue", "mart_customer_lifetime_value", "mart_geo_performance", "mart_seller_performance",
          "mart_marketing_funnel", "mart_logistics_performance", "mart_product_performance")

BODIES = {
    "dq_core_suite": "SELECT * FROM core_results",
    "dq_core_summary": """
        SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE passed) AS passed, COUNT(*) FILTER (WHERE NOT passed) AS failed,
               CAST(ROUND(COUNT(*) FILTER (WHERE passed) * 100.0 / COUNT(*), 1) AS DOUBLE) AS pass_rate FROM core_results""",
    "dq_core_failures": _union(FAILING) + """
        UNION ALL SELECT 'orders-03', 'business_rule:broken', 'orders', 'multiple', 'FAIL', FALSE, NULL,
        'cannot be evaluated: UNRESOLVED_COLUMN.WITH_SUGGESTION'
        UNION ALL SELECT 'orders-04', 'business_rule:unreadable', 'orders', 'multiple', 'FAIL', FALSE, NULL,
        'cannot be evaluated: CAST_INVALID_INPUT'""",
    "dq_won_after_contact": _union([WON]),
    "dq_geo_suite": _geo_checks(),
    "dq_geo_preload": """
        SELECT 'warning' AS level, 'lat_box' AS rule, 'geolocation_lat' AS "column", lat_box AS rows_affected,
               lat_box || ' of ' || n || ' rows' AS detail FROM geo_facts WHERE lat_box > 0
        UNION ALL SELECT 'warning', 'lng_box', 'geolocation_lng', lng_box,
               lng_box || ' of ' || n || ' rows' FROM geo_facts WHERE lng_box > 0
        UNION ALL SELECT 'stat', 'rows', '*', n, CAST(n AS VARCHAR) FROM geo_facts
        UNION ALL SELECT 'stat', 'zips', 'geolocation_zip_code_prefix', zips, CAST(zips AS VARCHAR) FROM geo_facts
        UNION ALL SELECT 'stat', 'states', 'geolocation_state', states, CAST(states AS VARCHAR) FROM geo_facts
        UNION ALL SELECT 'stat', 'cities', 'geolocation_city', COUNT(DISTINCT geolocation_city),
               CAST(COUNT(DISTINCT geolocation_city) AS VARCHAR) FROM raw_geolocation""",
    "dq_schema_validation": "\nUNION ALL\n".join(
        _schema_row(*row) for row in (
            ("orders", "raw_orders", "order_id", "order_delivered_customer_date"),
            ("order_items", "raw_order_items", None, None),
            ("customers", "raw_customers", "customer_id", None),
            ("products", "raw_products", "product_id", None),
            ("sellers", "raw_sellers", "seller_id", None),
            ("payments", "raw_order_payments", None, None),
            ("reviews", "raw_order_reviews", "review_id", None),
            ("category_translation", "raw_category_translation", "product_category_name", None),
            ("mql", "raw_marketing_qualified_leads", "mql_id", "landing_page_id"),
            ("closed_deals", "raw_closed_deals", "mql_id", None),
        )
    ),
    "table_tests": "\nUNION ALL\n".join(_table_test(t) for t in declared_tests(STATES, REGIONS)),
    "test_unique": """
        SELECT review_id, COUNT(*) AS n_records FROM stg_reviews WHERE review_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1""",
    "test_not_null": "SELECT mql_id, origin FROM stg_marketing_leads WHERE origin IS NULL",
    "test_accepted_values": f"""
        SELECT payment_type, COUNT(*) AS n_records FROM raw_order_payments WHERE payment_type NOT IN ({_list(TYPES)}) GROUP BY 1""",
    "test_expression": "SELECT order_id, delivery_days FROM stg_orders WHERE delivery_days <= 0",
    "test_accepted_range": """
        SELECT review_id, order_id, review_score FROM stg_reviews WHERE review_score < 2 OR review_score > 4""",
    "test_unique_combination": """
        SELECT order_id, order_item_id, COUNT(*) AS n_records FROM stg_order_items GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "test_orphans": """
        SELECT i.order_id FROM raw_order_items i LEFT JOIN raw_orders o ON i.order_id = o.order_id WHERE o.order_id IS NULL""",
    "test_orders_without_items": """
        SELECT o.order_id FROM raw_orders o LEFT JOIN (SELECT DISTINCT order_id FROM raw_order_items) i
        ON o.order_id = i.order_id WHERE i.order_id IS NULL""",
    "test_payment_totals": """
        SELECT o.order_id, CAST(total_payment_value AS DOUBLE) AS total_payment_value, CAST(sum_paid AS DOUBLE) AS sum_paid,
               CAST(ABS(total_payment_value - sum_paid) AS DOUBLE) AS abs_diff
        FROM fact_orders o JOIN (SELECT order_id, SUM(payment_value) AS sum_paid FROM fact_payments GROUP BY 1) p
        ON o.order_id = p.order_id WHERE ROUND(total_payment_value, 2) <> ROUND(sum_paid, 2)""",
    "test_mart_counts": "\nUNION ALL\n".join(f"SELECT '{m}' AS mart, COUNT(*) AS row_count FROM {m}" for m in _MARTS),
    "test_rfm_coverage": """
        SELECT customer_unique_id FROM mart_customer_lifetime_value WHERE rfm_segment IS NULL OR value_tier IS NULL""",
    "test_geo_box": """
        SELECT zip_code_prefix, latitude, longitude, state_code FROM dim_geography
        WHERE latitude NOT BETWEEN -25.0 AND -5.0 OR longitude NOT BETWEEN -74.0 AND -28.0""",
    "test_future_orders": "SELECT order_id, purchase_date FROM stg_orders WHERE purchase_date > DATE '2001-06-30'",
}

_MANIFEST = (
    ("orders", "raw_orders"), ("order_items", "raw_order_items"), ("customers", "raw_customers"),
    ("products", "raw_products"), ("sellers", "raw_sellers"), ("payments", "raw_order_payments"),
    ("reviews", "raw_order_reviews"), ("category_translation", "raw_category_translation"),
    ("mql", "raw_marketing_qualified_leads"), ("closed_deals", "raw_closed_deals"),
)

BODIES |= {
    "load_manifest": "\nUNION ALL\n".join(
        f"SELECT '{n}' AS dataset, '{t}' AS \"table\", COUNT(*) AS rows, 'success' AS status FROM {t}" for n, t in _MANIFEST
    ),
    "load_manifest_dry_run": "\nUNION ALL\n".join(
        f"SELECT '{n}' AS dataset, COUNT(*) AS rows, 'dry_run' AS status FROM {t}"
        for n, t in _MANIFEST if n in ("orders", "customers", "products")
    ) + "\nUNION ALL SELECT 'sellers', 0, 'failed' UNION ALL SELECT 'mql', 0, 'failed'",
    "source_hash_gate": """
        SELECT 'first' AS step, 'success' AS status, COUNT(*) AS rows_loaded FROM raw_geolocation
        UNION ALL SELECT 'repeated', 'skipped_no_change', 0
        UNION ALL SELECT 'target_missing', 'success', COUNT(*) FROM raw_geolocation
        UNION ALL SELECT 'changed', 'success', COUNT(*) FROM raw_geolocation WHERE geolocation_lat < 5.3""",
    "read_present_files": """
        SELECT 'orders' AS dataset, COUNT(*) AS row_count FROM raw_orders
        UNION ALL SELECT 'sellers', COUNT(*) FROM raw_sellers
        UNION ALL SELECT 'closed_deals', COUNT(*) FROM raw_closed_deals""",
    "raw_landing_strings": "SELECT CAST(COLUMNS(*) AS VARCHAR), TRUE AS has_source FROM raw_order_payments",
    "read_csv_typed": "SELECT * FROM raw_geolocation",
    "read_csv_dates": """
        SELECT order_id, order_status, order_purchase_timestamp, order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date FROM raw_orders""",
    "write_read_partitioned": """
        SELECT *, CAST(date_trunc('month', purchase_date) AS DATE) AS purchase_date_month FROM fact_orders""",
    "materialized_mart": "SELECT * FROM mart_seller_performance",
    "export_orders_json": "SELECT * FROM fact_orders",
    "incremental_lookback": """
        SELECT order_id, purchase_date, order_status FROM stg_orders WHERE purchase_date >=
            (SELECT date_trunc('month', MAX(purchase_date)) - INTERVAL 1 MONTH FROM stg_orders
             WHERE purchase_date < DATE '2001-03-15')""",
    "merge_geo_by_key": "SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM mart_geo_performance",
    "merge_logistics_by_key": "SELECT * FROM mart_logistics_performance",
    "delivery_quantiles_by_state": f"SELECT customer_state, {DELIVERY} FROM order_logistics WHERE order_month IS NOT NULL GROUP BY 1",
    "delivery_quantiles_by_year": f"SELECT CAST(year(order_month) AS INT) AS order_year, {DELIVERY} FROM order_logistics WHERE order_month IS NOT NULL GROUP BY 1",
    "append_new_orders": "SELECT * FROM stg_orders",
    "append_new_items": "SELECT * FROM stg_order_items",
    "append_null_keys": """
        SELECT CASE WHEN order_id % 9 <> 0 THEN order_id END AS order_id, customer_id, order_status, purchase_date
        FROM stg_orders""",
    "merge_null_month": """
        SELECT order_id, order_status,
               CASE WHEN order_id % 11 <> 0 THEN CAST(date_trunc('month', purchase_date) AS DATE) END AS order_month
        FROM stg_orders""",
    "landed_items": """
        SELECT CASE WHEN o.purchase_date < DATE '2001-03-15' OR i.order_id % 10 <> 0
                    THEN CAST(date_trunc('month', o.purchase_date) AS DATE) END AS order_month,
               COUNT(*) AS items, CAST(SUM(i.item_total) AS DOUBLE) AS revenue
        FROM stg_order_items i LEFT JOIN stg_orders o ON i.order_id = o.order_id GROUP BY 1""",
    "append_opened_files": """
        SELECT 'first' AS load, COUNT(*) FILTER (WHERE order_id <= middle) AS rows_added, FALSE AS opened_old_files
        FROM stg_orders, (SELECT MAX(order_id) // 2 AS middle FROM stg_orders)
        UNION ALL SELECT 'new_keys', COUNT(*) FILTER (WHERE order_id > middle), FALSE
        FROM stg_orders, (SELECT MAX(order_id) // 2 AS middle FROM stg_orders)
        UNION ALL SELECT 'repeated', 0, TRUE""",
    "read_csv_quoted": """
        SELECT CAST(review_id AS VARCHAR) AS review_id, CAST(order_id AS VARCHAR) AS order_id,
               CASE WHEN order_id % 3 <> 0 THEN 'said "' || review_id || '", twice:' || chr(10) || '"' || review_score || '"'
                    || chr(10) || chr(10) || ', end' END AS note
        FROM raw_order_reviews""",
    "geography_load": f"""
        SELECT 'clean' AS step, 'success' AS status, COUNT(*) FILTER ({_INSIDE}) AS raw_rows, d.n AS dimension_rows,
               0 AS warnings, 3 AS audited_runs FROM raw_geolocation, (SELECT COUNT(*) AS n FROM dim_geography) d GROUP BY d.n
        UNION ALL SELECT 'fatal', 'stopped', COUNT(*) FILTER ({_INSIDE}), d.n, 0, 3
        FROM raw_geolocation, (SELECT COUNT(*) AS n FROM dim_geography) d GROUP BY d.n
        UNION ALL SELECT 'doubtful', 'success', f.n, d.n, CAST(f.lat_box > 0 AS INT) + CAST(f.lng_box > 0 AS INT), 3
        FROM geo_facts f, (SELECT COUNT(*) AS n FROM dim_geography) d""",
    "dq_gate": """
        SELECT 'payments_strict' AS suite, COUNT(*) FILTER (WHERE payment_type NOT IN ('boleto', 'voucher')) = 0 AS may_proceed
        FROM raw_order_payments
        UNION ALL SELECT 'orders_keyed', COUNT(*) = COUNT(DISTINCT order_id) FROM raw_orders""",
    "global_ntile_customers": """
        SELECT customer_id, CAST(spend AS DOUBLE) AS spend, CAST(NTILE(10) OVER (ORDER BY spend DESC, customer_id) AS INT) AS decile
        FROM (SELECT customer_id, SUM(item_total) AS spend
              FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id GROUP BY 1)""",
    "running_revenue_share": """
        SELECT product_id, CAST(revenue AS DOUBLE) AS revenue, ROW_NUMBER() OVER w AS row_no,
               CAST(SUM(revenue) OVER w AS DOUBLE) AS running_revenue,
               CAST(ROUND(CAST(CAST(SUM(revenue) OVER w AS DOUBLE) / CAST(SUM(revenue) OVER () AS DOUBLE) * 100
                    AS DECIMAL(38,6)), 3) AS DOUBLE) AS cumulative_pct
        FROM (SELECT product_id, SUM(item_total) AS revenue FROM stg_order_items GROUP BY 1)
        WINDOW w AS (ORDER BY revenue DESC, product_id ROWS UNBOUNDED PRECEDING)""",
    "exact_price_quantiles": """
        SELECT category_english,
               CAST(ROUND(CAST(quantile_cont(CAST(item_price AS DOUBLE), 0.01) AS DECIMAL(38,6)), 4) AS DOUBLE) AS p01,
               CAST(ROUND(CAST(median(CAST(item_price AS DOUBLE)) AS DECIMAL(38,6)), 4) AS DOUBLE) AS median,
               CAST(ROUND(CAST(quantile_cont(CAST(item_price AS DOUBLE), 0.99) AS DECIMAL(38,6)), 4) AS DOUBLE) AS p99
        FROM stg_order_items i JOIN stg_products p ON i.product_id = p.product_id GROUP BY 1""",
    "distinct_orphan_zips": """
        SELECT DISTINCT zip_code_prefix FROM stg_customers
        WHERE zip_code_prefix NOT IN (SELECT zip_code_prefix FROM stg_geolocation)""",
}

BODIES["dq_core_report"] = BODIES["dq_core_suite"]
BODIES["dq_geo_report"] = BODIES["dq_geo_suite"]
BODIES["stored_models"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS model, '{layout.kind}' AS kind, COUNT(*) AS row_count, "
    + (f"COUNT(DISTINCT date_trunc('month', {layout.date}))" if layout.date else "CAST(0 AS BIGINT)")
    + f" AS months FROM {name}"
    for name, layout in LAYOUTS.items()
)
