"""All queries by name: each takes (spark, folder of one scale factor) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import edge, labels, percent, rounded
from marketloom.operators import assertions, quality, ranking, summaries
from marketloom.plans import delivery_times, geo_load, layouts, marts, quality_core, quality_geo, reports, staging, star
from marketloom.plans import table_tests as tests
from marketloom.session import passing_scratch, scratch_path
from marketloom.sources import files, ingest, keyindex, ranges, sinks
from marketloom.sources import testtables as raw
from marketloom.sources.registry import DATASETS, DATE_COLUMNS
from marketloom.streaming import history, incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; decimals leave as doubles."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return edge(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    QUERIES[fn.__name__] = run
    return fn


# --- staging --------------------------------------------------------------------------


@query
def stg_orders(spark, sf):
    return staging.stg_orders(raw.raw_orders(spark, sf))


@query
def stg_order_items(spark, sf):
    return staging.stg_order_items(raw.raw_order_items(spark, sf))


@query
def stg_customers(spark, sf):
    return staging.stg_customers(raw.raw_customers(spark, sf))


@query
def stg_products(spark, sf):
    return staging.stg_products(raw.raw_products(spark, sf), raw.raw_category_translation(spark, sf))


@query
def stg_sellers(spark, sf):
    return staging.stg_sellers(raw.raw_sellers(spark, sf))


@query
def stg_payments(spark, sf):
    return staging.stg_payments(raw.raw_order_payments(spark, sf))


@query
def stg_reviews(spark, sf):
    return staging.stg_reviews(raw.raw_order_reviews(spark, sf))


@query
def stg_marketing_leads(spark, sf):
    return staging.stg_marketing_leads(
        raw.raw_marketing_qualified_leads(spark, sf), raw.raw_closed_deals(spark, sf)
    )


@query
def stg_geolocation(spark, sf):
    return staging.stg_geolocation(raw.raw_geolocation(spark, sf), raw.state_meta(spark, sf))


@query
def stg_geolocation_exact(spark, sf):
    return staging.stg_geolocation_exact(raw.raw_geolocation(spark, sf), raw.state_meta(spark, sf))


# --- star schema ----------------------------------------------------------------------


def geography(spark, sf):
    return star.dim_geography(raw.raw_geolocation(spark, sf), raw.state_meta(spark, sf))


@query
def dim_date(spark, sf):
    """Calendar over the range of order days, with the orders placed on each day."""
    placed = stg_orders(spark, sf).groupBy("purchase_date").agg(F.count(F.lit(1)).alias("orders"))
    first, last = placed.agg(F.min("purchase_date"), F.max("purchase_date")).first()  # two dates
    calendar = star.dim_date(spark, first.isoformat(), (last - first).days + 1)
    return calendar.join(placed, F.col("full_date") == F.col("purchase_date"), "left").select(
        *calendar.columns, F.coalesce("orders", F.lit(0)).alias("orders_placed")
    )


@query
def dim_geography(spark, sf):
    # The point struct is engine-specific; it is shown as two columns.
    return (
        geography(spark, sf)
        .selectExpr("*", "geo_point.lon AS point_lon", "geo_point.lat AS point_lat")
        .drop("geo_point")
    )


@query
def dim_customer(spark, sf):
    return star.dim_customer(raw.raw_customers(spark, sf), geography(spark, sf))


@query
def dim_product(spark, sf):
    return star.dim_product(raw.raw_products(spark, sf), raw.raw_category_translation(spark, sf))


@query
def dim_seller(spark, sf):
    return star.dim_seller(raw.raw_sellers(spark, sf), geography(spark, sf))


@query
def dim_payment_type(spark, sf):
    return star.dim_payment_type(raw.raw_order_payments(spark, sf))


@query
def dim_marketing_channel(spark, sf):
    return star.dim_marketing_channel(raw.raw_marketing_qualified_leads(spark, sf))


@query
def fact_orders(spark, sf):
    return star.fact_orders(
        raw.raw_orders(spark, sf),
        raw.raw_order_items(spark, sf),
        raw.raw_order_payments(spark, sf),
        raw.raw_order_reviews(spark, sf),
        dim_customer(spark, sf),
    )


def order_attributes(spark, sf):
    return star.order_attributes(raw.raw_orders(spark, sf), dim_customer(spark, sf))


@query
def fact_order_items(spark, sf):
    return star.fact_order_items(
        raw.raw_order_items(spark, sf), dim_product(spark, sf), dim_seller(spark, sf), order_attributes(spark, sf)
    )


@query
def fact_marketing_funnel(spark, sf):
    return star.fact_marketing_funnel(
        raw.raw_marketing_qualified_leads(spark, sf), raw.raw_closed_deals(spark, sf)
    )


@query
def fact_payments(spark, sf):
    return star.fact_payments(raw.raw_order_payments(spark, sf), order_attributes(spark, sf))


# --- marts ----------------------------------------------------------------------------


def revenue_inputs(spark, sf):
    return stg_order_items(spark, sf), stg_orders(spark, sf), stg_products(spark, sf), stg_customers(spark, sf)


@query
def mart_monthly_revenue(spark, sf):
    return marts.monthly_revenue(*revenue_inputs(spark, sf))


@query
def mart_monthly_revenue_repeated(spark, sf):
    """The mart over orders of which a third are stored twice, as repeated raw appends leave them."""
    orders = stg_orders(spark, sf)
    return marts.monthly_revenue(
        stg_order_items(spark, sf), orders.unionByName(orders.where("order_id % 3 = 0")),
        stg_products(spark, sf), stg_customers(spark, sf),
    )


@query
def mart_customer_lifetime_value(spark, sf):
    return marts.customer_lifetime_value(
        stg_orders(spark, sf), stg_order_items(spark, sf), stg_customers(spark, sf), end_date=raw.END_DATE
    )


@query
def mart_geo_performance(spark, sf):
    return marts.geo_performance(
        stg_orders(spark, sf),
        stg_order_items(spark, sf),
        stg_customers(spark, sf),
        stg_geolocation(spark, sf),
        raw.state_meta(spark, sf),
    )


@query
def mart_seller_performance(spark, sf):
    return marts.seller_performance(
        stg_order_items(spark, sf),
        stg_orders(spark, sf),
        stg_reviews(spark, sf),
        stg_sellers(spark, sf),
        stg_geolocation(spark, sf),
    )


@query
def mart_marketing_funnel(spark, sf):
    return marts.marketing_funnel(stg_marketing_leads(spark, sf))


@query
def mart_marketing_funnel_any(spark, sf):
    """Variant in which unconverted leads count as a NULL segment."""
    return marts.marketing_funnel(stg_marketing_leads(spark, sf), count_null_segments=True)


@query
def mart_logistics_performance(spark, sf):
    return marts.logistics_performance(
        stg_orders(spark, sf), stg_reviews(spark, sf), stg_customers(spark, sf), stg_geolocation(spark, sf)
    )


def product_inputs(spark, sf):
    return stg_order_items(spark, sf), stg_products(spark, sf), stg_orders(spark, sf), stg_reviews(spark, sf)


@query
def mart_product_performance(spark, sf):
    return marts.product_performance(*product_inputs(spark, sf))


@query
def product_aggregate(spark, sf):
    return marts.product_aggregate(*product_inputs(spark, sf))


@query
def repeat_buyers(spark, sf):
    return marts.repeat_buyers(stg_order_items(spark, sf), stg_products(spark, sf), stg_orders(spark, sf))


# --- reports --------------------------------------------------------------------------


@query
def report_enriched_orders(spark, sf):
    return reports.enriched_orders(
        raw.raw_orders(spark, sf),
        raw.raw_order_items(spark, sf),
        raw.raw_order_reviews(spark, sf),
        raw.raw_customers(spark, sf),
    )


def valued_orders(spark, sf):
    return reports.with_values(reports.timed_orders(raw.raw_orders(spark, sf)), raw.raw_order_items(spark, sf))


@query
def report_monthly_trend(spark, sf):
    return reports.monthly_trend(valued_orders(spark, sf))


@query
def report_peak_month(spark, sf):
    return reports.peak_month(valued_orders(spark, sf))


@query
def rfm_qcut_scores(spark, sf):
    return reports.rfm_scores(valued_orders(spark, sf))


@query
def report_rfm_segments(spark, sf):
    return reports.rfm_segments(valued_orders(spark, sf))


def lead_inputs(spark, sf):
    return raw.raw_marketing_qualified_leads(spark, sf), raw.raw_closed_deals(spark, sf)


@query
def report_channel_conversion(spark, sf):
    return reports.channel_conversion(*lead_inputs(spark, sf))


@query
def report_overall_conversion(spark, sf):
    return reports.overall_conversion(*lead_inputs(spark, sf))


@query
def report_top_categories(spark, sf):
    return reports.top_categories(
        raw.raw_order_items(spark, sf), raw.raw_products(spark, sf), raw.raw_category_translation(spark, sf)
    )


@query
def report_delivery_histogram(spark, sf):
    return reports.delivery_histogram(reports.timed_orders(raw.raw_orders(spark, sf)))


@query
def report_delivery_summary(spark, sf):
    return reports.delivery_summary(reports.timed_orders(raw.raw_orders(spark, sf)))


@query
def report_late_rate_by_state(spark, sf):
    orders = reports.timed_orders(raw.raw_orders(spark, sf))
    return reports.late_rate_by_state(reports.with_places(orders, raw.raw_customers(spark, sf)))


@query
def report_seller_lorenz(spark, sf):
    return reports.seller_lorenz(raw.raw_order_items(spark, sf))


@query
def report_seller_tiers(spark, sf):
    return reports.seller_tiers(raw.raw_order_items(spark, sf))


@query
def report_state_demand(spark, sf):
    return reports.state_demand(report_enriched_orders(spark, sf))


@query
def report_payment_types(spark, sf):
    return reports.payment_types(raw.raw_order_payments(spark, sf))


@query
def report_installments(spark, sf):
    return reports.installments(raw.raw_order_payments(spark, sf))


@query
def report_business_summary(spark, sf):
    return reports.business_summary(report_enriched_orders(spark, sf), *lead_inputs(spark, sf))


# --- ranking operators on their own ------------------------------------------------------


@query
def global_ntile_customers(spark, sf):
    """Decile of every order account by spend, through the sliced global order."""
    spend = stg_order_items(spark, sf).join(stg_orders(spark, sf), "order_id").groupBy("customer_id").agg(
        F.sum("item_total").alias("spend")
    )
    return ranking.global_ntile(spend, [F.col("spend").desc(), F.col("customer_id").asc()], 10, "decile")


@query
def running_revenue_share(spark, sf):
    """Products by revenue with running and total revenue (Pareto curve)."""
    revenue = stg_order_items(spark, sf).groupBy("product_id").agg(F.sum("item_total").alias("revenue"))
    walked = ranking.running_totals(
        revenue, [F.col("revenue").desc(), F.col("product_id").asc()], sums=["revenue"]
    )
    share = percent(F.col("running_revenue"), F.col("total_revenue"), 3)
    return walked.select("product_id", "revenue", "row_no", "running_revenue", share.alias("cumulative_pct"))


@query
def exact_price_quantiles(spark, sf):
    """Exact median and 1 % / 99 % quantiles of item prices per category."""
    priced = stg_order_items(spark, sf).join(stg_products(spark, sf), "product_id")
    wanted = {"p01": 0.01, "median": 0.5, "p99": 0.99}
    found = summaries.exact_quantiles(priced, ["category_english"], "item_price", wanted)
    return found.select("category_english", *[rounded(F.col(n), 4).alias(n) for n in wanted])


@query
def distinct_orphan_zips(spark, sf):
    """Customer zips without a geolocation row: set difference of distinct keys."""
    return quality.orphan_keys(
        stg_customers(spark, sf), "zip_code_prefix", stg_geolocation(spark, sf), "zip_code_prefix"
    ).withColumnRenamed("key", "zip_code_prefix")


# --- incremental processing ----------------------------------------------------------------

FIRST_LOAD_END = "2001-03-15"  # the first run sees the orders before this day


def first_load(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("purchase_date") < F.lit(FIRST_LOAD_END).cast("date"))


@query
def incremental_lookback(spark, sf):
    """Orders a second run reads again: from the newest stored month less one month."""
    orders = stg_orders(spark, sf)
    months = first_load(orders).select(F.trunc("purchase_date", "MM").alias("order_month"))
    return incremental.incremental_input(orders, months, "purchase_date", "order_month").select(
        "order_id", "purchase_date", "order_status"
    )


def refreshed_twice(spark, orders, details, build, keys, label):
    """Mart after a first run on early orders and a second run on all orders.

    ``details`` (items, reviews) land before each run, under the month of their order;
    ``build(orders, landed, cut)`` makes the mart.
    """
    path, landed = scratch_path(spark, label), scratch_path(spark, f"{label}-details")
    early = first_load(orders)

    def run(known, batch):
        history.land_by_month(batch, known, landed, "order_id", "purchase_date")
        return incremental.refresh(
            lambda recent, cut: build(recent, spark.read.parquet(landed), cut), known, path, "purchase_date", keys
        )

    run(early, details.join(early.select("order_id"), "order_id", "left_semi"))
    return run(orders, details.join(early.select("order_id"), "order_id", "left_anti"))


@query
def merge_geo_by_key(spark, sf):
    def build(orders, items, cut):
        return marts.geo_performance(
            orders, cut(items, "order_id"), cut(stg_customers(spark, sf), "customer_id"),
            stg_geolocation(spark, sf), raw.state_meta(spark, sf),
        )

    return refreshed_twice(
        spark, stg_orders(spark, sf), stg_order_items(spark, sf), build, ["state_code", "order_month"], "geo"
    )


@query
def merge_logistics_by_key(spark, sf):
    def build(orders, reviews, cut):
        return marts.logistics_performance(
            orders, cut(reviews, "order_id"), cut(stg_customers(spark, sf), "customer_id"),
            stg_geolocation(spark, sf),
        )

    return refreshed_twice(
        spark, stg_orders(spark, sf), stg_reviews(spark, sf), build, ["customer_state", "order_month"], "logistics"
    )


def stored_delivery_sketches(spark, sf):
    """Monthly sketches after a first run on early orders and a second run that computes the lookback again."""
    orders, path = stg_orders(spark, sf), scratch_path(spark, "delivery")

    def run(known):
        def build(recent, cut):
            return delivery_times.monthly_sketches(recent, cut(stg_customers(spark, sf), "customer_id"))

        return incremental.refresh(build, known, path, "purchase_date", ["customer_state", "order_month"])

    run(first_load(orders))
    return run(orders)


@query
def delivery_quantiles_by_state(spark, sf):
    return delivery_times.quantiles_over(stored_delivery_sketches(spark, sf), ["customer_state"])


@query
def delivery_quantiles_by_year(spark, sf):
    year = F.year("order_month").alias("order_year")
    return delivery_times.quantiles_over(stored_delivery_sketches(spark, sf), [year])


@query
def landed_items(spark, sf):
    """Items per month of their order, as landed in two batches; items of unknown orders have no month."""
    orders, items = stg_orders(spark, sf), stg_order_items(spark, sf)
    early = first_load(orders)
    path = scratch_path(spark, "landed")
    history.land_by_month(items.join(early.select("order_id"), "order_id", "left_semi"), early, path, "order_id", "purchase_date")
    later = orders.where(F.col("order_id") % 10 != 0)
    history.land_by_month(items.join(early.select("order_id"), "order_id", "left_anti"), later, path, "order_id", "purchase_date")
    return spark.read.parquet(path).groupBy("order_month").agg(
        F.count(F.lit(1)).alias("items"), F.sum("item_total").cast("double").alias("revenue")
    )


@query
def append_new_orders(spark, sf):
    """Two loads, the second one repeated; every order is stored once."""
    orders = stg_orders(spark, sf)
    path = scratch_path(spark, "append")
    sinks.append_new(first_load(orders), path, "order_id")
    sinks.append_new(orders, path, "order_id")
    sinks.append_new(orders, path, "order_id")
    return spark.read.parquet(path)


@query
def append_opened_files(spark, sf):
    """Three loads of orders and whether the key index let them open old files: new keys, none; a repeated load, some."""
    orders = stg_orders(spark, sf)
    middle = orders.agg(F.max("order_id")).first()[0] // 2
    path = scratch_path(spark, "append")
    loads = []
    for load, rows in (("first", orders.where(F.col("order_id") <= middle)), ("new_keys", orders.where(F.col("order_id") > middle)), ("repeated", orders)):
        table = sinks.stored(spark, path)
        opened = [] if table is None else keyindex.files_to_open(spark, path, table, rows.select("order_id"), "order_id")
        loads.append((load, sinks.append_new(rows, path, "order_id"), bool(opened)))
    return spark.createDataFrame(loads, "load STRING, rows_added BIGINT, opened_old_files BOOLEAN")


@query
def append_new_items(spark, sf):
    """The same for items, which have no unique key: equal rows are kept as often as they occur."""
    items = stg_order_items(spark, sf)
    early = items.where(F.col("shipping_limit_date") < F.lit(FIRST_LOAD_END).cast("date"))
    path = scratch_path(spark, "append")
    sinks.append_new(early, path, within="shipping_limit_date")
    sinks.append_new(items, path, within="shipping_limit_date")
    sinks.append_new(items, path, within="shipping_limit_date")
    return spark.read.parquet(path)


@query
def append_null_keys(spark, sf):
    """Orders of which some have no key: those are kept as often as they occur, over two equal loads."""
    orders = stg_orders(spark, sf).select(
        F.when(F.col("order_id") % 9 != 0, F.col("order_id")).alias("order_id"), "customer_id", "order_status", "purchase_date"
    )
    path = scratch_path(spark, "append")
    sinks.append_new(first_load(orders), path, "order_id", within="purchase_date")
    sinks.append_new(orders, path, "order_id", within="purchase_date")
    sinks.append_new(orders, path, "order_id", within="purchase_date")
    return spark.read.parquet(path)


@query
def merge_null_month(spark, sf):
    """Even orders, then all of them merged by key; orders without a month keep a partition of their own."""
    orders = stg_orders(spark, sf).withColumn(
        "order_month", F.when(F.col("order_id") % 11 != 0, F.trunc("purchase_date", "MM"))
    )
    rows = orders.select("order_id", "order_status", "order_month")
    path = scratch_path(spark, "merge")
    incremental.upsert(rows.where("order_id % 2 = 0"), path, ["order_id"], "order_month")
    incremental.upsert(rows, path, ["order_id"], "order_month")
    return spark.read.parquet(path).select("order_id", "order_status", "order_month")


# --- sources and sinks ---------------------------------------------------------------------


def raw_tables(spark, sf):
    """Raw tables by dataset name."""
    return {
        "orders": raw.raw_orders(spark, sf),
        "order_items": raw.raw_order_items(spark, sf),
        "customers": raw.raw_customers(spark, sf),
        "products": raw.raw_products(spark, sf),
        "sellers": raw.raw_sellers(spark, sf),
        "payments": raw.raw_order_payments(spark, sf),
        "reviews": raw.raw_order_reviews(spark, sf),
        "category_translation": raw.raw_category_translation(spark, sf),
        "mql": raw.raw_marketing_qualified_leads(spark, sf),
        "closed_deals": raw.raw_closed_deals(spark, sf),
    }


def csv_folder(spark, sf, *names):
    """The given tables derived into CSV files, as the raw data would arrive."""
    folder = scratch_path(spark, "csv")
    tables = raw_tables(spark, sf)
    for name in names or tables:
        sinks.export_csv(files.to_raw_strings(tables[name], keep=()), f"{folder}/{DATASETS[name].file}")
    return folder


@query
def raw_landing_strings(spark, sf):
    """Payments from CSV through audit columns and the all-text landing table."""
    landed = files.to_raw_strings(files.with_audit(files.read_raw(spark, csv_folder(spark, sf, "payments"), "payments")))
    path = scratch_path(spark, "landing")
    sinks.full_refresh(landed, path)
    return spark.read.parquet(path).withColumn("has_source", F.col("_source_file").isNotNull()).drop(
        "_ingested_at", "_source_file"
    )


@query
def read_csv_typed(spark, sf):
    """Geolocation CSV with explicit types; the zip keeps its leading zeros."""
    path = scratch_path(spark, "geo-csv")
    sinks.export_csv(raw.raw_geolocation(spark, sf), path)
    return files.read_geolocation(spark, path)


@query
def read_csv_dates(spark, sf):
    """Orders CSV with its date columns parsed."""
    return files.read_with_dates(spark, csv_folder(spark, sf, "orders"), "orders").select(
        F.col("order_id").cast("bigint").alias("order_id"), "order_status", *DATE_COLUMNS["orders"]
    )


@query
def read_present_files(spark, sf):
    """Row counts of the datasets present; the missing ones are skipped."""
    folder = csv_folder(spark, sf, "orders", "sellers", "closed_deals")
    found = files.read_present(spark, folder)
    return assertions.row_counts(found).withColumnRenamed("mart", "dataset")


@query
def write_read_partitioned(spark, sf):
    """Orders fact stored by purchase month and clustered by state and status."""
    path = scratch_path(spark, "fact-orders")
    sinks.monthly_partitioned(fact_orders(spark, sf), path, "purchase_date", ["customer_state", "order_status"])
    return spark.read.parquet(path)


@query
def materialized_mart(spark, sf):
    """Seller mart materialised as a clustered table and read back."""
    return sinks.materialize(
        QUERIES["mart_seller_performance"](spark, sf), "mart_seller_performance", scratch_path(spark, "mart"),
        cluster_by=["seller_state", "seller_tier"],
    )


@query
def stored_models(spark, sf):
    """Every star table and mart stored as declared and read back: rows and months of its partitions."""
    counts = []
    builders = QUERIES | {"mart_monthly_revenue": lambda *at: marts.monthly_revenue(*revenue_inputs(*at), staged=True)}
    for name, layout in layouts.LAYOUTS.items():
        path = scratch_path(spark, name)
        with passing_scratch(spark):  # what a model stored on its way is not needed beside it
            stored = layouts.store(edge(builders[name](spark, sf)), name, path)
        month = layouts.partition_column(layout)
        counts.append(stored.agg(
            F.lit(name).alias("model"), F.lit(layout.kind).alias("kind"), F.count(F.lit(1)).alias("row_count"),
            (F.countDistinct(month) if month else F.lit(0).cast("bigint")).alias("months"),
        ))
    return quality.union_all(counts)


@query
def export_orders_json(spark, sf):
    facts = edge(fact_orders(spark, sf))
    path = scratch_path(spark, "json")
    sinks.export_json(facts, path)
    return spark.read.schema(facts.schema).json(path)


@query
def load_manifest(spark, sf):
    """Manifest of a full load of all datasets."""
    manifest = ingest.ingest(spark, csv_folder(spark, sf), scratch_path(spark, "raw"))
    return manifest.select("dataset", "table", "rows", "status")


@query
def load_manifest_dry_run(spark, sf):
    """Dry run over a folder that lacks two datasets: counted, nothing written."""
    folder = csv_folder(spark, sf, "orders", "customers", "products")
    names = ["orders", "customers", "products", "sellers", "mql"]
    manifest = ingest.ingest(spark, folder, scratch_path(spark, "raw"), datasets=names, dry_run=True)
    return manifest.select("dataset", "rows", "status")


@query
def source_hash_gate(spark, sf):
    """Four runs over one source: loaded, skipped, forced after a target is lost, loaded again when changed."""
    folder = scratch_path(spark, "gate")
    source, target = f"{folder}/source", f"{folder}/target"
    sinks.export_csv(raw.raw_geolocation(spark, sf), source)

    def run(target_path):
        def load():
            points = files.read_geolocation(spark, source)
            sinks.full_refresh(points, target_path)
            return {"rows_raw": spark.read.parquet(target_path).count()}

        # ranges far smaller than a file, so that each file is hashed as a tree
        return ingest.run_gated(spark, source, f"{folder}/state", f"{folder}/audit", [target_path], load, range_bytes=1 << 14)

    runs = [("first", run(target)), ("repeated", run(target)), ("target_missing", run(f"{target}-new"))]
    sinks.export_csv(raw.raw_geolocation(spark, sf).where("geolocation_lat < 5.3"), source)
    runs.append(("changed", run(target)))
    steps = spark.createDataFrame([(step, record["run_id"]) for step, record in runs], "step STRING, run_id STRING")
    # what the audit kept of these runs
    return steps.join(ingest.run_history(spark, f"{folder}/audit"), "run_id").select(
        "step", "status", F.coalesce("rows_raw", F.lit(0)).cast("bigint").alias("rows_loaded")
    )


@query
def read_csv_quoted(spark, sf):
    """Reviews with line breaks and quotes in their text, written as CSV and read back by small byte ranges."""
    note = F.concat(
        F.lit('said "'), F.col("review_id").cast("string"), F.lit('", twice:\n"'), F.col("review_score").cast("string"), F.lit('"\n\n, end')
    )
    reviews = raw.raw_order_reviews(spark, sf).select(
        F.col("review_id").cast("string"), F.col("order_id").cast("string"), F.when(F.col("order_id") % 3 != 0, note).alias("note")
    )
    path = scratch_path(spark, "reviews-csv")
    sinks.export_csv(reviews, path)
    return ranges.read_quoted(spark, path, range_bytes=1 << 13).drop("_source_file")


@query
def geography_load(spark, sf):
    """Checked loads of a clean, a fatal and a doubtful source, and what stands in the tables after each."""
    points, expect = raw.raw_geolocation(spark, sf), geo_expectations()
    low, high, west, east = expect.box
    inside = F.col("geolocation_lat").between(low, high) & F.col("geolocation_lng").between(west, east)
    lost = F.when(F.col("geolocation_zip_code_prefix").cast("int") % 10 != 0, F.col("geolocation_state"))
    folder = scratch_path(spark, "geography")
    steps = []
    for step, source in (("clean", points.where(inside)), ("fatal", points.withColumn("geolocation_state", lost)), ("doubtful", points)):
        sinks.export_csv(source, f"{folder}/source")
        try:
            record = geo_load.load_geography(spark, f"{folder}/source", f"{folder}/tables", raw.state_meta(spark, sf), expect)
            status, warnings = record["status"], len(record["warnings"])
        except geo_load.LoadStopped:
            status, warnings = "stopped", 0
        stored = [spark.read.parquet(f"{folder}/tables/{t}").count() for t in ("raw_geolocation", "dim_geography")]
        steps.append((step, status, *stored, warnings))
    found = spark.createDataFrame(steps, "step STRING, status STRING, raw_rows BIGINT, dimension_rows BIGINT, warnings BIGINT")
    return found.withColumn("audited_runs", F.lit(ingest.run_history(spark, f"{folder}/tables/_audit").count()))


@query
def dq_gate(spark, sf):
    """Whether two suites let a run go on: one that holds most payment types to be errors, one on the orders' key."""
    tables = raw_tables(spark, sf)
    suites = {
        "payments_strict": quality.run_checks(tables["payments"], "payments", [quality.InSet("payment_type", ("boleto", "voucher"))]),
        "orders_keyed": quality.run_checks(tables["orders"], "orders", [quality.NotNull("order_id"), quality.Unique("order_id")]),
    }
    rows = [(name, quality.may_proceed(results)) for name, results in suites.items()]
    return spark.createDataFrame(rows, "suite STRING, may_proceed BOOLEAN")


# --- data quality ---------------------------------------------------------------------------

TEST_STATES = tuple(f"NATION_{i}" for i in range(25))
TEST_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@query
def dq_core_suite(spark, sf):
    return quality_core.core_suite(raw_tables(spark, sf)).drop("category", "severity")


def report_file(spark, results, label):
    """Check results written as a JSON report and read back."""
    path = scratch_path(spark, label)
    sinks.export_json(results, path)
    return spark.read.schema(results.schema).json(path)


@query
def dq_core_report(spark, sf):
    return report_file(spark, dq_core_suite(spark, sf), "core-report")


@query
def dq_geo_report(spark, sf):
    return report_file(spark, dq_geo_suite(spark, sf), "geo-report")


@query
def dq_core_summary(spark, sf):
    return quality.summarize(quality_core.core_suite(raw_tables(spark, sf)))


@query
def dq_core_failures(spark, sf):
    """Failing checks when the undefined payment type and repeated reviews are held to be errors."""
    t = raw_tables(spark, sf)
    return quality.failures(
        quality.union_all([
            quality.run_checks(t["payments"], "payments", [quality.InSet("payment_type", labels.PAYMENT_TYPES)]),
            quality.run_checks(t["reviews"], "reviews", [quality.Unique("review_id"), quality.Unique("order_id")]),
            quality.run_checks(t["orders"], "orders", [
                quality.NotNull("order_delivered_customer_date", 0.2),
                quality.Rule("needs_delivery", "order_delivered_customer_date IS NOT NULL", 10),
                quality.Rule("broken", "no_such_column > 0"),
                quality.Rule("unreadable", "CAST(order_status AS INT) > 0"),  # fails on the first row it meets
            ]),
            quality.run_checks(t["order_items"], "order_items", [
                quality.Between("price", low=1000, high=90000),
                quality.References("order_id", t["closed_deals"], "mql_id", "closed_deals"),
            ]),
        ])
    ).drop("category", "severity")


@query
def dq_won_after_contact(spark, sf):
    leads, deals = lead_inputs(spark, sf)
    return quality_core.won_after_contact(leads, deals).drop("category", "severity")


def geo_expectations():
    return quality_geo.GeoExpectations(states=TEST_STATES, largest_state="NATION_0")


@query
def dq_geo_suite(spark, sf):
    points = raw.raw_geolocation(spark, sf)
    results = quality_geo.geo_suite(
        points,
        deduped=stg_geolocation(spark, sf),
        customer_zips=raw.raw_customers(spark, sf).select("customer_zip_code_prefix"),
        expect=geo_expectations(),
    )
    return results.select("check_id", "severity", "status", "passed", "rows_affected", "detail")


@query
def dq_geo_preload(spark, sf):
    return quality_geo.geo_preload(raw.raw_geolocation(spark, sf), geo_expectations())


@query
def dq_schema_validation(spark, sf):
    """Row count and warnings of the load-time validation, key check on a repeated column included."""
    rows = []
    for name, df in raw_tables(spark, sf).items():
        dataset = DATASETS[name]
        if name == "reviews":
            dataset = replace(dataset, primary_key="review_id")
        if name == "mql":
            dataset = replace(dataset, required=(*dataset.required, "landing_page_id"))
        if name == "orders":
            dataset = replace(dataset, required=(*dataset.required, "order_delivered_customer_date"))
        count, warnings = ingest.validate_schema(df, dataset)
        rows.append((name, count, len(warnings), "; ".join(warnings)))
    return spark.createDataFrame(rows, "dataset STRING, rows BIGINT, warnings BIGINT, detail STRING")


# --- table tests ----------------------------------------------------------------------------


def tested_tables(spark, sf):
    names = ("stg_orders", "stg_order_items", "stg_customers", "stg_products", "stg_sellers", "stg_payments",
             "stg_reviews", "stg_marketing_leads", "stg_geolocation", *MARTS)
    return {"raw_orders": raw.raw_orders(spark, sf), **{n: QUERIES[n](spark, sf) for n in names}}


MARTS = (
    "mart_monthly_revenue", "mart_customer_lifetime_value", "mart_geo_performance", "mart_seller_performance",
    "mart_marketing_funnel", "mart_logistics_performance", "mart_product_performance",
)


@query
def table_tests(spark, sf):
    """All declared staging and mart tests, one row each."""
    return tests.run_table_tests(tested_tables(spark, sf), tests.declared_tests(TEST_STATES, TEST_REGIONS))


@query
def test_unique(spark, sf):
    return assertions.unique_violations(stg_reviews(spark, sf), "review_id")


@query
def test_not_null(spark, sf):
    return assertions.not_null_violations(stg_marketing_leads(spark, sf), "origin").select("mql_id", "origin")


@query
def test_accepted_values(spark, sf):
    return assertions.accepted_values_violations(
        raw.raw_order_payments(spark, sf), "payment_type", labels.PAYMENT_TYPES
    )


@query
def test_expression(spark, sf):
    return assertions.expression_violations(stg_orders(spark, sf), "delivery_days > 0 OR delivery_days IS NULL").select(
        "order_id", "delivery_days"
    )


@query
def test_accepted_range(spark, sf):
    return assertions.range_violations(stg_reviews(spark, sf), "review_score", 2, 4).select(
        "review_id", "order_id", "review_score"
    )


@query
def test_unique_combination(spark, sf):
    return assertions.combination_violations(stg_order_items(spark, sf), ["order_id", "order_item_id"])


@query
def test_orphans(spark, sf):
    return assertions.orphan_rows(raw.raw_order_items(spark, sf), raw.raw_orders(spark, sf), "order_id")


@query
def test_orders_without_items(spark, sf):
    return assertions.orphan_rows(raw.raw_orders(spark, sf), raw.raw_order_items(spark, sf), "order_id")


@query
def test_payment_totals(spark, sf):
    return assertions.payment_total_violations(fact_orders(spark, sf), fact_payments(spark, sf))


@query
def test_mart_counts(spark, sf):
    return assertions.row_counts({name: QUERIES[name](spark, sf) for name in MARTS})


@query
def test_rfm_coverage(spark, sf):
    return assertions.unsegmented(mart_customer_lifetime_value(spark, sf))


@query
def test_geo_box(spark, sf):
    """Zips outside a narrower box than the one used for cleaning."""
    return assertions.outside_box(dim_geography(spark, sf), (-25.0, -5.0, -74.0, -28.0))


@query
def test_future_orders(spark, sf):
    return assertions.orders_after(stg_orders(spark, sf), "2001-06-30")
