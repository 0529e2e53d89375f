from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from marketloom.plans import marts, reports, staging, star

ORDERS = """order_id string, customer_id string, order_status string, order_purchase_timestamp string,
order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string,
order_estimated_delivery_date string"""


def order(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS)


def text_order(oid, status="delivered", bought="2018-01-01 10:00:00", delivered=None, promised="2018-01-10 00:00:00",
               customer="c1"):
    return (oid, customer, status, bought, None, None, delivered, promised)


def test_keys_are_required_and_void_status_is_three_valued(spark):
    raw = order(spark, text_order("a", customer=None), text_order(None), text_order("b", status=None), text_order("c"))
    orders = staging.stg_orders(raw)
    assert {r["order_id"] for r in orders.collect()} == {"b", "c"}
    assert [r["order_id"] for r in marts.valid_orders(orders).collect()] == ["c"]


def test_late_on_the_promised_day(spark):
    raw = order(
        spark,
        text_order("late", delivered="2018-01-10 10:00:00"),
        text_order("punctual", delivered="2018-01-10 00:00:00"),
        text_order("open"),
    )
    rows = {r["order_id"]: r for r in staging.stg_orders(raw).collect()}
    assert rows["late"]["is_late"] and rows["late"]["is_on_time"] is False
    assert (rows["late"]["delivered_date"] - rows["late"]["estimated_delivery_date"]).days == 0
    assert rows["punctual"]["is_on_time"] and not rows["punctual"]["is_late"]
    assert rows["open"]["is_on_time"] is None and rows["open"]["is_late"] is False
    assert rows["open"]["delivery_days"] is None and rows["late"]["delivery_days"] == 9


def test_item_money_from_text(spark):
    raw = spark.createDataFrame(
        [("o", 1, "p", "s", "2018-01-02 00:00:00", "0.285", "1.005"), ("o", 2, "p", "s", None, "x", "1"),
         ("o", 3, None, "s", None, "1", "1")],
        "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date string, "
        "price string, freight_value string",
    )
    rows = {r["order_item_id"]: r for r in staging.stg_order_items(raw).collect()}
    assert set(rows) == {1, 2}
    assert rows[1]["item_price"] == Decimal("0.29") and rows[1]["freight_value"] == Decimal("1.01")
    assert rows[1]["item_total"] == Decimal("1.29")  # rounded once, after the sum
    assert rows[2]["item_price"] is None and rows[2]["item_total"] is None


def test_product_names_fall_back(spark):
    raw = spark.createDataFrame(
        [("p1", "perfumaria", "40"), ("p2", "novo", "40.0"), ("p3", None, None)],
        "product_id string, product_category_name string, product_name_lenght string",
    )
    for c in ("product_description_lenght", "product_photos_qty", "product_weight_g", "product_length_cm",
              "product_height_cm", "product_width_cm"):
        raw = raw.selectExpr("*", f"'2.5' AS {c}")
    names = spark.createDataFrame([("perfumaria", "perfumery")],
                                  "product_category_name string, product_category_name_english string")
    rows = {r["product_id"]: r for r in star.dim_product(raw, names).collect()}
    assert [rows[p]["category_english"] for p in ("p1", "p2", "p3")] == ["perfumery", "novo", "Unknown"]
    assert rows["p1"]["product_name_length"] == 40 and rows["p2"]["product_name_length"] is None
    assert rows["p1"]["product_description_length"] is None and rows["p1"]["product_weight_g"] == 2.5
    assert rows["p1"]["volume_litres"] == 0.0


def test_strict_zip_cast_fails(spark):
    raw = spark.createDataFrame([("c", "u", "12x", "City", "sp")], "customer_id string, customer_unique_id string, "
                                "customer_zip_code_prefix string, customer_city string, customer_state string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_customers(raw).collect()


PAYMENTS = ("order_id string, payment_sequential int, payment_type string, payment_installments string, "
            "payment_value string")


def test_largest_payment_names_the_order(spark):
    raw = spark.createDataFrame(
        [("o", 1, "voucher", "1", "5.00"), ("o", 2, "boleto", "3", "5.00"), ("o", 3, "not_defined", "9", "99"),
         ("q", 1, "voucher", None, None), ("q", 2, "credit_card", "2", "0.10")],
        PAYMENTS,
    )
    rows = {r["order_id"]: r for r in star.order_payment_summary(raw).collect()}
    assert rows["o"]["primary_payment_type"] == "boleto"  # equal values: the smaller name
    assert rows["o"]["total_payment_value"] == Decimal("10.00") and rows["o"]["max_installments"] == 3
    assert rows["q"]["primary_payment_type"] == "credit_card"


def test_fact_keeps_orders_without_items(spark):
    raw = order(spark, text_order("a"), text_order("b", customer=None))
    items = spark.createDataFrame([], "order_id string, order_item_id int, product_id string, seller_id string, "
                                  "price string, freight_value string")
    reviews = spark.createDataFrame([("r1", "a", "3"), ("r1", "a", "5"), ("r2", "a", None)],
                                    "review_id string, order_id string, review_score string")
    customers = spark.createDataFrame([("c1", "SP", "Southeast")], "customer_id string, state_code string, region string")
    facts = star.fact_orders(raw, items, spark.createDataFrame([], PAYMENTS), reviews, customers)
    rows = {r["order_id"]: r for r in facts.collect()}
    assert len(rows) == 2
    assert rows["a"]["item_count"] == 0 and rows["a"]["payment_installments"] == 1 and rows["a"]["review_score"] == 5
    assert rows["a"]["primary_payment_type"] is None and rows["a"]["customer_state"] == "SP"
    assert rows["b"]["customer_state"] is None


def test_growth_uses_the_previous_present_month(spark):
    orders = staging.stg_orders(
        order(spark, text_order("a", bought="2018-01-05 00:00:00"), text_order("b", bought="2018-03-05 00:00:00"),
              text_order("z", bought="2018-04-05 00:00:00"), text_order("f", bought="2018-05-05 00:00:00"))
    )
    items = spark.createDataFrame(
        [("a", "p", "10.00"), ("a", "p", "10.00"), ("b", "p", "30.00"), ("z", "p", "0.00"), ("f", "p", "1.00")],
        "order_id string, product_id string, price string",
    ).selectExpr("order_id", "product_id", "CAST(price AS DECIMAL(18,2)) AS item_price",
                 "CAST(0 AS DECIMAL(18,2)) AS freight_value", "CAST(price AS DECIMAL(18,2)) AS item_total")
    products = spark.createDataFrame([("p", "toys")], "product_id string, category_english string")
    customers = spark.createDataFrame([("c1", "u")], "customer_id string, customer_unique_id string")
    rows = marts.monthly_revenue(items, orders, products, customers).orderBy("revenue_month").collect()
    assert [r["revenue_month"] for r in rows] == [dt.date(2018, m, 1) for m in (1, 3, 4, 5)]
    assert [r["prev_month_revenue"] for r in rows] == [None, 20.0, 30.0, 0.0]
    assert [r["mom_growth_pct"] for r in rows] == [None, 50.0, -100.0, None]
    assert [r["ytd_revenue"] for r in rows] == [20.0, 50.0, 50.0, 51.0]
    assert rows[0]["order_count"] == 1 and rows[0]["avg_order_value"] == 20.0 and rows[0]["avg_item_price"] == 10.0


def test_report_takes_the_first_review_and_marts_the_best(spark):
    reviews = spark.createDataFrame(
        [("r2", "a", "5", "2018-02-02"), ("r1", "a", "2", "2018-02-01"), ("r3", "a", "4", "2018-02-03")],
        "review_id string, order_id string, review_score string, review_creation_date string",
    )
    items = spark.createDataFrame([("a", 1, "p", "s", "1.10", "0.20")], "order_id string, order_item_id int, "
                                  "product_id string, seller_id string, price string, freight_value string")
    customers = spark.createDataFrame([("c1", "SP", "x")], "customer_id string, customer_state string, customer_city string")
    row = reports.enriched_orders(order(spark, text_order("a")), items, reviews, customers).first()
    assert row["review_score"] == 2 and row["is_late"] is False and row["total_value"] == Decimal("1.10")
    assert star.best_review(reviews).first()["review_score"] == 5


def test_geolocation_summary(spark):
    raw = spark.createDataFrame(
        [("01001", -23.0, -46.0, " São Paulo", "sp"), ("01001", -24.0, -47.0, "são paulo ", "SP"),
         ("01001", -25.0, -48.0, "osasco", "SP"), ("01001", 40.0, -46.0, "osasco", "SP"),
         ("01001", -23.0, -46.0, "osasco", "XX"), (None, -23.0, -46.0, "osasco", "SP"),
         ("69900", -9.0, -67.0, "rio-branco", "AC")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string",
    )
    rows = {r["zip_code_prefix"]: r for r in staging.stg_geolocation(raw, staging.states(spark)).collect()}
    assert set(rows) == {1001, 69900}
    first = rows[1001]
    assert (first["latitude"], first["longitude"], first["raw_row_count"]) == (-24.0, -47.0, 3)
    assert first["city"] == "São Paulo" and first["state_name"] == "São Paulo" and first["zip_code_formatted"] == "01001"
    assert rows[69900]["city"] == "Rio Branco" and rows[69900]["high_ecomm_penetration"] is False
    exact = {r["zip_code_prefix"]: r for r in staging.stg_geolocation_exact(raw, staging.states(spark)).collect()}
    assert exact[1001]["source_row_count"] == 4 and exact[1001]["latitude"] == -23.5
    assert exact[1001]["city"] == "osasco"  # two against two: the smaller name


@pytest.mark.parametrize("states_known", [True, False])
def test_unknown_state_defaults(spark, states_known):
    raw = spark.createDataFrame(
        [("5", -20.0, -45.0, "x", "ZZ")],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string",
    )
    table = staging.states(spark)
    if states_known:
        assert staging.stg_geolocation(raw, table).count() == 0
        assert star.dim_geography(raw, table).first()["region"] is None
    else:
        row = staging.stg_geolocation_exact(raw, table).first()
        assert row["region"] == "Unknown" and row["state_name"] == "Unknown" and row["is_frontier_market"] is True
