from __future__ import annotations

import datetime as dt
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketloom.operators import assertions
from marketloom.operators.quality import (
    RESULT_COLUMNS,
    Between,
    InSet,
    NotNull,
    References,
    Rule,
    Unique,
    may_proceed,
    run_checks,
    summarize,
)
from marketloom.plans import quality_core, quality_geo
from marketloom.plans.table_tests import TableTest, declared_tests, run_table_tests


@pytest.fixture(scope="module")
def people(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), (None, None, "z"), (None, 9, None), ("b", -4, "w")]
    return spark.createDataFrame(rows, "k string, n int, s string")


def by_rule(df):
    return {(r["rule"], r["column"]): r for r in df.collect()}


def test_each_expectation(spark, people):
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "pk string")
    result = run_checks(
        people,
        "people",
        [
            NotNull("k"), NotNull("n", 0.2), Unique("k"), Between("n", 0, 5), InSet("s", ("x", "y")),
            References("k", parent, "pk", "parents"), Rule("small", "n < 5", 2), Rule("broken", "nope > 1"),
        ],
    )
    assert tuple(result.columns) == RESULT_COLUMNS
    got = by_rule(result)
    assert got["not_null", "k"]["rows_affected"] == 2 and not got["not_null", "k"]["passed"]
    assert got["not_null", "k"]["detail"] == "2 of 5 rows, at most 0.0% allowed"
    assert got["not_null", "n"]["passed"]  # one of five, exactly the limit
    assert got["unique", "k"]["rows_affected"] == 2  # a second "a" and a second NULL
    assert got["between", "n"]["rows_affected"] == 2  # NULL is not outside
    assert got["accepted_values", "s"]["detail"] == "2 rows, such as w, z"
    assert got["referential_integrity", "k"]["detail"] == "1 keys without a row in parents.pk"
    assert got["business_rule:small", "multiple"]["rows_affected"] == 2  # 9, and NULL counts as a violation
    assert got["business_rule:small", "multiple"]["passed"]
    assert got["business_rule:broken", "multiple"]["status"] == "FAIL"
    assert got["business_rule:broken", "multiple"]["detail"].startswith("cannot be evaluated: ")
    row = summarize(result).first()
    assert (row["total"], row["passed"], row["failed"], row["pass_rate"]) == (8, 2, 6, 25.0)
    assert not may_proceed(result)


def test_an_empty_table_fails_not_null_only(people):
    result = by_rule(run_checks(people.limit(0), "p", [NotNull("k"), Unique("k"), Between("n", 0, 1), InSet("s", ("x",))]))
    assert {k[0]: r["passed"] for k, r in result.items()} == {
        "not_null": False, "unique": True, "between": True, "accepted_values": True
    }


def test_numbers_may_come_as_text(spark):
    df = spark.createDataFrame([("10",), ("9",), ("-1",), ("x",), (None,)], "v string")
    assert run_checks(df, "t", [Between("v", low=0, high=9.5)]).first()["rows_affected"] == 2


def test_rules_with_null_status(spark):
    schema = "order_id string, customer_id string, order_status string, order_purchase_timestamp string, order_approved_at string"
    df = spark.createDataFrame([("1", "c", None, "t", None), ("2", "c", "approved", "t", None), ("3", "c", "approved", "t", "t")], schema)
    rows = by_rule(quality_core.orders({"orders": df})[0])
    assert rows["business_rule:approved_needs_timestamp", "multiple"]["rows_affected"] == 1
    assert rows["not_null", "order_status"]["rows_affected"] == 1


def test_one_late_contact_is_allowed(spark):
    leads = spark.createDataFrame([("a", "2018-01-02"), ("b", "2018-01-02"), ("c", "2018-01-02")], "mql_id string, first_contact_date string")
    deals = spark.createDataFrame([("a", "2018-01-01 00:00:00"), ("b", "2018-01-02 00:00:00")], "mql_id string, won_date string")
    assert quality_core.won_after_contact(leads, deals).first()["passed"]
    deals = deals.union(spark.createDataFrame([("c", None)], "mql_id string, won_date string"))
    assert not quality_core.won_after_contact(leads, deals).first()["passed"]


def test_only_loaded_datasets_are_checked(spark):
    sellers = spark.createDataFrame([("s", "SP")], "seller_id string, seller_state string")
    result = quality_core.core_suite({"sellers": sellers})
    assert result.count() == 3 and may_proceed(result)
    with pytest.raises(ValueError, match="nothing to validate"):
        quality_core.core_suite({})


# --- geolocation --------------------------------------------------------------------------

GEO = ("geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
       "geolocation_city string, geolocation_state string")


def geo_rows(n=400):
    rng = np.random.default_rng(5)
    return [
        (f"{1001 + i % 80:05d}", round(float(rng.uniform(-30, 4)), 5), round(float(rng.uniform(-70, -30)), 5),
         "cidade", "SP" if i % 3 else "RJ")
        for i in range(n)
    ]


def test_geo_suite_against_pandas(spark):
    rows = geo_rows() + [
        ("abc", 0.0, 0.0, "1", "XX"), (None, 95.0, -200.0, None, None), ("00500", 12.5, -50.1234, "x", ""),
        ("01001", None, -45.55, "  99 ", "sp "), ("100000", -10.1, None, "ok", "RJ"),
    ]
    df = spark.createDataFrame(rows, GEO)
    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in GEO.split(", ")])
    zips = spark.createDataFrame([("1001",), ("1002",), ("7",), (None,)], "z string")
    got = {r["check_id"]: r for r in quality_geo.geo_suite(df, df.limit(10), zips).collect()}
    assert len(got) == 30 and sorted(got) == [f"GEO-{i:02d}" for i in range(1, 31)]
    lat, lng = pdf["geolocation_lat"], pdf["geolocation_lng"]
    zip_no = pd.to_numeric(pdf["geolocation_zip_code_prefix"], errors="coerce")
    state = pdf["geolocation_state"].str.upper().str.strip()
    want = {
        "GEO-03": lat.isna().sum(), "GEO-04": lng.isna().sum(), "GEO-05": zip_no.isna().sum(),
        "GEO-06": pdf["geolocation_zip_code_prefix"].isna().sum(), "GEO-07": lat.isna().sum(),
        "GEO-08": lng.isna().sum(), "GEO-09": pdf["geolocation_city"].isna().sum(),
        "GEO-10": pdf["geolocation_state"].isna().sum(), "GEO-11": ((lat < -90) | (lat > 90)).sum(),
        "GEO-12": ((lng < -180) | (lng > 180)).sum(), "GEO-13": ((lat < -35) | (lat > 5.3)).sum(),
        "GEO-14": ((lng < -74) | (lng > -28)).sum(), "GEO-15": ((lat == 0) & (lng == 0)).sum(),
        "GEO-16": (lat > 10).sum(),
        "GEO-17": sum(len(str(x).split(".")[-1]) < 4 if "." in str(x) else True for x in lat),
        "GEO-18": (~state.isin({*quality_geo.STATE_CODES, ""})).sum(),
        "GEO-20": ((zip_no < 1001) | (zip_no > 99999)).sum(), "GEO-21": 1, "GEO-26": 3,
    }
    q1, q3 = lat.quantile([0.01, 0.99])
    want["GEO-27"] = ((lat < q1) | (lat > q3)).sum()
    q1, q3 = lng.quantile([0.01, 0.99])
    want["GEO-28"] = ((lng < q1) | (lng > q3)).sum()
    assert {k: got[k]["rows_affected"] for k in want} == want
    assert got["GEO-03"]["status"] == "FAIL" and got["GEO-05"]["status"] == "WARN" and got["GEO-16"]["status"] == "PASS"
    assert got["GEO-19"]["detail"].startswith(f"{state.nunique()}, expected")
    assert got["GEO-22"]["status"] == "PASS" and got["GEO-22"]["detail"] == "SP, expected SP"
    assert got["GEO-25"]["detail"] == f"{len(rows) / 10:.1f}, expected 40.0 to 60.0"
    assert got["GEO-29"]["detail"] == f"{lat.std():.3f}, expected 4.000 to 8.000"
    assert got["GEO-30"]["detail"] == f"{lng.std():.3f}, expected 3.000 to 6.000"
    assert not may_proceed(quality_geo.geo_suite(df))


def test_geo_suite_on_clean_points_and_skipped_checks(spark):
    df = spark.createDataFrame(geo_rows(), GEO)
    results = quality_geo.geo_suite(df)
    assert may_proceed(results)  # warnings do not stop a run
    skipped = {r["check_id"]: r for r in results.where("detail LIKE 'not checked%'").collect()}
    assert set(skipped) == {"GEO-21", "GEO-25"} and all(r["passed"] for r in skipped.values())


def test_geo_suite_without_a_column(spark):
    df = spark.createDataFrame(geo_rows(), GEO).drop("geolocation_city")
    rows = quality_geo.geo_suite(df).collect()
    assert [r["status"] for r in rows] == ["FAIL"] and "geolocation_city" in rows[0]["detail"]


def test_preload_levels(spark):
    rows = geo_rows(150)
    few = spark.createDataFrame([*rows, (None, -20.0, -45.0, "c", "SP")], GEO)
    found = {(r["level"], r["rule"]): r for r in quality_geo.geo_preload(few).collect()}
    assert found["warning", "nulls"]["rows_affected"] == 1 and quality_geo.preload_passed(quality_geo.geo_preload(few))
    many = few.union(spark.createDataFrame([(None, 50.0, -45.0, "c", "ZZ")] * 2, GEO))
    found = {(r["level"], r["rule"]): r["rows_affected"] for r in quality_geo.geo_preload(many).collect()}
    assert found["error", "nulls"] == 3 and found["warning", "lat_box"] == 2 and found["warning", "bad_state"] == 2
    assert found["stat", "rows"] == 153
    assert not quality_geo.preload_passed(quality_geo.geo_preload(many))


# --- assertions and declared tests ----------------------------------------------------------


def test_null_passes_table_tests(spark, people):
    assert assertions.expression_violations(people, "n > 0").count() == 1
    assert assertions.range_violations(people, "n", 0, 5).count() == 2
    assert assertions.accepted_values_violations(people, "s", ("x", "y")).count() == 2
    assert [r["k"] for r in assertions.unique_violations(people, "k").collect()] == ["a"]
    assert assertions.combination_violations(people, ["k"]).count() == 2  # NULL repeats as well
    assert assertions.not_null_violations(people, "k").count() == 2


def test_payment_totals(spark):
    orders = spark.createDataFrame([("a", 10.0), ("b", 5.0), ("c", 1.0)], "order_id string, total_payment_value double")
    lines = spark.createDataFrame([("a", 4.0), ("a", 6.0), ("b", 4.98)], "order_id string, payment_value double")
    assert [r["order_id"] for r in assertions.payment_total_violations(orders, lines).collect()] == ["b"]


def test_small_assertions(spark, people):
    assert [r["mart"] for r in assertions.empty_tables({"a": people, "b": people.limit(0)}).collect()] == ["b"]
    child = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert sorted(r["k"] or "" for r in assertions.orphan_rows(child, people, "k").collect()) == ["", "z"]
    dated = spark.createDataFrame([("o", dt.date(2019, 1, 1)), ("p", dt.date(2018, 12, 31))], "order_id string, purchase_date date")
    assert [r["order_id"] for r in assertions.orders_after(dated, "2018-12-31").collect()] == ["o"]
    clv = spark.createDataFrame([("u", None, "Low Value"), ("v", "Hibernating", "Low Value")],
                                "customer_unique_id string, rfm_segment string, value_tier string")
    assert [r[0] for r in assertions.unsegmented(clv).collect()] == ["u"]


def shuffle_files(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString("\n").count("shuffle_")


@pytest.mark.parametrize("run", [
    lambda t: assertions.row_counts(t),
    lambda t: run_table_tests(t, [TableTest(n, "unique", "id") for n in t]),
])
def test_tables_are_read_one_after_the_other(spark, run):
    """While a table is counted, the shuffles of those before it are gone: in one plan they would all stay."""
    spark.sparkContext._jvm.System.gc()
    time.sleep(1)
    before = shuffle_files(spark)
    tables = {f"t{i}": spark.range(1000, numPartitions=2).withColumn("id", F.col("id") % 700).groupBy("id").count().drop("count") for i in range(4)}
    rows = run(tables).collect()
    assert len(rows) == 4
    until = time.time() + 10
    while shuffle_files(spark) > before and time.time() < until:  # they are removed in the background
        time.sleep(0.1)
    assert shuffle_files(spark) <= before


def test_declared_tests_are_complete():
    tests = declared_tests()
    assert len(tests) == 109
    assert sum(t.table.startswith("mart_") for t in tests) == 69


def test_declared_test_statuses(spark, people):
    tests = [TableTest("p", "unique", "k"), TableTest("p", "not_null", "k", severity="warn"),
             TableTest("p", "accepted_range", "n", (-10, 10)), TableTest("p", "unique_combination", "k, n", ("k", "n"))]
    got = {(r["test"]): (r["failures"], r["status"]) for r in run_table_tests({"p": people}, tests).collect()}
    assert got == {"unique": (1, "FAIL"), "not_null": (2, "WARN"), "accepted_range": (0, "PASS"),
                   "unique_combination": (0, "PASS")}


def test_a_rule_that_fails_on_some_row_is_one_failed_check(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "c string")
    result = run_checks(df, "t", [NotNull("c"), Rule("readable", "CAST(c AS INT) > 0"), Rule("short", "length(c) < 3", 1)])
    got = by_rule(result)
    assert got["not_null", "c"]["rows_affected"] == 1
    assert got["business_rule:readable", "multiple"]["detail"] == "cannot be evaluated: CAST_INVALID_INPUT"
    assert got["business_rule:short", "multiple"]["passed"]


def test_only_a_failing_value_is_a_failed_rule(spark):
    """A job that dies for another reason ends the suite instead of failing its rules."""
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from marketloom.operators import quality

    rows = spark.createDataFrame([("1",), ("x",)], "v string")
    rules = [quality.Rule("number", "CAST(v AS INT) > 0"), quality.Rule("text", "v IS NOT NULL")]
    assert sorted(bool(r["passed"]) for r in quality.run_checks(rows, "t", rules).collect()) == [False, True]

    @F.udf("string")
    def lost(v):
        raise RuntimeError("this is no matter of a rule")

    with pytest.raises(PySparkException, match="no matter of a rule"):
        quality.run_checks(rows.withColumn("v", lost("v")), "t", rules[1:]).collect()
