from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketloom.functions import (
    decimal_places,
    elapsed_days,
    money,
    percent,
    ratio,
    rounded,
    title_words,
    to_int,
    week_from_sunday,
    zero_filled,
)
from marketloom.functions.labels import CHANNEL_LABELS, PAYMENT_LABELS, STATES
from marketloom.plans.staging import states, zone_of
from marketloom.plans.star import dim_date, label


def one(spark, column, **values):
    row = {k: v for k, v in values.items()}
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()])
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("0.285", "0.29"), ("1.005", "1.01"), ("2.675", "2.68"), ("-0.285", "-0.29"), ("7", "7.00"), ("x", None),
     ("", None), (None, None)],
)
def test_money_is_rounded_on_decimal_digits(spark, text, want):
    got = one(spark, money("t"), t=text)
    assert got == (None if want is None else Decimal(want))


@pytest.mark.parametrize(("text", "want"), [("40", 40), ("40.0", None), ("x", None), ("", None), (None, None)])
def test_safe_integer_cast(spark, text, want):
    assert one(spark, to_int("t"), t=text) == want


def test_division_by_zero_is_null(spark):
    assert one(spark, ratio(F.col("a"), F.col("b")), a=1, b=0) is None
    assert one(spark, percent(F.col("a"), F.col("b"), 1), a=1, b=None) is None
    assert one(spark, percent(F.col("a"), F.col("b"), 1), a=1, b=8) == 12.5
    assert one(spark, rounded(F.lit(0.125), 2)) == 0.13


def test_week_starts_on_sunday_and_may_be_zero(spark):
    days = [dt.date(2016, 1, 1) + dt.timedelta(i) for i in range(1827)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.orderBy("d").select(week_from_sunday(F.col("d"))).collect()]
    assert got == [int(d.strftime("%U")) for d in days]


@pytest.mark.parametrize(
    ("later", "earlier", "want"),
    [("2020-01-03 00:00:00", "2020-01-01 00:00:00", 2), ("2020-01-02 23:59:59", "2020-01-01 00:00:00", 1),
     ("2020-01-01 00:00:00", "2020-01-02 23:00:00", -2), ("2020-01-01 12:00:00", "2020-01-01 13:00:00", -1),
     ("2020-01-01 00:00:00.000001", "2020-01-01 00:00:00", 0)],
)
def test_elapsed_days_are_floored(spark, later, earlier, want):
    stamp = "timestamp_ntz"
    got = one(spark, elapsed_days(F.col("a").cast(stamp), F.col("b").cast(stamp)), a=later, b=earlier)
    delta = dt.datetime.fromisoformat(later) - dt.datetime.fromisoformat(earlier)
    assert got == want == delta.days


def test_text_helpers(spark):
    assert one(spark, title_words(F.col("t"), "-"), t="sao-jose dos campos") == "Sao Jose Dos Campos"
    assert one(spark, zero_filled(F.col("z"), 5), z=1001) == "01001"
    assert one(spark, decimal_places(F.col("v")), v=-23.5475) == 4
    assert one(spark, decimal_places(F.col("v")), v=7) == 0


def test_zone_rules_in_order(spark):
    points = {(-20.0, -45.0): "Coastal", (-3.0, -60.0): "Amazon Basin", (-10.0, -60.0): "Central Plateau",
              (-20.0, -55.0): "Southern Cone", (-15.0, -45.0): "Central Plateau", (-5.0, -45.0): "Central Plateau"}
    for (lat, lng), want in points.items():
        assert one(spark, zone_of(F.col("lat"), F.col("lng")), lat=lat, lng=lng) == want


def test_labels_and_defaults(spark):
    names = {k: v[0] for k, v in PAYMENT_LABELS.items()}
    default = title_words(F.col("c"), "_")
    assert one(spark, label(F.col("c"), names, default), c="boleto") == "Boleto Bancário"
    assert one(spark, label(F.col("c"), names, default), c="gift_card") == "Gift Card"
    kinds = {k: v[1] for k, v in CHANNEL_LABELS.items()}
    assert one(spark, label(F.col("c"), kinds, F.lit("Other")), c="social") == "Paid"
    assert one(spark, label(F.col("c"), kinds, F.lit("Other")), c="unknown") == "Other"


def test_state_table(spark):
    rows = states(spark).collect()
    assert len(rows) == 27 and len({r["state_code"] for r in rows}) == 27
    assert sum(r["is_frontier_market"] for r in rows) == 17
    assert [tuple(r) for r in rows] == [tuple(s) for s in STATES]


def test_default_calendar(spark):
    rows = {r["full_date"]: r for r in dim_date(spark).collect()}
    assert len(rows) == 1827 and min(rows) == dt.date(2016, 1, 1) and max(rows) == dt.date(2020, 12, 31)
    christmas = rows[dt.date(2017, 12, 25)]
    assert christmas["is_public_holiday"] and christmas["is_weekday"] and christmas["half_year_label"] == "H2-2017"
    assert christmas["first_day_of_half_year"] == dt.date(2017, 7, 1) and christmas["day_of_week"] == 2
    sunday = rows[dt.date(2016, 1, 3)]
    assert not sunday["is_weekday"] and sunday["week_of_year"] == 1 and sunday["date_key"] == "20160103"


def test_amount_out_of_range_is_an_error(spark):
    assert one(spark, money("t"), t="no number") is None
    assert one(spark, money("t"), t="NaN") is None
    with pytest.raises(Exception, match="out of range"):
        one(spark, money("t"), t="12345678901234567.00")


def test_words_begin_behind_blanks_and_punctuation(spark):
    from pyspark.sql import functions as F

    from marketloom.functions.text import title_words

    rows = [("santa barbara d'oeste", "Santa Barbara D'oeste"), ("mogi-guacu", "Mogi Guacu"), ("são (joão) del rei/MG", "São (João) Del Rei/Mg"),
            ("st. john's_bay", "St. John's_Bay"), ("", ""), (None, None), ("  a,b", "  A,B")]
    df = spark.createDataFrame(rows, "c string, want string").select(title_words(F.col("c"), "-").alias("got"), "want")
    assert [(r["got"], r["got"] == r["want"]) for r in df.collect()] == [(want, True) for _, want in rows]
