from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(c: str) -> Column:
    """Typed or text timestamp without a zone; NULL when it cannot be read."""
    return F.col(c).try_cast("timestamp_ntz")


def day_of(c: str) -> Column:
    return as_timestamp(c).cast("date")


def days_between(later: Column, earlier: Column) -> Column:
    """Calendar days between two dates."""
    return F.datediff(later, earlier)


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two timestamps, floored (-1 for half a day back).

    Calendar days, less one when that many days after ``earlier`` is past ``later``.
    """
    days = F.datediff(later, earlier)
    overshoot = (earlier + F.make_dt_interval(days)) > later
    return days - F.when(overshoot, 1).otherwise(0)


def month_start(c: Column | str) -> Column:
    return F.trunc(c, "MM")


def week_from_sunday(c: Column) -> Column:
    """Week of the year with Sunday as first day; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(c) + 7 - F.dayofweek(c)) / 7).cast("int")
