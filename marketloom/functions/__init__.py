from marketloom.functions.dates import (
    as_timestamp,
    day_of,
    days_between,
    elapsed_days,
    month_start,
    week_from_sunday,
)
from marketloom.functions.numbers import (
    clipped,
    decimal_places,
    edge,
    mean,
    money,
    money_sum,
    percent,
    ratio,
    rounded,
    to_float,
    to_int,
)
from marketloom.functions.text import lower_trim, title_words, upper_trim, zero_filled

__all__ = [
    "as_timestamp",
    "clipped",
    "day_of",
    "days_between",
    "decimal_places",
    "edge",
    "elapsed_days",
    "lower_trim",
    "mean",
    "money",
    "money_sum",
    "month_start",
    "percent",
    "ratio",
    "rounded",
    "title_words",
    "to_float",
    "to_int",
    "upper_trim",
    "week_from_sunday",
    "zero_filled",
]
