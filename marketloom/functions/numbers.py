"""Money, ratios and rounding that give the same digits on every engine and partitioning.

Money is DECIMAL(18,2) from staging on, so sums are exact in any order; doubles appear
only at the edge of a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"
_QUOTIENT = "decimal(38,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _within_range(parsed: Column, readable: Column, what: str) -> Column:
    """``parsed``, or an error where a readable finite number did not fit; text that is no number stays NULL."""
    lost = parsed.isNull() & readable.isNotNull() & ~F.isnan(readable) & (F.abs(readable) < float("inf"))
    return F.when(lost, F.raise_error(F.lit(f"{what} out of range"))).otherwise(parsed)


def money(c: Column | str) -> Column:
    """Parse to cents in one rounding, half away from zero; NULL when it is not a number.

    A number beyond the range of the money type is an error, never a silent NULL.
    """
    return _within_range(_col(c).try_cast(MONEY), _col(c).try_cast("double"), "amount")


def money_sum(a: Column | str, b: Column | str) -> Column:
    """Sum of two amounts, rounded once after adding.

    Amounts up to 11 digits before the point stay in 64-bit decimals; only larger ones
    take the wider and slower type.
    """
    narrow, wide = (_col(a).try_cast(t) + _col(b).try_cast(t) for t in ("decimal(17,6)", "decimal(24,6)"))
    readable = _col(a).try_cast("double") + _col(b).try_cast("double")
    return _within_range(F.coalesce(narrow, wide).try_cast(MONEY), readable, "amount")


def to_float(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def to_int(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def rounded(c: Column, digits: int) -> Column:
    """Round half away from zero, decided on decimal digits rather than on binary ones."""
    return F.round(c.try_cast(_QUOTIENT), digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    return rounded(ratio(numerator, denominator) * 100, digits)


def mean(c: Column | str) -> Column:
    """Average of an exact numeric column: exact sum, then one division."""
    c = _col(c)
    return ratio(F.sum(c), F.count(c))


def clipped(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def decimal_places(c: Column) -> Column:
    """Digits after the point in the printed number, 0 without a point."""
    text = c.cast("string")
    return F.when(text.contains("."), F.length(F.substring_index(text, ".", -1))).otherwise(0)


def edge(df: DataFrame) -> DataFrame:
    """Result edge: exact decimals leave the library as doubles."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
