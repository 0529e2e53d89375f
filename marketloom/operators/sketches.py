"""Quantile sketches of bounded size over whole numbers, kept as a column and merged later.

A sketch (KLL) stands for the values of a group. It merges on the map side, it can be stored in a table, and
sketches of parts (months, files, loads) merge into one of the whole without the rows. Its size follows from
``size``, not from the rows: about 80 KB with the default. Up to ``size`` values it is exact; beyond, the rank
of a returned value is off by at most 0.07 % of the values (with 99 % confidence). A quantile is a value that
occurs: the smallest one whose rank reaches the share. Values are 64-bit integers, money is passed in cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIZE = 4096


def quantile_sketch(values: Column | str, size: int = SIZE) -> Column:
    """Aggregate: the sketch of a group's values; NULLs are left out."""
    return F.kll_sketch_agg_bigint(values, size)


def merged_sketch(sketches: Column | str, size: int = SIZE) -> Column:
    """Aggregate: one sketch for all values behind a group's sketches."""
    return F.kll_merge_agg_bigint(sketches, size)


def sketch_count(sketch: Column | str) -> Column:
    """Number of values behind a sketch."""
    return F.kll_sketch_get_n_bigint(sketch)


def sketch_quantile(sketch: Column | str, share: float) -> Column:
    """The quantile of a sketch; NULL where it stands for no value."""
    return F.when(sketch_count(sketch) > 0, F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(share))))
