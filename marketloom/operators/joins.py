from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def detached(df: DataFrame, key: str) -> DataFrame:
    """The small side of a later join on ``key``, given a shuffle boundary of its own.

    Adaptive execution splits a hot key only when both join inputs come straight from a
    shuffle. A side that is itself a join or grouping on the same key would keep its
    partitioning and switch that off, so its (narrow) rows are spread by another
    expression first.
    """
    return df.repartition(F.xxhash64(key))
