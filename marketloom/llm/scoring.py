"""Applying a small broadcast model to every whole text, shared by the two classifiers.

Only the texts go to Python and only one number per row comes back; all other columns stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm.base import Slice, give_back, slices, text_runs

SLICE_CHARS = 500_000

Score = Callable[[Iterator[Slice], int], np.ndarray]


def score_of(text: str, score: Score) -> Column:
    """A number for every row's text; ``score`` maps the slices of n texts to n numbers."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = [score(slices(texts, SLICE_CHARS), len(texts)) for _, texts in text_runs(column)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
        give_back()

    # named nondeterministic so that a score that is filtered by and returned is computed once
    return F.arrow_udf(run, T.DoubleType()).asNondeterministic()(F.col(text))


def scored(docs: DataFrame, id_column: str, score: Score) -> DataFrame:
    """Column ``id_column`` and ``score`` for every row."""
    return docs.select(id_column, score_of("text", score).alias("score"))


def with_prediction(docs: DataFrame, name: str, threshold: float, score: Score) -> DataFrame:
    """The rows of ``docs`` with ``name``, 1 where their own score reaches the threshold, else 0."""
    return docs.withColumn(name, (score_of("text", score) >= threshold).cast("int"))


def held_out(id_column: str, mod: int, rest: int):
    """Whether crc32 of the id as text leaves ``rest``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % mod == rest, F.lit(False))
