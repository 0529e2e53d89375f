"""What the operators of this subpackage share: tables, stored stages, bounded training samples."""

from __future__ import annotations

import ctypes
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import scratch_path

_BLANK = re.compile(r"\s")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back, which also cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_runs(texts: pa.Array, limit: int = 4_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """The texts of a batch's column in runs of about ``limit`` bytes, each with its first row.

    A batch can hold tens of megabytes; only one run of it at a time becomes Python strings.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(texts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield begin, texts.slice(begin, end - begin).to_pylist()
        begin = end


def give_back() -> None:
    """Return freed memory to the system: a worker lives on between tasks, also those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def parts_for(rows: int, per_part: int) -> int:
    """Number of parts of about ``per_part`` rows; grows with the rows."""
    return max(1, -(-rows // per_part))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, holdout_mod: int, holdout_rest: int, rows: int, max_chars: int
) -> Iterator[tuple[str, int]]:
    """At most ``rows`` labelled training texts with their 0/1 label, in a seeded order, one by one.

    Rows whose crc32(doc_id as text) leaves ``holdout_rest`` modulo ``holdout_mod`` are held
    out. The ids are chosen from the labels first (a bounded top-k), so that only the texts of
    chosen rows move; at most ``rows`` texts of at most ``max_chars`` characters reach the driver.
    Labels other than 0 and 1, null texts and null ids take no part.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % holdout_mod
    known = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("doc_id").isNotNull() & F.col("_label").isin(0, 1) & (remainder != holdout_rest))
        .distinct()
    )
    order = F.xxhash64("doc_id", F.lit(17))
    chosen = known.orderBy(order, "doc_id", "_label").limit(rows)
    texts = (
        docs.select("doc_id", F.col("text").alias("_text"))
        .where(F.col("_text").isNotNull() & (F.length("_text") <= max_chars))
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "_text", "_label")
        .orderBy(order, "_label", "_text")
        .limit(rows)
    )
    for row in texts.select("_text", "_label").toLocalIterator():
        yield row["_text"], row["_label"]


class Bags:
    """Bags of n-gram buckets of many texts, with a weight each, in one growing buffer."""

    def __init__(self) -> None:
        self._ids, self._weights, self._ends = array("i"), array("f"), [0]

    def add(self, ids: np.ndarray, weights: np.ndarray | None = None) -> None:
        self._ids.frombytes(ids.astype(np.int32).tobytes())
        if weights is not None:
            self._weights.frombytes(weights.astype(np.float32).tobytes())
        self._ends.append(len(self._ids))

    def __len__(self) -> int:
        return len(self._ends) - 1

    def ids(self, i: int) -> np.ndarray:
        return np.frombuffer(self._ids, np.int32)[self._ends[i] : self._ends[i + 1]]

    def weights(self, i: int) -> np.ndarray:
        return np.frombuffer(self._weights, np.float32)[self._ends[i] : self._ends[i + 1]]


@dataclass
class Slice:
    """Some texts, or parts of long ones, to be handled together.

    ``owners`` holds each text's row, ``own`` how many of its characters count: what follows
    them is only there so that n-grams across a cut are whole.
    """

    owners: list[int] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    own: list[int] = field(default_factory=list)


def slices(texts: Iterable[str | None], limit: int, ahead: int = 2_000) -> Iterator[Slice]:
    """All texts (null: empty) in slices of about ``limit`` characters, so memory is bounded.

    A longer text is cut after a blank, or at twice the limit where there is none, and each part
    sees ``ahead`` characters of the next one. Only a word of over half that length right at a
    cut is seen as a shorter one.
    """
    now, size = Slice(), 0
    for owner, whole in enumerate(texts):
        text, begin = whole or "", 0
        while True:
            end = len(text)
            if end - begin > limit:
                blank = _BLANK.search(text, begin + limit, begin + 2 * limit)
                end = blank.end() if blank else min(end, begin + 2 * limit)
            if now.texts and size + end - begin > limit:
                yield now
                now, size = Slice(), 0
            now.owners.append(owner)
            now.texts.append(text[begin : end + ahead] if end < len(text) or begin else text)
            now.own.append(end - begin)
            size += end - begin
            begin = end
            if begin >= len(text):
                break
    if now.texts:
        yield now
