"""Whitening of embeddings with distributed block matrices.

Components become integers, and each distinct integer vector is one row of the fit. The centred rows
are indexed without gaps into a distributed ``BlockMatrix``; its transpose times itself is the scatter
matrix, a square of the vectors' width, which is decomposed locally. The rows times the whitening
matrix give the projections. Both products run over blocks; the one over the rows is cut along the rows, so
that no task sees them all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.base import stored

COLUMNS = "vec_id {}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
LOCAL_ROWS = (1 << 33) - 1  # bits of a row's place in its partition, in Spark's row numbers
LONG = 1 << 63


@dataclass(frozen=True)
class Settings:
    """``block``: rows and columns of a block; ``flat``: an eigenvalue below this share of the
    variance counts as none."""

    components: int = 4
    scale: int = 256
    block: int = 1024
    flat: float = 1e-13


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and ``x``, floor(scale * c) per component, of the rows whose vector is whole and finite.

    Shorter vectors are filled up with zeros; a component beyond 64 bits is the largest such number.
    """
    v = F.col("embedding")
    usable = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("bigint"))
    return vectors.where(usable).select("vec_id", whole.alias("x"))


def _numbered(distinct: DataFrame) -> DataFrame:
    """Column ``index``, gapless from 0: a row's place in its partition after the rows of earlier ones.

    The sizes of partitions are one row per partition, as many as Spark was told to shuffle into.
    """
    rows = stored(distinct.withColumn("row", F.monotonically_increasing_id()), "whitening-distinct")
    part = F.shiftright("row", 33).cast("int")
    sizes = rows.groupBy(part.alias("part")).agg(F.max(F.col("row").bitwiseAND(LOCAL_ROWS)).alias("last")).orderBy("part").collect()
    starts, before = [], 0
    for size in sizes:
        starts.append((size["part"], before))
        before += size["last"] + 1
    known = F.broadcast(rows.sparkSession.createDataFrame(starts, "part int, start bigint"))
    return rows.withColumn("part", part).join(known, "part").select("x", (F.col("start") + F.col("row").bitwiseAND(LOCAL_ROWS)).alias("index"))


def _deviation(n: int, sums: list[int]) -> Column:
    """Sum over the dimensions of (n * x - S) ** 2, exact; null where it leaves 64 bits."""
    if any(not -LONG <= s < LONG for s in sums):
        return F.lit(None).cast("bigint")
    from_mean = F.zip_with("x", F.array(*[F.lit(s).cast("bigint") for s in sums]), lambda x, s: F.try_subtract(F.try_multiply(F.lit(n).cast("bigint"), x), s))
    return F.aggregate(from_mean, F.lit(0).cast("bigint"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))


def _matrix(rows: DataFrame, n: int, width: int, block: int, columns: int) -> BlockMatrix:
    """Rows (index, values) as a distributed matrix, without leaving the JVM."""
    vectors = rows.select("index", array_to_vector("values").alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, width).toBlockMatrix(block, columns)


def _scatter(centred: BlockMatrix, splits: int) -> np.ndarray:
    """Transpose times itself; its middle dimension, the rows, is cut into ``splits`` parts."""
    turned = centred.transpose()
    # the Python method has no argument for the number of splits and would put all rows into one task
    product = turned._java_matrix_wrapper.call("multiply", centred._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, turned.rowsPerBlock, centred.colsPerBlock).toLocalMatrix().toArray()


def eigen(scatter: np.ndarray, n: int, components: int, flat: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Falling eigenvalues and their unit vectors (columns) of the covariance, and its trace."""
    covariance = (scatter + scatter.T) / (2 * n)
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1][:components], directions[:, ::-1][:, :components]
    trace = float(np.trace(covariance))
    return np.where(values > flat * trace, values, 0.0), directions, trace


def _projected(spark: SparkSession, centred: BlockMatrix, whitening: np.ndarray, block: int) -> DataFrame:
    """index and ``values``, the rows times the whitening matrix."""
    width, k = whitening.shape
    rows = spark.createDataFrame([(i, Vectors.dense(row.tolist())) for i, row in enumerate(whitening)], ["index", "vector"])
    product = centred.multiply(IndexedRowMatrix(rows, width, k).toBlockMatrix(min(block, width), k)).toIndexedRowMatrix()
    # as a DataFrame right away: the matrix's Python rows would take every row through Python
    found = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return found.select("index", vector_to_array("vector").alias("values"))


def _identity_error(projected: DataFrame, n: int, used: list[int]) -> float | None:
    """Largest absolute entry of the projections' covariance (centred, over n) minus the identity."""
    if not used:
        return None
    means = projected.agg(*[F.sum(F.col("values")[c]) / n for c in used]).first()
    pairs = [(i, j) for i in range(len(used)) for j in range(i + 1)]
    terms = [(F.col("values")[used[i]] - means[i]) * (F.col("values")[used[j]] - means[j]) for i, j in pairs]
    found = projected.agg(*[F.sum(t) / n for t in terms]).first()
    return float(max(abs(found[at] - (i == j)) for at, (i, j) in enumerate(pairs)))


def whiten(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of ``vectors`` (vec_id, embedding).

    A row for each component (from 1) of every row whose vector is neither null nor holds null or
    non-finite entries, also for repeated rows and null ids. Vectors narrower than the number of components
    have as many as they are wide. A component without variance has no whitened value (null) and explains
    nothing; ``explained`` is null where there is no variance at all. ``deviation`` is null where it leaves
    64 bits. An empty table, or one of empty vectors, gives an empty result.
    """
    s = settings
    spark = vectors.sparkSession
    schema = COLUMNS.format(vectors.schema["vec_id"].dataType.simpleString())
    rows = stored(integers(vectors, s.scale), "whitening-integers")
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return spark.createDataFrame([], schema)
    rows = rows.select("vec_id", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("x"))).alias("x"))

    fit = _numbered(rows.select("x").distinct())
    first = fit.agg(F.count("*"), *[F.sum(F.col("x")[d].cast("decimal(38,0)")) for d in range(width)]).first()
    n, sums = first[0], [int(v) for v in first[1:]]
    means = F.array(*[F.lit(total / n) for total in sums])
    fit = stored(
        fit.select("index", "x", _deviation(n, sums).alias("deviation"), F.zip_with("x", means, lambda x, m: x.cast("double") - m).alias("values")),
        "whitening-centred",
    )
    centred = _matrix(fit.select("index", "values"), n, width, s.block, min(s.block, width))
    splits = max(1, min(-(-n // s.block), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    values, directions, trace = eigen(_scatter(centred, splits), n, s.components, s.flat)
    whitening = directions / np.where(values > 0, np.sqrt(values), 1.0)
    used = [c for c in range(len(values)) if values[c] > 0]
    projected = stored(_projected(spark, centred, whitening, s.block), "whitening-projected")
    error = _identity_error(projected, n, used)

    parts = F.array(
        *[
            F.struct(
                F.lit(c + 1).alias("component"),
                (F.col("values")[c] if c in used else F.lit(None).cast("double")).alias("whitened"),
                F.lit(float(values[c]) / trace if trace > 0 else None).cast("double").alias("explained"),
            )
            for c in range(len(values))
        ]
    )
    facts = stored(
        fit.select("index", "x", "deviation").join(projected, "index").select("x", "deviation", parts.alias("parts")), "whitening-facts"
    )
    return (
        rows.join(facts, "x")
        .select("vec_id", "deviation", F.explode("parts").alias("part"))
        .select(
            "vec_id",
            "part.component",
            F.lit(n).cast("bigint").alias("n"),
            "deviation",
            "part.whitened",
            "part.explained",
            F.lit(error).cast("double").alias("identity_error"),
        )
    )
