"""A pipeline over ``documents`` made of the operators in ``marketloom.llm``.

Each stage takes (spark, docs, sf_dir) and is written and read again before the next one. A
stage works on all that its predecessor kept. ``QUERIES`` and ``SQL`` are what the library
registers for the operators and the pipeline.

The classifiers read their labels from ``labels`` and learn from those documents that are still
there. Mixing takes no document twice here: the join before it has just taken the copies out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import jaccard, mixing, packing, quality, toxicity
from marketloom.llm.base import stored, table
from marketloom.llm.oracle import SQL as OPERATOR_SQL
from marketloom.llm.queries import QUERIES as OPERATOR_QUERIES

MIXING = mixing.Settings(budget_share=0.9, max_epochs=1)


def _free(docs: DataFrame, name: str) -> str:
    """The name, or a longer one where the table has such a column."""
    while name in docs.columns:
        name += "_"
    return name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    predicted = _free(docs, "_predicted")
    return quality.predict(docs, table(spark, sf_dir, "labels"), predicted).where(F.col(predicted) != 0).select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    predicted = _free(docs, "_predicted")
    return toxicity.predict(docs, table(spark, sf_dir, "labels"), predicted).where(F.col(predicted) != 1).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the row of the smallest doc_id, rows without one last; rows are told apart by a stored number."""
    row = _free(docs, "_row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-numbered")
    named = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col(row).alias("row"))
    joined = stored(jaccard.join_similar(numbered.select(named.alias("doc_id"), "text")), "pipeline-groups")
    kept = F.col("doc_id.row") == F.col("class_id.row")
    left = numbered.join(joined.where(~kept).select(F.col("doc_id.row").alias(row)), row, "left_anti")
    # rows without words are in no group; of those that repeat id and text one stays
    ids = joined.where(kept & ~F.col("doc_id.missing")).select(F.col("doc_id.id").alias("doc_id"))
    repeated = ids.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return left.select(docs.columns)
    again = F.broadcast(repeated.select("doc_id")) if repeated.count() <= 100_000 else repeated.select("doc_id")
    return left.join(again, "doc_id", "left_anti").select(docs.columns).union(
        left.join(again, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, MIXING).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = (
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_group),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
)

#: No SQL can express the trained classifiers; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {**OPERATOR_QUERIES, "pipeline": run}
SQL = {**OPERATOR_SQL, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}
