"""The operators of this subpackage as registered queries, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import caps, jaccard, kneser, lexical, licenses, mixing, packing, quality, sharding, topk, toxicity, warc, whitening
from marketloom.llm.base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

QUERY_STEP = 50  # rows with a vec_id divisible by it ask for their neighbours


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


@query
def op2_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


@query
def op3_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = mixing.Settings()
    mixed = mixing.mix(table(spark, sf_dir, "documents"), settings)
    return mixing.with_leaf(mixed, settings).select(
        "doc_id",
        F.col("_domain").alias("domain"),
        F.col("_lang").alias("lang"),
        F.col("_source").alias("source"),
        mixing.tokens(F.col("text")).alias("tokens"),
        F.col(mixing.EPOCH).alias("epoch"),
    )


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(table(spark, sf_dir, "documents"))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents")).drop("detections")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.link_near(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


@query
def op10_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op11_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser.score_documents(table(spark, sf_dir, "documents"))


@query
def op12_length_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))
