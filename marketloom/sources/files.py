"""CSV sources. A path may be one file, a folder of part files or a glob."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import as_timestamp
from marketloom.sources import ranges
from marketloom.sources.registry import DATASETS, DATE_COLUMNS, GEOLOCATION_SCHEMA

log = logging.getLogger(__name__)

MALFORMED = "_malformed"


def dataset_path(data_dir: str, name: str, prefix: str = "") -> str:
    return f"{data_dir.rstrip('/')}/{prefix}{DATASETS[name].file}"


def read_raw(spark: SparkSession, data_dir: str, name: str, prefix: str = "") -> DataFrame:
    """A registered dataset as text columns named by the file's header."""
    path = dataset_path(data_dir, name, prefix)
    if DATASETS[name].multi_line:
        return ranges.read_quoted(spark, path).drop("_source_file")
    return spark.read.option("header", True).option("escape", '"').csv(path)


def read_landing(spark: SparkSession, data_dir: str, name: str, prefix: str = "") -> DataFrame:
    """A registered dataset as it lands: text columns, load time and file name of each row, and ``_malformed``,
    the line as it stands where it has too few or too many fields.

    Only the header is read here, for the columns' names. Files with quoted line breaks are read by byte ranges.
    """
    path = dataset_path(data_dir, name, prefix)
    if DATASETS[name].multi_line:
        return ranges.read_quoted(spark, path, malformed=MALFORMED).select("*", F.current_timestamp().alias("_ingested_at"))
    reader = spark.read.option("header", True).option("escape", '"')
    fields = T.StructType([*reader.csv(path).schema, T.StructField(MALFORMED, T.StringType())])
    return with_audit(reader.schema(fields).option("columnNameOfCorruptRecord", MALFORMED).csv(path))


def with_audit(df: DataFrame) -> DataFrame:
    """Load time and file name of each row; apply directly to a file scan."""
    return df.select("*", F.current_timestamp().alias("_ingested_at"), F.col("_metadata.file_name").alias("_source_file"))


def to_raw_strings(df: DataFrame, keep: Iterable[str] = ("_ingested_at",)) -> DataFrame:
    """Every column as text, NULL stays NULL; the load time keeps its type."""
    kept = set(keep)
    return df.select(*[F.col(c) if c in kept else F.col(c).cast("string").alias(c) for c in df.columns])


def read_geolocation(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GEOLOCATION_SCHEMA).option("header", True).csv(path)


def read_with_dates(spark: SparkSession, data_dir: str, name: str, prefix: str = "") -> DataFrame:
    """A registered dataset with its date columns parsed; unreadable dates become NULL."""
    raw = read_raw(spark, data_dir, name, prefix)
    dates = [c for c in DATE_COLUMNS.get(name, ()) if c in raw.columns]
    return raw.withColumns({c: as_timestamp(c) for c in dates}) if dates else raw


def read_present(
    spark: SparkSession, data_dir: str, names: Iterable[str] | None = None, prefix: str = ""
) -> dict[str, DataFrame]:
    """The datasets whose files exist; a missing one is skipped with a warning."""
    found: dict[str, DataFrame] = {}
    for name in names or DATASETS:
        try:
            found[name] = read_raw(spark, data_dir, name, prefix)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("no file for dataset %s in %s, skipped", name, data_dir)
    return found
