"""Loading raw files: schema validation, landing write, manifest, content gate and run audit."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketloom.operators.summaries import duplicate_rows
from marketloom.sources import publish, ranges
from marketloom.sources.files import MALFORMED, dataset_path, read_landing, to_raw_strings
from marketloom.sources.registry import DATASETS, Dataset
from marketloom.sources.sinks import append_new, export_json, stored

MAX_NULL_RATE = 0.05
AUDIT_COLUMNS = ("_ingested_at", "_source_file")
MANIFEST_SCHEMA = "dataset STRING, table STRING, rows BIGINT, status STRING, error STRING, warnings ARRAY<STRING>"


class SchemaError(Exception):
    """A dataset that must not be loaded: required columns missing, or no rows."""


def _has_required(df: DataFrame, dataset: Dataset) -> None:
    missing = [c for c in dataset.required if c not in df.columns]
    if missing:
        raise SchemaError(f"[{dataset.name}] required but absent: {', '.join(missing)}")


def _facts(dataset: Dataset) -> list[Column]:
    """Numbers of rows and of missing values, by the names of the required columns."""
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in dataset.required]]


def validate_schema(df: DataFrame, dataset: Dataset) -> tuple[int, list[str]]:
    """Row count and warnings (duplicate keys, too many NULLs); raises SchemaError when fatal."""
    _has_required(df, dataset)
    return _judged(df.agg(*_facts(dataset)).first().asDict(), df, dataset)


def _judged(facts: dict, df: DataFrame, dataset: Dataset) -> tuple[int, list[str]]:
    """Row count and warnings from the facts of ``df``, of which only the key is read."""
    rows = facts["rows"]
    if rows == 0:
        raise SchemaError(f"[{dataset.name}] has no rows")
    warnings = []
    if facts.get(MALFORMED):
        warnings.append(f"[{dataset.name}] {facts[MALFORMED]} lines have too few or too many fields")
    if dataset.primary_key and dataset.primary_key in df.columns:
        duplicates = duplicate_rows(df, [dataset.primary_key]).first()[0]
        if duplicates:
            warnings.append(f"[{dataset.name}] key {dataset.primary_key}: {duplicates} rows repeat another row's value")
    for column in dataset.required:
        rate = facts[column] / rows
        if rate > MAX_NULL_RATE:
            warnings.append(f"[{dataset.name}] {column}: {rate:.1%} of the rows lack a value")
    return rows, warnings


def load_dataset(
    spark: SparkSession,
    data_dir: str,
    dataset: Dataset,
    target_dir: str,
    incremental: bool = False,
    dry_run: bool = False,
    prefix: str = "",
) -> tuple[int, str, list[str]]:
    """Validate and land one dataset; returns rows, status and warnings.

    The files are parsed once: rows, missing values and malformed lines are counted while the table is
    staged, and its key is checked there. Then it takes the place of the old table, which a failing dataset
    leaves as it was.
    """
    raw = read_landing(spark, data_dir, dataset.name, prefix)
    _has_required(raw, dataset)
    counts = [*_facts(dataset), F.count(MALFORMED).alias(MALFORMED)]
    if dry_run:
        rows, warnings = _judged(raw.agg(*counts).first().asDict(), raw, dataset)
        return rows, "dry_run", warnings
    root = target_dir.rstrip("/")
    path = f"{root}/{dataset.table}"
    release, parsed = publish.Release(spark, root), Observation()
    try:
        staged = release.stage(to_raw_strings(raw).observe(parsed, *counts).drop(MALFORMED), path)
        rows, warnings = _judged(parsed.get, staged, dataset)
        if incremental and dataset.incremental_column:
            rows = append_new(staged, path, dataset.primary_key, AUDIT_COLUMNS, dataset.incremental_column)
            return rows, "appended", warnings
        release.publish()
        return rows, "success", warnings
    finally:
        release.abandon()


def ingest(
    spark: SparkSession,
    data_dir: str,
    target_dir: str,
    datasets: Iterable[str] | None = None,
    incremental: bool = False,
    dry_run: bool = False,
    prefix: str = "",
    manifest_path: str | None = None,
) -> DataFrame:
    """Load datasets one after the other; a failing one does not stop the rest.

    Returns the manifest, one row per dataset, and writes it as JSON if ``manifest_path`` is given.
    An unknown dataset and any error while loading one is a failed row.
    """
    manifest = []
    for name in datasets or DATASETS:
        dataset = DATASETS.get(name)
        if dataset is None:
            manifest.append((name, None, 0, "failed", f"[{name}] unknown dataset", []))
            continue
        try:
            rows, status, warnings = load_dataset(spark, data_dir, dataset, target_dir, incremental, dry_run, prefix)
            manifest.append((name, dataset.table, rows, status, None, warnings))
        except SchemaError as error:
            manifest.append((name, dataset.table, 0, "failed", str(error), []))
        except Exception as error:  # whatever it is, the other datasets go on
            if isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND":
                text = f"[{name}] no file at {dataset_path(data_dir, name, prefix)}"
            else:
                text = f"[{name}] {type(error).__name__}: {str(error).splitlines()[0][:500]}"
            manifest.append((name, dataset.table, 0, "failed", text, []))
    result = spark.createDataFrame(manifest, MANIFEST_SCHEMA)
    if manifest_path:
        export_json(result.coalesce(1), manifest_path)
    return result


def write_record(spark: SparkSession, record: dict, path: str) -> None:
    """One JSON document as a one-row write, so it can go wherever the tables go."""
    text = json.dumps(record, default=str)
    spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_record(spark: SparkSession, path: str) -> dict | None:
    try:
        row = spark.read.text(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return json.loads(row[0]) if row else None


# --- content gate -------------------------------------------------------------------------


def content_fingerprint(spark: SparkSession, path: str, by_content: bool = True, range_bytes: int = ranges.RANGE_BYTES) -> str:
    """SHA-256 based fingerprint of one file or of many part files.

    Files are read by ranges of ``range_bytes``, so a file of any size is hashed by many tasks; its
    digest is the root of the tree over its ranges, for a file of one range the SHA-256 of its content. The
    files' digests are folded by mergeable aggregates; file order and names of the parts do not matter.
    ``by_content=False`` hashes name, length and change time instead.
    """
    if by_content:
        files = ranges.merkle_roots(ranges.range_digests(spark, path, range_bytes), range_bytes)
        digest = F.col("root")
    else:
        files = spark.read.format("binaryFile").load(path)
        digest = F.sha2(F.concat_ws("|", "path", "length", "modificationTime"), 256)
    # Four independent 64-bit words of each digest, summed: unlike exclusive or, equal parts add up.
    words = [F.sum(F.xxhash64(digest, F.lit(i)).cast("decimal(38,0)")) for i in range(4)]
    parts = F.concat_ws("|", F.count(F.lit(1)), F.sum("length"), *words)
    folded = files.agg(
        F.min(digest).alias("single"), F.count(F.lit(1)).alias("files"), F.sha2(parts, 256).alias("folded")
    ).first()
    return folded["single"] if folded["files"] == 1 else folded["folded"]


def run_gated(
    spark: SparkSession,
    source: str,
    state_path: str,
    audit_path: str,
    targets: Iterable[str],
    load: Callable[[], dict],
    incremental: bool = True,
    by_content: bool = True,
    range_bytes: int = ranges.RANGE_BYTES,
) -> dict:
    """Run ``load`` unless the source is unchanged and all targets exist; always write the audit.

    ``load`` returns figures for the audit record (rows, warnings). On success the
    fingerprint is kept for the next run. Each run has an id and a record of its own under
    ``audit_path``, see ``run_history``. ``by_content=False`` looks at names and change times only.
    """
    started = dt.datetime.now(dt.timezone.utc)
    record = {"run_id": f"{started:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}", "source": source,
              "mode": "incremental" if incremental else "full", "started_at": started.isoformat(), "status": "running"}
    try:
        fingerprint = content_fingerprint(spark, source, by_content, range_bytes)
        last = read_record(spark, state_path) if incremental else None
        unchanged = last is not None and last.get("last_hash") == fingerprint
        if unchanged and all(stored(spark, t) is not None for t in targets):
            record["status"] = "skipped_no_change"
        else:
            record.update(load())
            write_record(spark, {"last_hash": fingerprint, "updated_at": dt.datetime.now(dt.timezone.utc)}, state_path)
            record["status"] = "success"
    except Exception as error:
        record.update(status="failed", error=str(error))
        raise
    finally:
        finished = dt.datetime.now(dt.timezone.utc)
        record.update(finished_at=finished.isoformat(), elapsed_seconds=round((finished - started).total_seconds(), 2))
        write_record(spark, record, f"{audit_path}/run={record['run_id']}")
    return record


def run_history(spark: SparkSession, audit_path: str) -> DataFrame:
    """One row per audited run, as text of its JSON record and its main fields; ids sort by start."""
    fields = ("run_id", "source", "mode", "status", "error", "started_at", "finished_at")
    records = spark.read.text(f"{audit_path}/run=*")
    return records.select(
        *[F.get_json_object("value", f"$.{f}").alias(f) for f in fields],
        F.get_json_object("value", "$.rows_raw").try_cast("bigint").alias("rows_raw"),
        F.col("value").alias("record"),
    )
