"""Checked load of the geography: raw table, dimension and audit as one transaction.

The source is staged, checked there before anything else sees it, and the dimension is built from the
staged rows. An error among the findings stops the load; warnings are counted and let it go on. Raw table and
dimension then appear together; a load that is stopped, or dies, leaves both as they were. Every run is
audited, and an unchanged source is not loaded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.plans import star
from marketloom.plans.quality_geo import GeoExpectations, geo_preload
from marketloom.sources import files, ingest, publish


class LoadStopped(Exception):
    """The source has findings that must not be loaded; the tables are as they were."""


def load_geography(
    spark: SparkSession,
    source: str,
    folder: str,
    state_meta: DataFrame,
    expect: GeoExpectations = GeoExpectations(),
    max_null_pct: float = 1.0,
    incremental: bool = True,
) -> dict:
    """Load ``source`` into ``folder``/raw_geolocation and ``folder``/dim_geography; returns the audit record.

    Finishes releases first that an earlier driver left half published. Raises LoadStopped after the
    audit says so.
    """
    publish.recover(spark, folder)
    raw_path, dim_path = f"{folder}/raw_geolocation", f"{folder}/dim_geography"

    def load() -> dict:
        release = publish.Release(spark, folder)
        try:
            staged = release.stage(files.with_audit(files.read_geolocation(spark, source)), raw_path)
            points = staged.drop(*ingest.AUDIT_COLUMNS)
            findings = geo_preload(points, expect, max_null_pct).where(F.col("level") != "stat").collect()  # a few rows
            errors = [f"{f['rule']} {f['column']}: {f['detail']}" for f in findings if f["level"] == "error"]
            if errors:
                raise LoadStopped("; ".join(errors))
            dimension = release.stage(star.dim_geography(points, state_meta), dim_path)
            figures = {
                "rows_raw": staged.count(),
                "rows_dimension": dimension.count(),
                "warnings": [f"{f['rule']} {f['column']}: {f['detail']}" for f in findings],
            }
            release.publish()
            return figures
        finally:
            release.abandon()

    return ingest.run_gated(
        spark, source, f"{folder}/_state", f"{folder}/_audit", [raw_path, dim_path], load, incremental
    )
