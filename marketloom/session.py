"""Session helpers: local sessions for tests and the bench, and durable stage storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SCRATCH: dict[str, list[str]] = {}  # paths handed out, by application


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("marketloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config(CHECKPOINT_CONF, conf.pop(CHECKPOINT_CONF, None) or tempfile.mkdtemp(prefix="marketloom-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master without that setting (tests);
    on a cluster a missing setting is an error, because a machine-local folder would
    be lost together with its executor.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF, None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder before running this plan")
        current = tempfile.mkdtemp(prefix="marketloom-")
        context.setCheckpointDir(current)
        current = context.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path under the shared folder; ``drop_scratch`` removes them all."""
    path = f"{shared_dir(spark)}/marketloom/{label}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more, on whatever storage it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def unsettle(df: DataFrame) -> None:
    """Remove the scratch table that ``df``, a frame made by ``settle``, reads; nothing may read it any more."""
    path = df.inputFiles()[0].rsplit("/", 1)[0] if df.inputFiles() else ""
    mine = _SCRATCH.get(df.sparkSession.sparkContext.applicationId, [])
    for place in [p for p in mine if p.rsplit("/", 1)[-1] == path.rsplit("/", 1)[-1]]:
        discard(df.sparkSession, place)
        mine.remove(place)


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end; for work whose result is stored elsewhere."""
    mine = _SCRATCH.setdefault(spark.sparkContext.applicationId, [])
    before = set(mine)
    try:
        yield
    finally:
        for place in [p for p in mine if p not in before]:
            discard(spark, place)
            mine.remove(place)


def drop_scratch(spark: SparkSession) -> None:
    """Remove all scratch tables of this application; frames that were built on them end with it."""
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        discard(spark, path)


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, what an action shuffled is removed from the disks when the action ends.

    Otherwise these files stay until the driver happens to collect its garbage, so a job of many steps
    holds the shuffles of all of them. For actions on frames that are not run a second time: what is needed later is
    stored, or a few rows on the driver.
    """
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_CONF) if before is None else spark.conf.set(CLEANUP_CONF, before)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and cut its lineage.

    Used where several branches must see the very same rows, also after an executor is lost
    and its tasks run again. Stored as Parquet, so each branch reads only its columns.
    """
    path = scratch_path(df.sparkSession, "stage")
    with brief_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
