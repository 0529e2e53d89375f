"""Publishing tables: written beside their place first, then moved into it, several at once or none.

A release stages each of its tables in a folder of its own, where it can be read and checked. ``publish``
writes down which staged table replaces which, and then moves: the old table aside, the staged one into its place.
If a move fails, all are undone; if the driver dies in between, ``recover`` carries the moves of the written
plan to their end, since the plan is only written when every staged table is complete. Until then the old tables
stand untouched. On file systems without a rename (object stores) a move is a copy and readers may see it under way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import discard
from marketloom.sources.sinks import clustered

PLANS = "_releases"


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _place(spark, path)
    return system.exists(where)


def move(spark: SparkSession, source: str, target: str) -> None:
    (where, system), (to, _) = _place(spark, source), _place(spark, target)
    system.mkdirs(to.getParent())
    if system.exists(to) or not system.rename(where, to):
        raise OSError(f"cannot move {source} to {target}")


class Release:
    """Tables that appear together. ``root`` holds the staged tables and the plan until they do."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.name = spark, f"{root.rstrip('/')}/{PLANS}", uuid.uuid4().hex
        self.moves: list[dict[str, str]] = []

    def stage_path(self, path: str) -> str:
        """Where the table that will stand at ``path`` is to be written."""
        number = len(self.moves)
        folder = f"{self.root}/{self.name}"
        self.moves.append({"staged": f"{folder}/new-{number}", "target": path.rstrip("/"), "old": f"{folder}/old-{number}"})
        return self.moves[-1]["staged"]

    def stage(self, df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` as the table that will stand at ``path`` and read it back."""
        staged = self.stage_path(path)
        clustered(df, [*partition_by, *cluster_by]).write.partitionBy(*partition_by).parquet(staged)
        return self.spark.read.parquet(staged)

    def publish(self) -> None:
        """Put every staged table in its place, or leave all places as they are."""
        plan = f"{self.root}/{self.name}.plan"
        text = F.lit(json.dumps(self.moves)).alias("value")
        self.spark.range(1).select(text).coalesce(1).write.text(plan)
        try:
            _carry_out(self.spark, self.moves)
        except Exception:
            _undo(self.spark, self.moves)
            discard(self.spark, plan)
            raise
        discard(self.spark, plan)
        self.abandon()

    def abandon(self) -> None:
        """Remove what is staged; nothing was published."""
        discard(self.spark, f"{self.root}/{self.name}")


def _carry_out(spark: SparkSession, moves: Sequence[dict[str, str]]) -> None:
    """All moves that are still to be made; a second call makes none twice."""
    for m in moves:
        if exists(spark, m["staged"]):
            if exists(spark, m["target"]) and not exists(spark, m["old"]):
                move(spark, m["target"], m["old"])
            move(spark, m["staged"], m["target"])


def _undo(spark: SparkSession, moves: Sequence[dict[str, str]]) -> None:
    for m in moves:
        if not exists(spark, m["staged"]):
            move(spark, m["target"], m["staged"])
        if exists(spark, m["old"]) and not exists(spark, m["target"]):
            move(spark, m["old"], m["target"])


def recover(spark: SparkSession, root: str) -> int:
    """Finish the releases whose driver died while it published; returns their number."""
    folder = f"{root.rstrip('/')}/{PLANS}"
    where, system = _place(spark, folder)
    if not system.exists(where):
        return 0
    done = 0
    for status in system.listStatus(where):
        name = status.getPath().getName()
        if not name.endswith(".plan") or not exists(spark, f"{folder}/{name}/_SUCCESS"):
            continue
        moves = json.loads(spark.read.text(f"{folder}/{name}").first()[0])
        _carry_out(spark, moves)
        discard(spark, f"{folder}/{name}")
        discard(spark, f"{folder}/{name.removesuffix('.plan')}")
        done += 1
    return done
