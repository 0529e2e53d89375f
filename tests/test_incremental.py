from __future__ import annotations

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from marketloom import catalog
from marketloom.session import scratch_path, shared_dir
from marketloom.sources.sinks import append_new, full_refresh, materialize, slices_of, stored
from marketloom.streaming.incremental import incremental_input, lookback_floor, merge_by_key, refresh, upsert

SCHEMA = "state string, order_month date, n int"


def frame(spark, *rows):
    return spark.createDataFrame([(s, dt.date.fromisoformat(m), n) for s, m, n in rows], SCHEMA)


def content(df):
    return sorted((r["state"], r["order_month"].isoformat(), r["n"]) for r in df.collect())


def test_merge_replaces_inserts_and_keeps(spark):
    target = frame(spark, ("A", "2018-01-01", 1), ("A", "2018-02-01", 2), ("B", "2018-02-01", 3))
    updates = frame(spark, ("A", "2018-02-01", 20), ("A", "2018-03-01", 30))
    assert content(merge_by_key(target, updates, ["state", "order_month"])) == [
        ("A", "2018-01-01", 1), ("A", "2018-02-01", 20), ("A", "2018-03-01", 30), ("B", "2018-02-01", 3)
    ]


def test_stored_merge_rewrites_only_touched_months(spark):
    path = scratch_path(spark, "merge")
    target = frame(spark, ("A", "2018-01-01", 1), ("A", "2018-02-01", 2), ("B", "2018-02-01", 3))
    upsert(target, path, ["state", "order_month"], "order_month")
    january = {r[0] for r in stored(spark, path).where("order_month = '2018-01-01'").select(F.input_file_name()).collect()}
    updates = frame(spark, ("A", "2018-02-01", 20), ("A", "2018-03-01", 30))
    want = [("A", "2018-01-01", 1), ("A", "2018-02-01", 20), ("A", "2018-03-01", 30), ("B", "2018-02-01", 3)]
    for _ in range(2):  # running it again changes nothing; B vanished from the updates and stays
        upsert(updates, path, ["state", "order_month"], "order_month")
        assert content(stored(spark, path)) == want
    after = {r[0] for r in stored(spark, path).where("order_month = '2018-01-01'").select(F.input_file_name()).collect()}
    assert january == after
    upsert(updates.limit(0), path, ["state", "order_month"], "order_month")
    assert content(stored(spark, path)) == want


def events(spark, *rows):
    return spark.createDataFrame([(s, dt.date.fromisoformat(d)) for s, d in rows], "state string, day date")


def monthly(df, cut=None):
    return df.groupBy("state", F.trunc("day", "MM").alias("order_month")).agg(F.count(F.lit(1)).cast("int").alias("n"))


def test_incremental_run_equals_full_rebuild_inside_the_lookback(spark):
    early = [("A", "2018-01-05"), ("A", "2018-02-05"), ("B", "2018-02-06")]
    late = [("A", "2018-01-20"), ("B", "2018-02-20"), ("A", "2018-03-01")]
    path = scratch_path(spark, "run")
    keys = ["state", "order_month"]
    refresh(monthly, events(spark, *early), path, "day", keys)
    got = refresh(monthly, events(spark, *early, *late), path, "day", keys)
    assert content(got) == content(monthly(events(spark, *early, *late)))


def test_rows_older_than_the_lookback_wait_for_a_full_refresh(spark):
    early = [("A", "2018-01-05"), ("A", "2018-03-05")]
    late = [("A", "2018-01-20"), ("A", "2018-02-11")]
    path = scratch_path(spark, "run")
    keys = ["state", "order_month"]
    refresh(monthly, events(spark, *early), path, "day", keys)
    got = content(refresh(monthly, events(spark, *early, *late), path, "day", keys))
    assert got == [("A", "2018-01-01", 1), ("A", "2018-02-01", 1), ("A", "2018-03-01", 1)]
    full = content(refresh(monthly, events(spark, *early, *late), path, "day", keys, full=True))
    assert full == [("A", "2018-01-01", 2), ("A", "2018-02-01", 1), ("A", "2018-03-01", 1)]


def test_first_run_has_no_bound(spark):
    source = events(spark, ("A", "2018-01-05"))
    assert incremental_input(source, None, "day", "order_month").count() == 1
    assert lookback_floor(None, "order_month") is None
    assert lookback_floor(frame(spark, ("A", "2018-03-01", 1)), "order_month", 1) == dt.date(2018, 2, 1)
    assert lookback_floor(frame(spark), "order_month") is None  # an empty target gives no bound either


def test_the_bound_reaches_the_scan(spark, sf_dir):
    target = frame(spark, ("A", "2001-03-01", 1))
    source = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = incremental_input(source, target, "o_orderdate", "order_month")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_keyed_append_is_idempotent(spark):
    path = scratch_path(spark, "append")
    first = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    more = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 3)], "k string, v int")
    assert append_new(first, path, "k") == 3
    assert append_new(more, path, "k") == 1
    assert append_new(more, path, "k") == 0
    assert sorted(r["k"] or "" for r in stored(spark, path).collect()) == ["", "a", "b", "c"]


def test_keyless_append_keeps_equal_rows(spark):
    path = scratch_path(spark, "append")
    first = spark.createDataFrame([("a", "f1"), ("a", "f1")], "v string, file string")
    more = spark.createDataFrame([("a", "f2")] * 3 + [(None, "f2"), ("b", "f2")], "v string, file string")
    assert append_new(first, path, audit=["file"]) == 2
    assert append_new(more, path, audit=["file"]) == 3
    assert append_new(more, path, audit=["file"]) == 0
    rows = sorted((r["v"] or "", r["file"]) for r in stored(spark, path).collect())
    assert rows == [("", "f2"), ("a", "f1"), ("a", "f1"), ("a", "f2"), ("b", "f2")]


def test_full_refresh_drops_vanished_partitions(spark):
    path = scratch_path(spark, "full")
    full_refresh(frame(spark, ("A", "2018-01-01", 1), ("A", "2018-02-01", 2)), path, ["order_month"], ["state"])
    full_refresh(frame(spark, ("A", "2018-02-01", 5)), path, ["order_month"], ["state"])
    assert content(stored(spark, path)) == [("A", "2018-02-01", 5)]


def test_materialization_kinds(spark):
    df = frame(spark, ("A", "2018-01-01", 1))
    materialize(df, "v_model", kind="view")
    assert spark.table("v_model").count() == 1
    path = scratch_path(spark, "model")
    for n in (1, 7):
        result = materialize(frame(spark, ("A", "2018-01-01", n)), "i_model", path, "incremental",
                             partition_by=["order_month"], unique_key=["state", "order_month"])
    assert content(result) == content(spark.table("i_model")) == [("A", "2018-01-01", 7)]


def test_merge_inside_foreach_batch(spark):
    """The keyed merge can also serve as the sink of a micro-batch."""
    source, path = scratch_path(spark, "stream"), scratch_path(spark, "target")
    frame(spark, ("A", "2018-01-01", 1), ("B", "2018-01-01", 2)).coalesce(1).write.parquet(source)
    query = (
        spark.readStream.schema(SCHEMA).parquet(source).writeStream
        .option("checkpointLocation", scratch_path(spark, "offsets"))
        .foreachBatch(lambda batch, _: upsert(batch, path, ["state", "order_month"], "order_month"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert content(stored(spark, path)) == [("A", "2018-01-01", 1), ("B", "2018-01-01", 2)]


def test_merge_keeps_rows_without_a_month(spark):
    path = scratch_path(spark, "null-month")
    schema = "state string, order_month date, n int"
    day = dt.date(2018, 1, 1)
    full_refresh(spark.createDataFrame([("a", day, 1), ("b", None, 2), ("c", None, 3)], schema), path, ["order_month"])
    upsert(spark.createDataFrame([("d", None, 4), ("c", None, 5)], schema), path, ["state"], "order_month")
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("state", "n").collect())
    assert got == [("a", 1), ("b", 2), ("c", 5), ("d", 4)]


def test_append_keeps_rows_without_a_key(spark):
    path = scratch_path(spark, "null-key")
    schema = "k int, v int, day date"
    day = dt.date(2018, 1, 1)
    assert append_new(spark.createDataFrame([(1, 1, day), (None, 2, day)], schema), path, "k", within="day") == 2
    more = spark.createDataFrame([(1, 9, day), (None, 2, day), (None, 2, day), (None, 4, None), (2, 5, day)], schema)
    assert append_new(more, path, "k", within="day") == 3
    assert append_new(more, path, "k", within="day") == 0
    got = sorted((str(r["k"]), r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("1", 1), ("2", 5), ("None", 2), ("None", 2), ("None", 4)]


def test_append_of_very_many_copies(spark, monkeypatch):
    from marketloom.sources import sinks

    monkeypatch.setattr(sinks, "COPIES", 7)
    path = scratch_path(spark, "copies")
    assert append_new(spark.range(3).selectExpr("'x' AS v"), path) == 3
    assert append_new(spark.range(100).selectExpr("'x' AS v"), path) == 97
    assert spark.read.parquet(path).count() == 100


def test_incremental_run_cuts_its_other_inputs(spark):
    path = scratch_path(spark, "cut")
    details = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "state string, weight int")
    seen = []

    def build(df, cut):
        kept = cut(details, "state")
        seen.append(sorted(r["state"] for r in kept.collect()))
        return monthly(df.join(kept, "state"))

    refresh(build, events(spark, ("A", "2018-01-05"), ("B", "2018-03-05")), path, "day", ["state", "order_month"])
    refresh(build, events(spark, ("A", "2018-01-05"), ("B", "2018-03-05"), ("C", "2018-03-06")), path, "day", ["state", "order_month"])
    assert seen == [["A", "B", "C"], ["B", "C"]]


def test_a_table_stored_in_slices_is_whole(spark):
    """Months in groups, missing ones included; a second refresh replaces all of them."""
    path = scratch_path(spark, "sliced")
    days = spark.range(400).select("id", F.when(F.col("id") % 9 != 0, F.expr("date_add(DATE'2018-01-01', CAST(id AS INT))")).alias("day"))
    rows = days.withColumn("month", F.trunc("day", "MM"))
    for rounds, slices in ((rows, 5), (rows.where("id < 300"), 3)):
        full_refresh(rounds, path, ["month"], ["id"], slices)
        stored = spark.read.parquet(path).select("id", "day", "month")
        assert sorted(map(str, stored.collect())) == sorted(map(str, rounds.collect()))
    parts = slices_of(rows, "month", 5)
    assert len(parts) == 5 and sum(p.count() for p in parts) == 400


def test_stored_models_leave_only_their_tables(spark, sf_dir):
    def stages():
        folder = Path(shared_dir(spark).removeprefix("file:")) / "marketloom"
        return {p.name for p in folder.iterdir() if p.name.startswith("stage-")}

    shared_dir(spark)
    scratch = scratch_path(spark, "here")
    spark.range(1).write.parquet(scratch)
    before = stages()
    assert catalog.QUERIES["stored_models"](spark, sf_dir).count() == 18
    assert stages() == before
