from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marketloom.session import scratch_path, shared_dir
from marketloom.sources import files, ingest, sinks
from marketloom.sources.registry import DATASETS


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)


@pytest.fixture
def folder(tmp_path):
    write(tmp_path, "orders.csv", "order_id,customer_id,order_status,order_purchase_timestamp\n"
          "1,c1,delivered,2018-01-01 10:00:00\n1,c2,,2018-01-02 10:00:00\n2,,shipped,not a date\n")
    write(tmp_path, "customers.csv", "customer_id,customer_unique_id,customer_zip_code_prefix\nc1,u1,01001\nc2,u2,\n")
    write(tmp_path, "order_reviews.csv", 'review_id,order_id,review_score,review_comment_message\n'
          'r1,1,5,"two\nlines, ""quoted"""\nr2,2,4,\n')
    write(tmp_path, "sellers.csv", "seller_name\nx\n")
    write(tmp_path, "products.csv", "product_id\n")
    return str(tmp_path)


def test_raw_text_keeps_zeros_and_line_breaks(spark, folder):
    zips = [r[0] for r in files.read_raw(spark, folder, "customers").select("customer_zip_code_prefix").collect()]
    assert zips == ["01001", None]
    reviews = files.read_raw(spark, folder, "reviews").collect()
    assert len(reviews) == 2 and reviews[0]["review_comment_message"] == 'two\nlines, "quoted"'


def test_dates_are_parsed_or_null(spark, folder):
    rows = files.read_with_dates(spark, folder, "orders").collect()
    assert [r["order_purchase_timestamp"] is None for r in rows] == [False, False, True]


def test_missing_files_are_skipped(spark, folder):
    assert set(files.read_present(spark, folder)) == {"orders", "customers", "reviews", "sellers", "products"}


def test_audit_and_landing_types(spark, folder):
    landed = files.to_raw_strings(files.with_audit(files.read_raw(spark, folder, "customers")))
    types = dict(landed.dtypes)
    assert types.pop("_ingested_at") == "timestamp" and set(types.values()) == {"string"}
    assert {r["_source_file"] for r in landed.collect()} == {"customers.csv"}
    flags = spark.createDataFrame([(True, 1.5, None)], "b boolean, d double, s string")
    assert files.to_raw_strings(flags).first() == ("true", "1.5", None)


def test_one_failing_dataset_does_not_stop_the_rest(spark, folder):
    target = scratch_path(spark, "raw")
    names = ["orders", "customers", "sellers", "products", "payments", "nonsense"]
    manifest = {r["dataset"]: r for r in ingest.ingest(spark, folder, target, names).collect()}
    assert {k: (r["status"], r["rows"]) for k, r in manifest.items()} == {
        "orders": ("success", 3), "customers": ("success", 2), "sellers": ("failed", 0), "products": ("failed", 0),
        "payments": ("failed", 0), "nonsense": ("failed", 0),
    }
    warnings = " ".join(manifest["orders"]["warnings"])
    assert "key order_id: 1 rows repeat" in warnings and "customer_id: 33.3% of the rows lack a value" in warnings
    assert "required but absent" in manifest["sellers"]["error"] and "no rows" in manifest["products"]["error"]
    assert sinks.stored(spark, f"{target}/raw_sellers") is None


def test_dry_run_writes_nothing(spark, folder):
    target = scratch_path(spark, "raw")
    manifest = ingest.ingest(spark, folder, target, ["customers"], dry_run=True).first()
    assert (manifest["status"], manifest["rows"]) == ("dry_run", 2)
    assert sinks.stored(spark, f"{target}/raw_customers") is None


def test_incremental_load_is_idempotent(spark, tmp_path):
    target = scratch_path(spark, "raw")
    head = "mql_id,first_contact_date,origin\n"
    for body, added in (("a,2018-01-01,email\n", 1), ("a,2018-01-01,email\nb,2018-01-02,\n", 1),
                        ("a,2018-01-01,email\nb,2018-01-02,\n", 0)):
        write(tmp_path, "marketing_qualified_leads.csv", head + body)
        row = ingest.ingest(spark, str(tmp_path), target, ["mql"], incremental=True).first()
        assert (row["status"], row["rows"]) == ("appended", added)
    assert spark.read.parquet(f"{target}/raw_marketing_qualified_leads").count() == 2


def test_keyless_incremental_load(spark, tmp_path):
    target = scratch_path(spark, "raw")
    head = "review_id,order_id,review_score,review_creation_date\n"
    for body, added in (("r,o,5,2018-01-01\nr,o,5,2018-01-01\n", 2), ("r,o,5,2018-01-01\n" * 3, 1),
                        ("r,o,5,2018-01-01\n" * 3, 0)):
        write(tmp_path, "order_reviews.csv", head + body)
        assert ingest.ingest(spark, str(tmp_path), target, ["reviews"], incremental=True).first()["rows"] == added


def test_fingerprint_of_one_file_is_its_sha256(spark, folder):
    import hashlib
    from pathlib import Path

    path = Path(folder) / "orders.csv"
    assert ingest.content_fingerprint(spark, str(path)) == hashlib.sha256(path.read_bytes()).hexdigest()
    whole = ingest.content_fingerprint(spark, folder)
    assert whole == ingest.content_fingerprint(spark, folder)
    path.write_text(path.read_text() + "3,c3,shipped,\n")
    assert ingest.content_fingerprint(spark, folder) != whole
    assert ingest.content_fingerprint(spark, folder, by_content=False) != ingest.content_fingerprint(spark, folder)


def test_gate_audits_failures_and_keeps_the_old_state(spark, folder):
    state, audit = scratch_path(spark, "state"), scratch_path(spark, "audit")

    def broken():
        raise ValueError("data quality failed")

    with pytest.raises(ValueError, match="quality"):
        ingest.run_gated(spark, f"{folder}/orders.csv", state, audit, [], broken)
    record = ingest.run_history(spark, audit).first()
    assert record["status"] == "failed" and "quality" in record["error"] and record["finished_at"]
    assert ingest.read_record(spark, state) is None
    assert ingest.run_gated(spark, f"{folder}/orders.csv", state, audit, [], dict)["status"] == "success"
    assert ingest.run_gated(spark, f"{folder}/orders.csv", state, audit, [], dict)["status"] == "skipped_no_change"
    full = ingest.run_gated(spark, f"{folder}/orders.csv", state, audit, [], dict, incremental=False)
    assert full["status"] == "success"
    history = ingest.run_history(spark, audit).orderBy("run_id").collect()
    assert [r["status"] for r in history] == ["failed", "success", "skipped_no_change", "success"]
    sized = ingest.run_gated(spark, f"{folder}/orders.csv", state, audit, [], dict, by_content=False)
    assert sized["status"] == "success"


def test_equal_parts_do_not_cancel(spark, tmp_path):
    prints = []
    for name, parts in (("a", ("xx", "xx")), ("b", ("yy", "yy")), ("c", ("xx", "yy")), ("d", ("yy", "xx"))):
        (tmp_path / name).mkdir()
        for i, text in enumerate(parts):
            (tmp_path / name / f"part-{i}").write_text(text)
        prints.append(ingest.content_fingerprint(spark, str(tmp_path / name)))
    assert len(set(prints)) == 3 and prints[2] == prints[3]


def test_a_broken_file_is_one_failed_row(spark, folder, tmp_path):
    from pathlib import Path

    target, manifest = str(tmp_path / "raw"), str(tmp_path / "manifest")
    source = Path(folder, ingest.DATASETS["sellers"].file)
    source.unlink()
    source.mkdir()
    (source / "part-0.csv.gz").write_bytes(b"this is no archive")
    rows = ingest.ingest(spark, folder, target, ["sellers", "orders", "unheard_of"], manifest_path=manifest).collect()
    assert [(r["dataset"], r["status"]) for r in rows][0] == ("sellers", "failed")
    assert [r["status"] for r in rows][2] == "failed" and "unknown" in rows[2]["error"]
    assert spark.read.json(manifest).count() == 3


def test_layout_of_a_partitioned_table(spark, sf_dir):
    path = scratch_path(spark, "layout")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumn("day", F.to_date("o_orderdate"))
    month = sinks.monthly_partitioned(orders, path, "day", ["o_orderstatus"])
    stored = spark.read.parquet(path)
    assert stored.count() == orders.count() and dict(stored.dtypes)[month] == "date"
    wanted = stored.where(F.col(month) == "1998-10-01")
    assert "PartitionFilters: [isnotnull(day_month" in wanted._jdf.queryExecution().toString()


def test_registry():
    assert len(DATASETS) == 10
    assert {n for n, d in DATASETS.items() if d.incremental_column} == {
        "orders", "order_items", "reviews", "mql", "closed_deals"
    }


class Context:
    """Just enough of a session to look at the choice of the shared folder."""

    def __init__(self, master, named=None, current=None):
        self.master, self.current = master, current
        self.sparkContext = self
        self.conf = self
        self.values = {"spark.checkpoint.dir": named} if named else {}

    def get(self, key, default=None):
        return self.values.get(key, default)

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_shared_folder_follows_the_session():
    cluster = Context("spark://host", "hdfs://shared/ckpt/")
    assert shared_dir(cluster) == "hdfs://shared/ckpt" and cluster.current == "hdfs://shared/ckpt/"
    assert shared_dir(Context("spark://host", current="hdfs://other")) == "hdfs://other"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Context("spark://host"))
    local = Context("local[2]")
    assert shared_dir(local) == local.current
