from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marketloom.plans import geo_load
from marketloom.plans.quality_geo import GeoExpectations
from marketloom.session import scratch_path
from marketloom.sources import ingest, publish
from marketloom.sources.sinks import stored


def values(spark, path):
    table = stored(spark, path)
    return None if table is None else sorted(r["id"] for r in table.collect())


@pytest.fixture
def root(spark):
    path = scratch_path(spark, "release")
    spark.range(3).write.parquet(f"{path}/a")
    return path


def test_tables_appear_together(spark, root):
    release = publish.Release(spark, root)
    staged = release.stage(spark.range(5), f"{root}/a")
    release.stage(spark.range(2), f"{root}/b")
    assert staged.count() == 5 and values(spark, f"{root}/a") == [0, 1, 2] and values(spark, f"{root}/b") is None
    release.publish()
    assert values(spark, f"{root}/a") == [0, 1, 2, 3, 4] and values(spark, f"{root}/b") == [0, 1]
    assert not publish.exists(spark, f"{root}/_releases/{release.name}")


def test_abandoned_tables_leave_no_trace(spark, root):
    release = publish.Release(spark, root)
    release.stage(spark.range(5), f"{root}/a")
    release.abandon()
    assert values(spark, f"{root}/a") == [0, 1, 2] and publish.recover(spark, root) == 0


def test_a_failing_move_undoes_the_others(spark, root, monkeypatch):
    release = publish.Release(spark, root)
    release.stage(spark.range(5), f"{root}/a")
    release.stage(spark.range(2), f"{root}/b")
    real = publish.move

    def move(session, source, target):
        if target.endswith("/b"):
            raise OSError("no room")
        real(session, source, target)

    monkeypatch.setattr(publish, "move", move)
    with pytest.raises(OSError, match="no room"):
        release.publish()
    assert values(spark, f"{root}/a") == [0, 1, 2] and values(spark, f"{root}/b") is None


@pytest.mark.parametrize("moves_done", [0, 1, 2, 3])
def test_a_release_is_finished_after_its_driver_died(spark, root, monkeypatch, moves_done):
    release = publish.Release(spark, root)
    release.stage(spark.range(5), f"{root}/a")
    release.stage(spark.range(2), f"{root}/b")
    real, left = publish.move, [moves_done]

    class Died(BaseException):
        pass

    def move(session, source, target):
        if not left[0]:
            raise Died
        left[0] -= 1
        real(session, source, target)

    monkeypatch.setattr(publish, "move", move)
    if moves_done < 3:
        with pytest.raises(Died):
            release.publish()
    else:
        release.publish()
    monkeypatch.setattr(publish, "move", real)
    assert publish.recover(spark, root) == (moves_done < 3)
    assert values(spark, f"{root}/a") == [0, 1, 2, 3, 4] and values(spark, f"{root}/b") == [0, 1]
    assert publish.recover(spark, root) == 0


def test_a_fatal_dataset_leaves_the_old_table(spark, tmp_path):
    target, source = scratch_path(spark, "raw"), tmp_path / "sellers.csv"
    source.write_text("seller_id,seller_city\na,x\nb,y\n")
    assert ingest.ingest(spark, str(tmp_path), target, ["sellers"]).first()["status"] == "success"
    for broken in ("seller_id,seller_city\n", "seller_city\nx\n"):
        source.write_text(broken)
        assert ingest.ingest(spark, str(tmp_path), target, ["sellers"]).first()["status"] == "failed"
        assert sorted(r["seller_id"] for r in spark.read.parquet(f"{target}/raw_sellers").collect()) == ["a", "b"]
    source.write_text("seller_id,seller_city\nc,z\nd\ne,f,g\n")
    row = ingest.ingest(spark, str(tmp_path), target, ["sellers"]).first()
    assert (row["rows"], row["status"]) == (3, "success") and "2 lines have too few or too many fields" in " ".join(row["warnings"])


def test_a_landing_parses_its_files_once(spark, tmp_path, monkeypatch):
    (tmp_path / "sellers.csv").write_text("seller_id,seller_city\n" + "".join(f"s{i},c\n" for i in range(500)))
    parsed, real = spark.sparkContext.accumulator(0), ingest.read_landing

    def counting(*args):
        def seen(batches):
            for batch in batches:
                parsed.add(batch.num_rows)
                yield batch

        df = real(*args)
        return df.mapInArrow(seen, df.schema)

    monkeypatch.setattr(ingest, "read_landing", counting)
    target = scratch_path(spark, "raw")
    assert ingest.ingest(spark, str(tmp_path), target, ["sellers"]).first()["status"] == "success"
    assert parsed.value == 500
    landed = spark.read.parquet(f"{target}/raw_sellers")
    assert landed.count() == landed.where(F.col("_source_file") == "sellers.csv").count() == 500


def test_geography_load_is_all_or_nothing(spark, tmp_path):
    folder, source = scratch_path(spark, "geo"), tmp_path / "geolocation.csv"
    head = "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
    good = "".join(f"{1001 + i:05d},-23.5{i},-46.6{i},sao paulo,SP\n" for i in range(10))
    meta = spark.createDataFrame([("SP", "Sao Paulo", "Southeast", False, 1)], "state_code string, state_name string, region string, is_frontier_market boolean, state_population bigint")
    expect = GeoExpectations(states=("SP",))

    def load(text):
        source.write_text(head + text)
        return geo_load.load_geography(spark, str(source), folder, meta, expect)

    def rows():
        return [spark.read.parquet(f"{folder}/{t}").count() for t in ("raw_geolocation", "dim_geography")]

    first = load(good)
    assert (first["status"], first["rows_raw"], first["rows_dimension"], first["warnings"]) == ("success", 10, 10, [])
    assert load(good)["status"] == "skipped_no_change"
    with pytest.raises(geo_load.LoadStopped, match="nulls geolocation_state"):
        load(good + "01050,-23.5,-46.6,campinas,\n")
    assert rows() == [10, 10]
    doubtful = load(good + "01050,-23.5,-46.6,campinas,SP\n01051,40.0,-46.6,lisboa,SP\n")
    assert doubtful["status"] == "success" and len(doubtful["warnings"]) == 1 and rows() == [12, 11]
    history = ingest.run_history(spark, f"{folder}/_audit").orderBy("run_id").collect()
    assert [r["status"] for r in history] == ["success", "skipped_no_change", "failed", "success"]
