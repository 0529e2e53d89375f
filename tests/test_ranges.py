from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from marketloom.sources import files, ingest, ranges


def noisy_csv(seed, line_end, rows=120):
    rng = random.Random(seed)

    def field():
        kind = rng.random()
        if kind < 0.2:
            return ""
        if kind < 0.3:
            return '""'
        text = "".join(rng.choice(["a", "b,", '"', "\n", "\r\n", " ", "é", "", "x y"]) for _ in range(rng.randint(0, 8)))
        return '"' + text.replace('"', '""') + '"'

    return line_end.join(["id,text,more", *(f"{i},{field()},{field()}" for i in range(rows)), ""])


def whole(spark, path):
    return sorted(map(str, spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).collect()))


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_records_at_any_range_size(spark, tmp_path, line_end):
    (tmp_path / "a.csv").write_bytes(noisy_csv(1, line_end).encode())
    (tmp_path / "b.csv").write_bytes(noisy_csv(2, line_end, 30).rstrip("\r\n").encode())  # no break at its end
    want = whole(spark, str(tmp_path))
    assert len(want) == 150
    for size in (1, 13, 500, 10**9):
        found = ranges.read_quoted(spark, str(tmp_path), size)
        assert sorted(map(str, found.drop("_source_file").collect())) == want
    assert {r[0] for r in found.select("_source_file").collect()} == {"a.csv", "b.csv"}


def test_small_pieces(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_bytes(noisy_csv(3, "\r\n", 40).encode())

    class Source:
        data = (tmp_path / "a.csv").read_bytes()

        def read_at(self, size, at):
            return self.data[at : at + size]

    at_once = list(ranges._records_of(Source(), 0, len(Source.data), len(Source.data), False))
    monkeypatch.setattr(ranges, "PIECE", 3)
    for size in (1, 5, 64):
        found, quoted = [], False
        for start in range(0, len(Source.data), size):
            end = min(start + size, len(Source.data))
            found += ranges._records_of(Source(), start, end, len(Source.data), quoted)
            quoted ^= Source.data[start:end].count(b'"') % 2 == 1
        assert found == at_once


def test_a_range_reads_little_beyond_its_end():
    class Source:
        data, read = b"id,text\n" + b'1,"a ""b"" c"\n' * 100_000, 0

        def read_at(self, size, at):
            self.read += size
            return self.data[at : at + size]

    source = Source()
    found = list(ranges._records_of(source, 700_008, 700_008 + 140, len(source.data), False))
    assert not ranges._breaks_with_return(source, len(source.data))
    assert len(found) == 10
    assert source.read < 3 * ranges.AHEAD  # a megabyte each before


def test_ranges_are_dealt_over_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n" + '1,"a\nb"\n' * 1_000)
    listed = ranges.list_ranges(spark, str(tmp_path), 64).select(F.spark_partition_id()).distinct()
    found = ranges.read_records(spark, str(tmp_path), 64).select(F.spark_partition_id()).distinct()
    assert listed.count() == found.count() == 8  # the session's shuffles have as many; one before


def test_malformed_records_are_shown(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,"two\nlines"\n2\n3,x,y\n')
    rows = {r["id"]: r["bad"] for r in ranges.read_quoted(spark, str(tmp_path), 4, malformed="bad").collect()}
    assert rows["1"] is None and rows["2"] == "2" and rows["3"] == "3,x,y"


def test_reviews_land_by_ranges(spark, tmp_path):
    (tmp_path / "order_reviews.csv").write_text('review_id,order_id,review_score\nr1,1,"5"\n"r\n2",2,4\n')
    landed = files.read_landing(spark, str(tmp_path), "reviews")
    assert set(landed.columns) == {"review_id", "order_id", "review_score", "_malformed", "_ingested_at", "_source_file"}
    assert sorted(r["review_id"] for r in landed.collect()) == ["r\n2", "r1"]


def test_digests_and_the_tree(spark, tmp_path, monkeypatch):
    content = bytes(random.Random(4).randbytes(10_000))
    (tmp_path / "big").write_bytes(content)
    (tmp_path / "empty").write_bytes(b"")
    leaves = ranges.range_digests(spark, str(tmp_path), 100)
    found = {(r["file"].rsplit("/", 1)[-1], r["start"]): r["digest"] for r in leaves.collect()}
    assert len(found) == 100  # an empty file has no range
    assert all(found["big", at] == hashlib.sha256(content[at : at + 100]).hexdigest() for at in range(0, 10_000, 100))

    monkeypatch.setattr(ranges, "FAN", 4)
    level = [found["big", at] for at in range(0, 10_000, 100)]
    while len(level) > 1:
        groups = [level[i : i + 4] for i in range(0, len(level), 4)]
        level = [g[0] if len(g) == 1 else hashlib.sha256(("node:" + "".join(g)).encode()).hexdigest() for g in groups]
    roots = {r["file"].rsplit("/", 1)[-1]: r["root"] for r in ranges.merkle_roots(leaves, 100).collect()}
    assert roots == {"big": level[0]}


def test_one_changed_byte_is_found(spark, tmp_path):
    path = tmp_path / "data.bin"
    content = bytearray(random.Random(5).randbytes(5_000))
    path.write_bytes(content)
    before = ranges.range_digests(spark, str(path), 64)
    before = spark.createDataFrame(before.collect(), before.schema)
    first = ingest.content_fingerprint(spark, str(path), range_bytes=64)
    assert first == ingest.content_fingerprint(spark, str(path), range_bytes=64)
    content[3_210] ^= 1
    path.write_bytes(content + b"more")
    assert first != ingest.content_fingerprint(spark, str(path), range_bytes=64)
    changes = sorted((r["start"], r["change"]) for r in ranges.changed_ranges(before, ranges.range_digests(spark, str(path), 64)).collect())
    assert changes == [(3_210 // 64 * 64, "changed"), (5_000 // 64 * 64, "changed")]
