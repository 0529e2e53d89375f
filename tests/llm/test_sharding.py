from __future__ import annotations

import zlib
from collections import Counter, defaultdict

from marketloom.llm import sharding

SCHEMA = "doc_id long, text string, shard int, slot long, copies string"


def jump(key, n):
    key, b, j = (key or 0) % (1 << 64), -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_against_brute_force(spark):
    rows = [(i, f"text {i % 7}" * (i % 5)) for i in range(-40, 400)]
    rows += [(None, None), (None, "x"), (3, None), (5, "é" * 1000), (2**62, "big"), (-(2**63), "low")]
    rows += [(77, "same")] * 2500  # one row many times
    docs = spark.createDataFrame([(i, t, 1, 2, "c") for i, t in rows], SCHEMA)
    found = sharding.assign(docs, sharding.Settings(range_rows=10, run=100)).collect()
    want = Counter()
    for i, t in rows:
        content = (t or "").encode()
        want[(i, len(content) + 1, zlib.crc32(content), "key", jump(i, 16), jump(i, 17))] += 1
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in found) == want
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty(spark):
    assert sharding.assign(spark.createDataFrame([], SCHEMA)).collect() == []


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a", 1, 2, "c")], SCHEMA)
    plan = sharding.assign(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
