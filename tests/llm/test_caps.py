from __future__ import annotations

import numpy as np
import pytest

from marketloom.llm import caps, pairing

SCHEMA = "vec_id long, embedding array<double>, label int, node string, n int, bucket int"


def brute(rows):
    def usable(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = {k: set() for k in range(len(rows))}
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows):
            if i != j and a == b and usable(v, a) and usable(w, b) and len(v) == len(w):
                x, y = (np.array(u, float) / np.abs(u).max() for u in (v, w))
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                    links[i].add(j)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((vec_id, len(links[i]), min(ids, default=None)))
    return sorted(out, key=str)


def vectors(rng):
    rows = []
    for family in range(8):
        base = rng.normal(size=64)
        for _ in range(60 if family == 0 else 6):
            rows.append((base + rng.normal(size=64) * rng.choice([0.05, 0.2, 0.3])).tolist())
    rows += rng.normal(size=(60, 64)).tolist() + [rows[0]] * 5
    out = [(int(i), rows[k], int(k % 2)) for i, k in enumerate(rng.permutation(len(rows)))]
    out += [(900, None, 1), (901, [0.0] * 64, 1), (902, [float("nan")] * 64, 1), (903, [None] * 64, 1), (904, rows[0], None), (905, [1.0, 2.0], 1)]
    out += [(906, [], 0), (None, rows[0], 1), (7, rows[3], 0), (7, rows[3], 0), (908, [float("inf")] + [0.0] * 63, 0), (909, [1e200] * 64, 0), (910, [1e-200] * 64, 0)]
    return out


@pytest.mark.parametrize("small,block,many", [(16, 1024, 128), (3, 10, 2), (1, 1000, 5), (3, 10, 1000)])
def test_against_brute_force(spark, small, block, many):
    rows = vectors(np.random.default_rng(6))
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    found = caps.link_near(frame, caps.Settings(small=small, block=block, many=many)).collect()
    got, want = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str), brute(rows)
    assert sum(g != w for g, w in zip(got, want)) <= 2 and len(got) == len(want)  # a filter may miss a pair in 500 at the border
    assert sum(g[1] for g in got) <= sum(w[1] for w in want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found if r["vec_id"] is not None)


def test_recall_at_the_border():
    rng = np.random.default_rng(7)
    s = caps.Settings()
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * z
    shared = [len(np.intersect1d(a, b)) for a, b in zip(caps.filters(x, s), caps.filters(y, s))]
    apart = np.array([int(v).bit_count() for v in (caps.sketches(x, s) ^ caps.sketches(y, s)).view(np.uint64)])
    assert np.mean(np.array(shared) == 0) < 0.01 and np.mean(apart > s.apart) < 0.002


def test_listed_filters_are_all_that_pass():
    rng = np.random.default_rng(8)
    s = caps.Settings(words=32, height=0.3)
    x = rng.normal(size=(20, 10))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = caps.code(10, s)
    directions = np.concatenate([np.repeat(c.books[0], 32, axis=0), np.tile(c.books[1], (32, 1))], axis=1) / np.sqrt(2)
    cosines = (x @ c.rotation) @ directions.T
    for row, found in zip(cosines, caps.filters(x, s)):
        assert set(found) == set(np.flatnonzero(row >= s.height))


def test_empty(spark):
    assert caps.link_near(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("width", [2, 3, 8, 32, 64, 96, 128, 256, 768])
def test_near_pairs_of_any_width_share_a_filter(width):
    rng = np.random.default_rng(9)
    s = caps.Settings()
    x = rng.normal(size=(1000, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    found = caps.filters(x, s)
    assert min(len(f) for f in found) >= min(s.least, 4 if width == 2 else 52 if width == 3 else s.least)
    assert np.mean([len(f) for f in found]) < 200
    for cosine, most in ((0.93, 2), (0.99, 0)):
        y = cosine * x + np.sqrt(1 - cosine**2) * z
        assert sum(len(np.intersect1d(a, b)) == 0 for a, b in zip(found, caps.filters(y, s))) <= most


def test_wide_vectors_against_brute_force(spark):
    rng = np.random.default_rng(10)
    bases = rng.normal(size=(20, 256))
    rows = [(i, (bases[i % 20] + rng.normal(size=256) * 0.1).tolist(), 0) for i in range(60)]
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    found = caps.link_near(frame).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str) == brute(rows)


def bucketed(spark, rng, rows):
    """Rows of one bucket of near sketches (differing in up to 4 bits) and one of random sketches."""
    near = [int(rng.integers(1 << 62))] * rows
    near = [v ^ (1 << int(rng.integers(60))) ^ (1 << int(rng.integers(60))) for v in near]
    far = [int(v) for v in rng.integers(-(1 << 63), (1 << 63) - 1, rows)]
    out = [(b"n%04d" % k, v, 1, rows) for k, v in enumerate(near)] + [(b"f%04d" % k, v, 2, rows) for k, v in enumerate(far)]
    return out, spark.createDataFrame(out, "node binary, sketch long, bucket long, n long")


@pytest.mark.parametrize("size,batch", [(1000, 10000), (40, 10000), (40, 7)])
def test_crowds_lose_no_likely_pair(spark, size, batch):
    rows, frame = bucketed(spark, np.random.default_rng(11), 150)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = pairing.crowds(frame, 16, size, 20, 12).distinct().collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    mask = (1 << 64) - 1
    likely = {(a, b) for a, x, i, _ in rows for b, y, j, _ in rows if a < b and i == j and ((x ^ y) & mask).bit_count() <= 20}
    listed = {(bytes(r["a"]), bytes(r["b"])) for r in found if r["listed"]}
    root = {}

    def top(k):
        while root.get(k, k) != k:
            k = root[k]
        return k

    for r in found:
        if not r["listed"]:
            root[top(bytes(r["a"]))] = top(bytes(r["b"]))
    assert listed <= likely and all((a, b) in listed or top(a) == top(b) for a, b in likely)
    crowd = {top(b"n%04d" % k) for k in range(150)}
    assert len(crowd) == 1 and all(top(k) == k for k, _, bucket, _ in rows if bucket == 2)  # only the near ones are a cluster
    assert sum(a.startswith(b"f") for a, _ in listed) == sum(a.startswith(b"f") for a, _ in likely)


def test_many_vectors_in_a_cap_are_no_cluster(spark):
    """About 47 of 3,000 unrelated vectors pass each of 4,096 filters: none of these are clustered, the near pairs are found."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=(3000, 64))
    near = base[:100] + rng.normal(size=(100, 64)) * 0.2
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate([base, near]))]
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    s = caps.Settings(words=64, height=0.44)
    found = {r["vec_id"]: r["component_id"] for r in caps.link_near(frame, s).select("vec_id", "component_id").collect()}
    assert found == {i: i - 3000 if i >= 3000 else i for i in range(3100)}
