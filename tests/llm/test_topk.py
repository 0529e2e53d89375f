from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score long, part int"


def brute(rows, every, k=5):
    usable = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, v in usable:
        if q % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 7, 1) for i, v in rows], SCHEMA)


def result(spark, rows, every, **settings):
    found = topk.search(frame(spark, rows), F.col("vec_id") % every == 0, topk.Settings(**settings)).collect()
    assert len(found) == len({tuple(r) for r in found})
    return {tuple(r) for r in found}


@pytest.mark.parametrize("block", [7, 8192])
def test_against_brute_force(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).round(1).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(9)]  # ties
    rows += [(200, None), (205, [float("nan")] * 8), (210, [None] * 8), (215, [float("inf")] * 8), (None, rows[1][1]), (220, [0.0] * 8)]
    assert result(spark, rows, 5, block=block, queries=3) == brute(rows, 5)


def test_fewer_than_k_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (7, [3.0, 0.0])]
    assert result(spark, rows, 50) == brute(rows, 50)
    assert result(spark, [], 50) == set()


def test_repeated_rows_are_candidates_each_and_ask_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0])]
    found = topk.search(frame(spark, rows), F.col("vec_id") == 0).collect()
    assert [(r["vec_id"], r["rank"]) for r in sorted(found, key=lambda r: r["rank"])] == [(3, 1), (3, 2)]


def test_few_candidates_are_left_to_exact_scores():
    rng = np.random.default_rng(2)
    block = np.floor(rng.normal(size=(3000, 16)) * 60).astype(np.int64)
    index = topk.Index(block, 64)
    for row in range(40):
        left = index.best(block[row], 5, (0.4, 0.2, 0.0), 0.1, np.array([row]))
        scores = block @ block[row]
        scores[row] = -(10**12)
        assert set(np.argsort(-scores, kind="stable")[:5]) <= set(left) and len(left) <= 600


def test_large_components_are_scored_exactly(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).round(1).astype(np.float32).tolist()) for i in range(40)]
    rows += [(50, [5000.0, 1.0, 0.0]), (51, [-(2.0**17), 0.5, 0.25]), (55, [2.0**20, -(2.0**20), 0.0]), (60, [5000.0, 1.0, 0.0]), (61, [2.0**26, 0.0, 0.0])]
    for block in (6, 8192):
        assert result(spark, rows, 5, block=block) == brute(rows, 5)


def test_only_a_score_beyond_64_bits_is_an_error(spark):
    fits = [(0, [2.0**40, 0.0]), (1, [0.0, 2.0**40]), (2, [1.0, 1.0])]
    assert result(spark, fits, 1) == brute(fits, 1)
    with pytest.raises(Exception, match="does not fit in 64 bits"):
        result(spark, [(0, [1e12]), (1, [1e12])], 1)
    with pytest.raises(Exception, match="beyond 64 bits"):
        result(spark, [(0, [1e20]), (1, [1.0])], 1)
