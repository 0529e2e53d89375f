from __future__ import annotations

import re
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pyarrow as pa
import pytest

from marketloom.llm import lexical
from marketloom.llm.lexical import Settings

DOCS = "doc_id long, text string, m long, shelf string, score int"
ITEMS = "item_id long, text string, rank int, item string"


def terms(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small)


def brute(docs, items, k):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                found.append((-score, i is not None, i or 0))
        out += [(item, rank, i if known else None, -score) for rank, (score, known, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, settings):
    found = lexical.search(
        spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], DOCS), spark.createDataFrame([(i, t, 1, "y") for i, t in items], ITEMS), settings
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(60)] + ["Été", "ÀÉ", "x1", "東京", "K"]
    weights = 1 / np.arange(1, len(words) + 1)
    draw = lambda size: " ".join(rng.choice(words, size, p=weights / weights.sum()))
    docs = [(i, draw(int(rng.choice([3, 8, 20, 90])))) for i in range(400)]
    docs += [(900, None), (901, ""), (902, "...!\n"), (None, "W1 w2 w3"), (903, "w5 " * 5000), (904, "same row w7"), (904, "same row w7")]
    docs += [(1000 + i, "tie tie w9") for i in range(30)]
    items = [(i, draw(12)) for i in range(25)] + [(50, "tie W9!"), (51, None), (52, ""), (53, "unknownword"), (54, "w1"), (54, "Été-w2"), (None, "w3 w4")]
    return docs, items


@pytest.mark.parametrize(
    "settings",
    [Settings(), Settings(k=5, shelf=40, first=1), Settings(k=3, shelf=7, first=2, batch=4), Settings(k=10, shelf=30, known=0), Settings(k=1000, shelf=50)],
)
def test_against_brute_force(spark, corpus, settings):
    docs, items = corpus
    assert run(spark, docs, items, settings) == brute(docs, items, settings.k)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert run(spark, [], items, Settings()) == []
    assert run(spark, docs, [], Settings()) == []
    assert run(spark, [(1, None)], items, Settings()) == []


def test_long_texts_are_counted_whole(monkeypatch):
    text = "Ab cd.ef " * 5000 + "zz"
    whole = Counter(t.encode() for t in terms(text))
    monkeypatch.setattr(lexical, "PART", 1000)
    assert lexical.terms_of(text) == whole


def shelf_of(rng, n_strata, docs_each):
    rows = []
    for at in range(n_strata):
        size = docs_each * 6
        keys, places = rng.integers(0, 40, size), rng.integers(0, docs_each, size)
        pairs = np.unique(keys * docs_each + places)
        tfs = rng.integers(1, 6, len(pairs))
        found = lexical.stratum(np.arange(docs_each) + 1000 * at, pairs // docs_each, tfs, pairs % docs_each, 50 + 40 * at)
        rows.append({"shelf": 1, "m": 50 + 40 * at, **found})
    kinds = {"shelf": pa.int64(), "m": pa.int64()} | {k: pa.list_(pa.int32() if k in ("places", "run_tf", "run_end") else pa.int64()) for k in rows[0] if k not in ("shelf", "m")}
    return lexical.Shelf(pa.table({k: pa.array([r[k] for r in rows], t) for k, t in kinds.items()})), rows


def test_strata_are_visited_by_their_bounds_and_left_out_on_proof():
    shelf, rows = shelf_of(np.random.default_rng(9), 30, 60)
    keys, weights = np.arange(5), np.array([5, 4, 3, 2, 1])
    ids, scores, visited = shelf.search(keys, weights, 0, 5)
    everything = shelf.search(keys, weights, 0, 10**6)
    assert everything[2] == 30 and visited < 15
    order = np.lexsort((everything[0], -everything[1]))[:5]
    assert sorted(zip(ids, scores)) == sorted(zip(everything[0][order], everything[1][order]))
    # a least score that nothing reaches visits nothing
    assert shelf.search(keys, weights, 10**12, 5)[2] == 0


def test_impact_is_one_number_per_run():
    found = lexical.stratum(np.arange(4), np.array([7, 7, 7, 3]), np.array([1, 2, 2, 1]), np.array([0, 1, 2, 3]), 60)
    assert found["run_key"].tolist() == [3, 7, 7] and found["run_tf"].tolist() == [1, 2, 1] and found["run_end"].tolist() == [1, 3, 4]
    assert found["places"].tolist() == [3, 1, 2, 0] and found["key"].tolist() == [3, 7]
    assert found["best"].tolist() == [10**9 // 2200, 2 * 10**9 // 3200]
