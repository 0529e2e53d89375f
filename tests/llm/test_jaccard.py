from __future__ import annotations

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from marketloom.llm import jaccard

SCHEMA = "doc_id long, text string, node string, n long, bucket int"


def shingles(text):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    links, root = defaultdict(int), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
            links[i] += 1
            links[j] += 1
            root[top(i)] = top(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[top(i)] = min((x for x in (low.get(top(i)), doc) if x is not None), default=None)
    return sorted(((doc, low[top(i)], links[i]) for i, (doc, _) in enumerate(rows)), key=str)


def corpus(rng):
    words = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(6):
        base = list(rng.choice(words, 120))
        for _ in range(12 if family else 60):  # one large family
            copy = list(base)
            for at in rng.integers(0, 120, rng.integers(0, 4)):
                copy[at] = str(rng.choice(words))
            rows.append(" ".join(copy))
    rows += ["shared passage of many words here " * 3 + " ".join(rng.choice(words, 60)) for _ in range(40)]
    rows += [" ".join(rng.choice(words, 200)) for _ in range(30)]
    rows += ["one two three"] * 3 + ["one two four", "", "  ", "x", rows[0], rows[0].replace(" ", "\n"), "long " * 40_000]
    order = rng.permutation(len(rows))
    return [(int(i), rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("small,block", [(16, 256), (3, 8)])
def test_against_brute_force(spark, small, block):
    rows = corpus(np.random.default_rng(4)) + [(7000, None)]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    found = jaccard.join_similar(docs, jaccard.Settings(small=small, block=block)).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in found), key=str) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)


def test_repeated_rows_null_ids_and_empty(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (None, text), (None, "nothing like the other texts here"), (2, "something else that is quite unlike it")]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)
    found = sorted((tuple(r) for r in jaccard.join_similar(docs).collect()), key=str)
    assert found == sorted(
        [(1, 1, 2, 3, True), (1, 1, 2, 3, True), (None, 1, 2, 3, False), (None, None, 0, 1, True), (2, 2, 0, 1, True)], key=str
    )
    assert jaccard.join_similar(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pruning_rarely_drops_a_similar_pair():
    s = jaccard.Settings()
    least = jaccard.least_matches(s)
    rng = np.random.default_rng(5)
    agree = rng.random((200_000, s.values)) < s.threshold
    lost = np.zeros(len(agree), bool)
    for n in range(s.step, s.values + 1, s.step):
        lost |= agree[:, :n].sum(axis=1) < least[n]
    assert lost.mean() < 1e-3
    unlike = rng.random((2_000, s.values)) < 0.3
    assert (unlike[:, : s.step].sum(axis=1) < least[s.step]).mean() > 0.4


def test_cut_texts_have_the_same_shingles(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(30_000))
    whole = jaccard.shingle_sets([text], 1, 5)
    monkeypatch.setattr(jaccard, "SLICE_CHARS", 5_000)
    cut = jaccard.shingle_sets([text], 1, 5)
    assert whole[0] == cut[0] and (whole[1][0] == cut[1][0]).all()
