from __future__ import annotations

import zlib

import numpy as np
import pytest

from marketloom.llm import grams, quality, toxicity
from marketloom.llm.base import Slice, slices, table

SCHEMA = "doc_id long, text string, score double, predicted int, label int"
MODULES = [(quality, "quality"), (toxicity, "toxic")]


def area(labels, scores):
    labels, scores = np.array(labels), np.array(scores)
    good, bad = scores[labels == 1], scores[labels == 0]
    return ((good[:, None] > bad).sum() + 0.5 * (good[:, None] == bad).sum()) / (len(good) * len(bad))


@pytest.mark.parametrize("module,column", MODULES)
def test_held_out_rows(spark, module, column):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = module.score_documents(docs, labels)
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert found.count() == docs.count()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % module.HOLDOUT_MOD == module.HOLDOUT_REST for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert area([r[column] for r in rows], [r["score"] for r in rows]) > (0.99 if column == "quality" else 0.94)
    assert np.mean([r["predicted"] == r[column] for r in rows]) > 0.95


@pytest.mark.parametrize("module,column", MODULES)
def test_edges(spark, module, column):
    rows = [(i, ("good words in a row " if i % 2 else "BAD!! idiot ") * 3) for i in range(200)]
    rows += [(900, None), (901, ""), (None, "good words"), (902, "word " * 300_000), (1, "good words in a row "), (1, "good words in a row ")]
    docs = spark.createDataFrame([(i, t, 0.5, 1, 2) for i, t in rows], SCHEMA)
    marks = [(i, int((i % 2 == 1) == (column == "quality"))) for i in range(200)] + [(None, 1), (5, None)]
    labels = spark.createDataFrame(marks, f"doc_id long, {column} int")
    found = module.score_documents(docs, labels).collect()
    assert sorted((str(r["doc_id"]) for r in found)) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in found)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[900]["score"] == by_id[901]["score"]
    assert all(by_id[i]["predicted"] == dict(marks[:200])[i] for i in range(2, 200))
    assert not by_id[None]["held_out"]
    assert module.score_documents(spark.createDataFrame([], SCHEMA), labels).collect() == []
    alone = module.score_documents(docs, labels.where("doc_id IS NULL")).collect()
    assert {r["score"] for r in alone} == {0.5}


def test_held_out_labels_are_never_learned(spark):
    rows = [(i, "same text") for i in range(400)]
    docs = spark.createDataFrame([(i, t, 0.5, 1, 2) for i, t in rows], SCHEMA)
    for module, column in MODULES:
        held = [zlib.crc32(str(i).encode()) % module.HOLDOUT_MOD == module.HOLDOUT_REST for i, _ in rows]
        labels = [spark.createDataFrame([(i, 1 if h else flip) for (i, _), h in zip(rows, held)], f"doc_id long, {column} int") for flip in (0,)]
        found = module.score_documents(docs, labels[0]).collect()
        assert max(r["score"] for r in found) < 0.3


def test_bags_against_plain_python():
    texts = ["Ab abc  abc\nxyé", "", "a", "one two two"]
    part = Slice(list(range(len(texts))), texts, [len(t) for t in texts])
    joined = grams.Joined.of(part.texts, grams.blanks(), part.own)
    for n in (3, 4):
        _, owner = joined.character_grams(n, 18)
        want = []
        for i, text in enumerate(texts):
            for word in text.split():
                want += [i] * max(0, len(word) + 2 - n + 1)
        assert owner.tolist() == sorted(want)
    hashes, owner, counts = joined.words()
    words = [w for t in texts for w in t.split()]
    assert counts.all() and len(hashes) == len(words)
    assert all((hashes[i] == hashes[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(len(words)))
    pairs, same = grams.paired(hashes, owner, 1, 1)
    assert same.sum() == sum(max(0, len(t.split()) - 1) for t in texts)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_cut_texts_score_alike(module):
    rng = np.random.default_rng(10)
    text = " ".join(rng.choice(["alpha", "Beta!", "gamma", "idiot", "x" * 30], 5000))
    s = module.Settings()
    sample = [(" ".join(rng.choice(["alpha", "idiot", "gamma"], 30)), k % 2) for k in range(40)]
    model = module.train(sample, s)
    model = (model.dense(s.bits), model.bias) if module is toxicity else model
    whole = module.probabilities(slices([text], 10**9), 1, *model, s)
    cut = module.probabilities(slices([text], 3_000), 1, *model, s)
    assert np.allclose(whole, cut, atol=1e-6)
