from __future__ import annotations

import corpus_pipeline as pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import mixing, quality, toxicity
from marketloom.llm.base import stored, table

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """The documents before and after every stage."""
    out = [table(spark, SF_DIR, "documents")]
    for name, stage in pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_DIR), f"test-{name}"))
    return out


def test_stages(spark, kept):
    assert 4 <= len(pipeline.STAGES) <= 5
    documents = kept[0]
    for after in kept[1:-1]:
        assert after.columns == documents.columns
        assert after.exceptAll(documents).isEmpty()
        assert after.count() == after.select("doc_id").distinct().count()


def test_rejected_documents_go(spark, kept):
    labels = table(spark, SF_DIR, "labels")
    for k, module, reject in ((0, quality, 0), (1, toxicity, 1)):
        scored = module.score_documents(kept[k], labels)
        want = {r[0] for r in scored.where(F.col("predicted") != reject).select("doc_id").collect()}
        assert {r[0] for r in kept[k + 1].select("doc_id").collect()} == want
        assert len(want) < kept[k].count()


def test_one_of_each_group_stays(spark, kept):
    def shingles(text):
        w = text.split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = {r["doc_id"]: shingles(r["text"]) for r in kept[2].collect()}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                x, y = sorted((top(i), top(j)))
                root[y] = x
    assert {r[0] for r in kept[3].select("doc_id").collect()} == {i for i in ids if top(i) == i}


def test_mixing_keeps_its_budget(spark, kept):
    words = mixing.tokens(F.col("text"))
    before, after = (df.agg(F.sum(words)).first()[0] for df in kept[3:5])
    assert 0.8 * before < after <= pipeline.MIXING.budget_share * before


def test_packing_has_every_document(spark, kept):
    packed, docs = kept[5], kept[4]
    assert packed.where("piece = 0").select("doc_id").exceptAll(docs.select("doc_id")).isEmpty()
    assert packed.where("piece = 0").count() == docs.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()


def test_run(spark, kept):
    assert pipeline.run(spark, SF_DIR).drop("sequence_id", "offset").exceptAll(kept[5].drop("sequence_id", "offset")).isEmpty()


def test_edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string"
    text = "one two three four five six seven"
    rows = [(1, text, "en", "s", 3), (1, text, "en", "s", 3), (2, text, "en", "s", 3), (3, None, None, None, None), (4, "", "en", "s", 0), (None, "no id", "en", "s", 5)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], schema)
    left = pipeline.one_of_each_group(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["1", "3", "4", "None"]
    empty = docs.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).collect() == []


def test_every_stage_keeps_columns_of_any_name(spark):
    """Extra columns with names that stages use inside go through all stages but the last unchanged."""
    names = ["_hash", "_range", "_domain", "_lang", "_source", "_row", "_predicted", "node", "whole", "cut"]
    rows = [(i, f"word{i} " * 30, "en", f"s{i % 3}", 9, *[f"{n}-{i}" for n in names]) for i in range(40)]
    rows += [(None, None, None, None, None, *[None] * len(names)), (90, "", "en", "s1", 0, *[None] * len(names))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for _, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns
        kept = after.where("doc_id < 90").collect()
        assert all(r[n] == f"{n}-{r['doc_id']}" for r in kept for n in names)
    assert pipeline.STAGES[-1][1](spark, docs, SF_DIR).where("piece = 0").count() == len(rows)


def test_rows_are_decided_one_by_one(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    one, two, three = ("one two three four five six seven", "eight nine ten eleven twelve thirteen", "red green blue black white grey")
    rows = [(2, one), (2, two), (1, one), (7, two), (None, one), (None, three), (None, three), (5, None), (5, None), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], schema)
    left = sorted(((r["doc_id"], r["text"]) for r in pipeline.one_of_each_group(spark, docs, SF_DIR).collect()), key=str)
    assert left == sorted([(1, one), (2, two), (None, three), (5, None), (5, "")], key=str)


@pytest.mark.parametrize("module,stage,worst", [(quality, pipeline.keep_quality, 0.0), (toxicity, pipeline.drop_toxic, 1.0)])
def test_every_row_goes_by_its_own_score(spark, monkeypatch, module, stage, worst):
    def score(parts, n):
        bad = [False] * n
        for part in parts:
            for owner, text in zip(part.owners, part.texts):
                bad[owner] |= "bad" in text
        return np.where(bad, worst, 1 - worst)

    monkeypatch.setattr(module, "_scorer", lambda docs, labels, settings: score)
    rows = [(1, "good"), (1, "bad"), (None, "bad"), (None, "good"), (2, "bad"), (3, "good"), (3, "good")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _predicted string")
    left = stage(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted((r for r in rows if r[1] == "good"), key=str)
