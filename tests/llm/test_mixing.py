from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marketloom.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, tokens string, whole int, _hash long"


def rows():
    out = [(i, "w " * (1 + i % 13), "en" if i % 3 else "de", f"s{i % 5}") for i in range(600)]
    out += [(1000 + i, "w " * 20, "en", "s0") for i in range(600)]  # a hot leaf
    out += [(2000, None, "en", "s1"), (2001, "", None, None), (None, "a b c", "fr", "s9"), (5, "a b", "en", "s2"), (5, "a b", "en", "s2")]
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, "t", 1, 2) for r in data], SCHEMA)


def fill(budget, children):
    """children: name -> (weight, cap); pour until all is given or every child is full."""
    given = dict.fromkeys(children, 0.0)
    left, open_ = budget, {c for c, (w, cap) in children.items() if w > 0 and cap > 0}
    while left > 1e-9 and open_:
        total = sum(children[c][0] for c in open_)
        step = min([left / total, *((children[c][1] - given[c]) / children[c][0] for c in open_)])
        for c in open_:
            given[c] += step * children[c][0]
        left -= step * total
        open_ = {c for c in open_ if children[c][1] - given[c] > 1e-9}
    return given


def brute_budgets(leaves, s):
    """leaves: (domain, lang, source) -> tokens."""
    def below(prefix, budget, level):
        if level == 3:
            return {prefix: budget}
        sizes = defaultdict(int)
        for leaf, n in leaves.items():
            if leaf[:level] == prefix:
                sizes[leaf[level]] += n
        named = s.weights.get(("domain", "lang", "source")[level], {})
        rest = max(0.0, 1 - sum(named[c] for c in sizes if c in named))
        smooth = sum(n**s.smoothing for c, n in sizes.items() if c not in named)
        children = {c: (named[c] if c in named else rest * n**s.smoothing / smooth if smooth else 0.0, n * s.max_epochs) for c, n in sizes.items()}
        out = {}
        for c, b in fill(budget, children).items():
            out |= below((*prefix, c), b, level + 1)
        return out

    total = sum(leaves.values())
    return below((), total * min(s.budget_share, s.max_epochs), 0)


SETTINGS = [
    mixing.Settings(range_rows=50),
    mixing.Settings(range_rows=50, budget_share=0.4, max_epochs=1),
    mixing.Settings(range_rows=7, budget_share=1.7, max_epochs=3, weights={"lang": {"de": 0.6}, "source": {"s0": 0.0, "s1": 0.5}}),
    mixing.Settings(budget_share=5.0, max_epochs=2),
    mixing.Settings(range_rows=50, broadcast_leaves=0),
]


@pytest.mark.parametrize("number", range(len(SETTINGS)))
def test_against_brute_force(spark, number):
    s = SETTINGS[number]
    docs = frame(spark, rows())
    leaf = mixing.with_leaf(docs, s).select("doc_id", *mixing.LEVELS, mixing.tokens(F.col("text")).alias("n")).collect()
    sizes = defaultdict(int)
    for r in leaf:
        sizes[tuple(r[c] for c in mixing.LEVELS)] += r["n"]
    budget = brute_budgets(sizes, s)
    want = defaultdict(int)
    for at, size in sizes.items():
        mine = [r for r in leaf if tuple(r[c] for c in mixing.LEVELS) == at]
        whole = 1 if size == 0 else int(budget[at] / size + 1e-9)
        ids = spark.createDataFrame([(r["doc_id"], r["n"]) for r in mine], "doc_id long, n long")
        places = ids.withColumn("h", F.xxhash64(F.lit(s.seed), F.lit(whole), "doc_id")).groupBy("h").agg(F.sum("n").alias("n"), F.first("doc_id").alias("id"), F.count("*").alias("c")).orderBy("h").collect()
        rest = 0 if size == 0 else int(budget[at] + 1e-6) - whole * size
        for p in places:
            rest -= p["n"]
            want[(p["id"], at)] += p["c"] * (whole + (size > 0 and rest >= 0 and budget[at] + 1e-6 - whole * size >= 1))
            if rest < 0:
                rest = -(10**9)
    got = defaultdict(int)
    found = mixing.mix(docs, s)
    assert found.columns == ["doc_id", "text", "lang", "source", "tokens", "whole", "_hash", "mix_epoch"]
    found = found.drop("_hash")  # kept, but a name that with_leaf's users may need
    for r in mixing.with_leaf(found, s).collect():
        got[(r["doc_id"], tuple(r[c] for c in mixing.LEVELS))] += 1
    assert dict(got) == {k: v for k, v in want.items() if v}


def test_shares_follow_weights(spark):
    s = mixing.Settings(budget_share=0.3, max_epochs=1, weights={"lang": {"en": 0.5, "de": 0.5}}, domains=1, range_rows=50)
    docs = frame(spark, [(i, "w " * 10, "en" if i % 4 else "de", f"s{i % 3}") for i in range(2000)])
    got = {r["lang"]: r["n"] for r in mixing.mix(docs, s).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert abs(got["de"] - 300) <= 3 and abs(got["en"] - 300) <= 3


def test_columns_of_inner_names_are_kept(spark):
    names = ["_domain", "_lang", "_source", "_hash", "_range", "whole", "rest", "last_range", "cut", "_kept_3", "mix_epoch"]
    docs = spark.createDataFrame([(i, "a b", "en", f"s{i % 3}", *[f"{n}{i}" for n in names]) for i in range(50)], ["doc_id", "text", "lang", "source", *names])
    found = mixing.mix(docs, mixing.Settings(max_epochs=1, domains=2))
    assert found.columns == ["doc_id", "text", "lang", "source", *names]
    assert all(r[n] == f"{n}{r['doc_id']}" for r in found.collect() for n in names[:-1]) and found.count() == 50


def test_empty(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
