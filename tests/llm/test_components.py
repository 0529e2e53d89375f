from __future__ import annotations

import numpy as np
import pytest

from marketloom.llm import components
from marketloom.llm.components import connected


@pytest.mark.parametrize("kind", ["path", "star", "random", "empty"])
def test_against_union_find(spark, kind):
    rng = np.random.default_rng(9)
    edges = {
        "path": [(i, i + 1) for i in rng.permutation(200).tolist()],
        "star": [(500, i) for i in range(200)] + [(7, 7), (3, 500), (500, 3)],
        "random": rng.integers(0, 300, (220, 2)).tolist(),
        "empty": [],
    }[kind]
    root = {}

    def top(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = sorted((top(a), top(b)))
            root[b] = a
    frame = spark.createDataFrame([tuple(map(int, e)) for e in edges] + [(None, 4)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected(frame).collect()}
    assert got == {i: top(i) for i in root}


def test_plans_stay_short(spark, monkeypatch):
    """Every shuffle of a plan costs the driver memory, the more the longer the plan; stars need no round."""
    shuffles = []

    def counted(df, label, store=components.stored):
        shuffles.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return store(df, label)

    monkeypatch.setattr(components, "stored", counted)
    for links, most in (([(i, i + 1) for i in range(40)], 60), ([(0, i) for i in range(1, 40)], 2)):
        shuffles.clear()
        assert {r["root"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()} == {0}
        assert max(shuffles) <= 3 and len(shuffles) <= most
