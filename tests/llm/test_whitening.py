from __future__ import annotations

import numpy as np
import pytest

from marketloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component string, x int, deviation string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2, "d") for i, v in rows], SCHEMA)


def brute(rows, width, components=4):
    """Rows (vec_id, component, n, deviation, |whitened|, explained) in plain numpy."""
    usable = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    whole = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v] + [0] * (width - len(v))) for i, v in usable]
    fit = np.array(sorted({tuple(x) for _, x in whole}), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    out = []
    for i, x in whole:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        for c in range(min(components, width)):
            y = abs((np.array(x) - sums / n) @ directions[:, c]) / np.sqrt(values[c])
            out.append((i, c + 1, n, deviation, y, values[c] / values.sum()))
    return out


def check(spark, rows, width, settings=whitening.Settings()):
    found = whitening.whiten(frame(spark, rows), settings).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3])
    got = sorted([(r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in found], key=key)
    want = sorted(brute(rows, width), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    np.testing.assert_allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-7, atol=1e-9)
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-8
    # one sign per component for all rows
    by_component = {}
    for r in found:
        by_component.setdefault(r["component"], []).append(r["whitened"])
    assert all(abs(np.mean(v)) < 2 for v in by_component.values())


def test_against_numpy(spark):
    rng = np.random.default_rng(4)
    spread = rng.normal(size=(6, 6)) * np.array([3, 2, 1, 0.7, 0.4, 0.2])
    rows = [(i, (rng.normal(size=6) @ spread + 1).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)]  # copies are one row of the fit
    rows += [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] + [0.0] * 5), (2004, [0.25, 0.5]), (None, rows[1][1]), (5, rows[5][1])]
    check(spark, rows, 6)
    check(spark, rows, 6, whitening.Settings(block=16))


def test_narrow_vectors(spark):
    rng = np.random.default_rng(5)
    check(spark, [(i, rng.normal(size=2).tolist()) for i in range(40)], 2)


def test_no_variance_and_empty(spark):
    found = whitening.whiten(frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect()
    assert {(r["vec_id"], r["component"]) for r in found} == {(1, 1), (1, 2), (2, 1), (2, 2)}
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in found} == {(1, 0, None, None, None)}
    flat = whitening.whiten(frame(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert {(r["component"], r["whitened"] is None, r["explained"]) for r in flat} == {(1, False, 1.0), (2, True, 0.0)}
    for rows in ([], [(1, None)], [(1, [])]):
        assert whitening.whiten(frame(spark, rows)).collect() == []


def test_deviation_that_leaves_64_bits_is_null(spark):
    found = whitening.whiten(frame(spark, [(1, [1e9]), (2, [-1e9]), (3, [0.0])])).collect()
    assert [r["deviation"] for r in sorted(found, key=lambda r: r["vec_id"])][:2] == [None, None]


def test_the_rows_are_cut_over_tasks(spark):
    rng = np.random.default_rng(6)
    fit = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(400)], "index long, values array<double>")
    matrix = whitening._matrix(fit, 400, 3, 16, 3)
    rows = np.array([r["values"] for r in fit.orderBy("index").collect()])
    for splits in (1, 8):
        np.testing.assert_allclose(whitening._scatter(matrix, splits), rows.T @ rows)


@pytest.mark.parametrize("width", [1, 3])
def test_eigen_is_ordered(width):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(50, width))
    values, directions, trace = whitening.eigen(x.T @ x, 50, 4, 1e-13)
    assert len(values) == min(4, width) and all(a >= b for a, b in zip(values, values[1:]))
    assert abs(trace - np.trace(x.T @ x / 50)) < 1e-9 and directions.shape == (width, len(values))
