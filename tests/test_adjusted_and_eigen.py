"""Adjusted p values and eigenvectors against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import graph, testing


def brute(p):
    order = np.argsort(p)
    raw = p[order] * len(p) / np.arange(1, len(p) + 1)
    out = np.empty(len(p))
    out[order] = np.minimum(np.minimum.accumulate(raw[::-1])[::-1], 1.0)
    return out


def test_adjusted_by_group_over_many_ranges(spark):
    rng = np.random.default_rng(3)
    rows = [(g, i, float(np.round(v, 3))) for g in ("a", "b", None) for i, v in enumerate(rng.random(400) ** 3)]
    tests = spark.createDataFrame([*rows, ("a", 900, None), ("a", 901, float("nan"))], "g string, i int, p double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["g"], r["i"]): r["q"] for r in testing.bh_adjust(tests, by=["g"]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 1202 and got["a", 900] is None and got["a", 901] is None
    for g in ("a", "b", None):
        want = brute(np.array([p for h, _, p in rows if h == g]))
        assert np.allclose([got[g, i] for i in range(400)], want, atol=1e-12)


def test_adjusted_of_no_rows_and_two_stages(spark):
    none = spark.createDataFrame([], "i int, p double")
    assert testing.bh_adjust(none).count() == 0 and testing.tsbh_adjust(none).count() == 0
    p = np.array([0.001, 0.002, 0.003, 0.3, 0.6, 0.9, 0.9, 1.0])
    tests = spark.createDataFrame(list(enumerate(p.tolist())), "i int, p double")
    first = brute(p)
    rejected = (first <= 0.05 / 1.05).sum()
    want = np.minimum(first * (len(p) - rejected) / len(p) * 1.05, 1.0)
    got = [r["q"] for r in testing.tsbh_adjust(tests).orderBy("i").collect()]
    assert np.allclose(got, want, atol=1e-12)


def symmetric(n, seed):
    rng = np.random.default_rng(seed)
    a = np.where(rng.random((n, n)) < 0.1, rng.random((n, n)), 0.0)
    return a + a.T + np.diag(rng.random(n) - 1.5)


@pytest.mark.parametrize("k", [3, 8])
def test_eigenpairs_are_those_of_the_matrix(spark, k):
    a = symmetric(120, 5)
    i, j = np.nonzero(a)
    weights = spark.createDataFrame([(int(x), int(y), float(a[x, y])) for x, y in zip(i, j)], "src long, dst long, w double")
    values, pairs = graph.eigenpairs(weights, k=k)
    true = np.linalg.eigvalsh(a)
    want = np.sort(true[np.argsort(-np.abs(true))[:k]])[::-1]
    assert np.allclose(values, want, atol=1e-8)
    x = np.zeros((120, k))
    for r in pairs.collect():
        x[r["cell"], r["component"]] = r["x"]
    assert np.abs(a @ x - x * values).max() < 1e-6 and np.allclose(x.T @ x, np.eye(k), atol=1e-6)


def test_eigenpairs_of_few_cells_and_too_few_rounds(spark):
    weights = spark.createDataFrame([(1, 1, 2.0), (2, 2, -3.0)], "src long, dst long, w double")
    values, pairs = graph.eigenpairs(weights, k=4)
    assert np.allclose(values, [2.0, -3.0]) and pairs.count() == 4
    values, pairs = graph.eigenpairs(weights.where(F.lit(False)))
    assert len(values) == 0 and pairs.count() == 0
    a = symmetric(60, 7)
    i, j = np.nonzero(a)
    many = spark.createDataFrame([(int(x), int(y), float(a[x, y])) for x, y in zip(i, j)], "src long, dst long, w double")
    with pytest.raises(RuntimeError):
        graph.eigenpairs(many, k=3, rounds=1)
