"""Checks, projections by products of rows, bootstrap intervals and rows for figures."""

from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cellweave.operators import graph, panels, stats
from cellweave.plans import run


def test_gram_route_gives_the_same_projection(spark):
    x = np.random.default_rng(3).normal(size=(12, 600)) * np.linspace(1, 4, 12)[:, None]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cell long, vector array<double>")
    values, placed = graph.gram_pca(rows, 4)
    centred = x - x.mean(axis=0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(values[:4], (s * s / 11)[:4])
    got = np.array([r["projection"] for r in placed.orderBy("cell").collect()])
    assert np.allclose(np.abs(got), np.abs((u * s)[:, :4]), atol=1e-8)
    own = np.array([r["projection"] for r in graph.pca(rows, 4)[1].orderBy("cell").collect()])
    assert np.allclose(np.abs(got), np.abs(own), atol=1e-8)


def test_negative_values_and_bad_labels_fail(spark):
    with pytest.raises(PySparkException):
        stats.non_negative(spark.createDataFrame([(1, -1)], "cell long, value long")).collect()
    cells = spark.createDataFrame([(1,), (2,)], "cell long")
    for labels in ([(1, "a")], [(1, "a"), (2, "b"), (2, "b")]):
        with pytest.raises(PySparkException):
            stats.aligned(cells, spark.createDataFrame(labels, "cell long, label string")).collect()


def test_bootstrap_interval_covers_and_separates(spark):
    r = np.random.default_rng(5)
    rows = [(c, g, int(r.poisson((60 if c % 2 else 20) if g == 0 else 40))) for c in range(60) for g in range(4)]
    matrix = spark.createDataFrame([t for t in rows if t[2]], "cell long, gene int, value long")
    labels = matrix.select("cell").distinct().withColumn("label", (F.col("cell") % 2).cast("int"))
    got = {t["gene"]: t for t in stats.bootstrap_t(matrix, labels, 0, 1, n_samples=40).collect()}
    assert set(got) == {0, 1, 2, 3}
    assert all(t["t_low"] <= t["t"] <= t["t_high"] for t in got.values())
    assert got[0]["t"] > 5 and got[0]["q"] < 0.001


def test_codes_of_numbers_text_and_nothing(spark):
    text = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "k string")
    assert sorted((r["k"] or "", r["code"]) for r in panels.category_codes(text, "k").collect()) == [("", None), ("a", 0), ("b", 1), ("b", 1)]
    numbers = spark.createDataFrame([(7,), (3,)], "k int")
    assert {(r["k"], r["code"]) for r in panels.category_codes(numbers, "k").collect()} == {(7, 7), (3, 3)}
    assert panels.category_colours(text.where("k is null"), "k").count() == 0
    one = panels.category_colours(text.where("k = 'a'"), "k").first()
    assert (one["position"], one["red"], one["blue"]) == (0.0, 0.0, 0.5)


def test_components_fall_back_and_constant_rows_have_no_correlation(spark):
    values = spark.createDataFrame([(i, 1.0) for i in range(8)], "component int, value double")
    assert panels.components_for(values).first()[0] == 6
    assert panels.components_for(values, otherwise=3).first()[0] == 3
    rows = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [3.0, 2.0, 1.0]), (3, [1.0, 1.0, 1.0])], "id long, vector array<double>")
    got = {(r["a"], r["b"]): r["r"] for r in stats.correlation_map(rows, rows).collect()}
    assert got[1, 2] == pytest.approx(-1) and got[1, 3] is None and len(got) == 9


def test_blocks_of_a_correlation_map(spark, monkeypatch):
    monkeypatch.setattr(stats, "BLOCK", 3)  # blocks of some three rows
    monkeypatch.setattr(stats, "PAIRS", 4)
    rng = np.random.default_rng(8)
    x = {f"x{i}": rng.normal(size=5) for i in range(11)} | {"flat": np.full(5, 0.1)}
    y = {i: rng.normal(size=5) for i in range(7)}
    left = spark.createDataFrame([*((k, v.tolist()) for k, v in x.items()), ("none", None), ("hole", [1.0, None, 2.0, 3.0, 5.0])], "id string, vector array<double>")
    right = spark.createDataFrame([(k, v.tolist()) for k, v in y.items()], "id long, vector array<float>")
    made = stats.correlation_map(left, right)
    assert made.dtypes == [("a", "string"), ("b", "bigint"), ("r", "double")]
    got = {(r["a"], r["b"]): r["r"] for r in made.collect()}
    assert len(got) == made.count() == 14 * 7
    for (a, b), r in got.items():
        assert (r is None) == (a in ("flat", "none", "hole"))
        assert r is None or r == pytest.approx(np.corrcoef(x[a], y[b])[0, 1], abs=1e-6)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan  # no copy of a row for each block of the other side
    assert stats.correlation_map(left.where("id = ''"), right).count() == 0
    assert [r["r"] for r in stats.correlation_map(left.where("id = 'none'"), right.limit(1)).collect()] == [None]


def test_correlation_map_of_a_table_with_itself(spark, monkeypatch):
    monkeypatch.setattr(stats, "BLOCK", 3)
    rng = np.random.default_rng(9)
    x = {f"x{i}": rng.normal(size=5) for i in range(16)} | {"flat": np.full(5, 0.1)}
    rows = [*((k, v.tolist()) for k, v in x.items()), ("x1", x["x1"].tolist()), ("none", None), ("hole", [1.0, None, 2.0, 3.0, 5.0]), (None, x["x2"].tolist())]
    table = spark.createDataFrame(rows, "id string, vector array<double>")
    made = stats.correlation_map(table, table)
    got = [tuple(r) for r in made.collect()]
    assert Counter(g[:2] for g in got) == Counter((a, b) for a, _ in rows for b, _ in rows)
    x[None] = x["x2"]
    both = {g[:2]: g[2] for g in got}
    for (a, b), r in both.items():
        assert (r is None) == bool({a, b} & {"flat", "none", "hole"})
        assert r is None or r == pytest.approx(np.corrcoef(x[a], x[b])[0, 1], abs=1e-9) and r == pytest.approx(both[b, a], abs=1e-15)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan


def test_written_size_of_a_correlation_map(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(stats, "BLOCK", 256)
    n = 2048
    vectors = np.random.default_rng(10).normal(size=(n, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id long, vector array<double>")
    stats.correlation_map(table, table).write.parquet(out := str(tmp_path / "map"))
    assert spark.read.parquet(out).count() == n * n
    assert sum(p.stat().st_size for p in (tmp_path / "map").glob("*.parquet")) < 6.5 * n * n  # 8.2 where each r is stored for both ways


def test_walks_of_a_tree(spark):
    linkage = spark.createDataFrame([(0, 0, 1, 0.5), (1, 2, 3, 0.7), (2, 4, 5, 1.0)], "step long, left long, right long, distance double")
    got = {r["node"]: (r["dfs"], r["bfs"]) for r in graph.tree_order(graph.linkage_edges(linkage)).collect()}
    assert sorted(got, key=lambda n: got[n][0]) == [6, 5, 3, 2, 4, 1, 0]
    assert sorted(got, key=lambda n: got[n][1]) == [6, 4, 5, 0, 1, 2, 3]


def test_whole_transcripts_of_ten_x(monkeypatch):
    asked = []
    monkeypatch.setattr(run, "gene_intervals", lambda records, most: asked.append(most))
    monkeypatch.setattr(run.readers, "read_table", lambda alignments, intervals: None)
    for name in ("ten_x", "ten_x_v2", "in_drop"):
        run.from_alignments(None, None, name)
    assert asked == [10_000, 10_000, 1000]
