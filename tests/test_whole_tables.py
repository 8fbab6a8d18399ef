"""Queries over whole tables: each row of the table counts, as row and as neighbour."""

import inspect
import os

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__
from cellweave.operators import embedding, graph, stats

from .test_queries import plain

DIR = "/root/testdata/sf0.01"
QUERIES, SQL = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{DIR}/{f}')")
    return con


def same_rows(spark, sql, name, cuts):
    """The rows of a query against its SQL without the cuts in it."""
    text = SQL[name]
    for old, new in cuts:
        text = text.replace(old, new)
    want = sql.execute(text)
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, DIR).select(*columns).collect()
    rows = lambda all_: sorted((tuple(plain(v) for v in r) for r in all_), key=str)
    assert rows(want.fetchall()) == rows(tuple(r) for r in got)


@pytest.mark.parametrize("name", ["knn_join", "knn_smooth", "knn_affinity_markov", "knn_affinity_smarkov", "markov_imputation"])
def test_neighbours_of_all_vectors(spark, sql, name):
    same_rows(spark, sql, name, [(" WHERE vec_id < 300", ""), ("range(3) t(g)", "range(64) t(g)")])


def test_graph_queries_keep_all_vectors(spark):
    ids = set(pq.read_table(f"{DIR}/embeddings.parquet")["vec_id"].to_pylist())
    for name in ("diffusion_eigs", "phenograph_like"):
        assert {r["cell"] for r in QUERIES[name](spark, DIR).select("cell").distinct().collect()} == ids


def test_neighbours_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(graph, "BLOCK", 40)
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(130, 3)), 1)  # with ties and equal rows
    x[100:110] = x[5]
    got = graph.neighbours(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cell long, vector array<double>"), 6)
    want = {}
    for i, v in enumerate(x):
        d = np.sqrt(((x - v) ** 2).sum(axis=1))
        want[i] = [int(j) for j in np.lexsort((np.arange(len(x)), d))[:6]]
    found = {i: [] for i in want}
    for r in got.orderBy("src", "rank").collect():
        found[r["src"]].append(r["dst"])
    assert found == want


@pytest.mark.parametrize("name", ["bh_fdr", "gsea_es"])
def test_tests_over_all_parts(spark, sql, name):
    same_rows(spark, sql, name, [(" WHERE p_partkey < 1500", ""), (" WHERE p_partkey < 1999", "")])


def test_permuted_scores_count_all_parts(spark):
    n = pq.read_metadata(f"{DIR}/part.parquet").num_rows
    got = QUERIES["gsea_permuted"](spark, DIR).toPandas()
    assert got["n_hits"].sum() == n


def test_pushes_on_the_grid_are_those_of_all_pairs():
    rng = np.random.default_rng(6)
    for spread in (0.01, 3.0, 10.0):
        y = rng.normal(0, spread, (1500, 2))
        (exact, total), (near, about) = embedding.pushes(y), embedding.grid_pushes(y)
        assert abs(about / total - 1) < 0.02
        assert np.linalg.norm(near - exact) < 0.05 * np.linalg.norm(exact)


@pytest.mark.parametrize("exact", [2_000, 0])
def test_tsne_places_all_rows_by_their_groups(spark, monkeypatch, exact):
    monkeypatch.setattr(embedding, "EXACT", exact)
    rng = np.random.default_rng(7)
    group = np.arange(240) % 3
    x = rng.normal(size=(240, 8)) + 20 * np.eye(8)[group]
    got = embedding.tsne(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "cell long, vector array<double>")).sort_values("id")
    assert got["id"].tolist() == list(range(240))
    y = got[["x", "y"]].to_numpy()
    d = ((y[:, None] - y[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    assert (group[d.argmin(1)] == group).mean() > 0.98


def test_tsne_query_has_all_vectors(spark):
    ids = set(pq.read_table(f"{DIR}/embeddings.parquet")["vec_id"].to_pylist())
    got = QUERIES["tsne"](spark, DIR).toPandas()
    assert set(got["id"]) == ids and len(got) == len(ids) and np.isfinite(got[["x", "y"]].to_numpy()).all()


def test_smoothed_correlation_over_all_vectors(spark, sql):
    same_rows(spark, sql, "eigv_smoothed_corr", [(" WHERE vec_id < 400", "")])


@pytest.mark.parametrize("name, module, operator", [("diffusion_eigs", graph, "eigenpairs"), ("phenograph_like", graph, "communities"), ("gsea_permuted", stats, "gsea"), ("resampled_rank_test", stats, "resampled_tests"), ("bootstrap_welch", stats, "bootstrap_t")])
def test_queries_do_the_work_of_the_defaults(spark, monkeypatch, name, module, operator):
    class Called(Exception):
        pass

    signature = inspect.signature(getattr(module, operator))

    def called(*args, **named):
        bound = signature.bind(*args, **named).arguments
        raise Called({k: v for k, v in bound.items() if k in ("rounds", "permutations", "n_iter", "n_samples")})

    monkeypatch.setattr(module, operator, called)
    with pytest.raises(Called) as found:
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert found.value.args[0] == {}
