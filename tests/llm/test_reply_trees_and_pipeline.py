import hashlib
import os
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import __spark_entry__
import corpus_pipeline
from cellweave.llm import reply_trees as R

from .helpers import docs

CONV = "conv_id long, turn long, role string, text string, node int, tree string"


def read_back(spark, turns):
    table = spark.createDataFrame([(*t, 1, "x") for t in turns], CONV)
    return {r["conv_id"]: r for r in R.formatted_digests(R.format_paths(R.chain_nodes(table))).collect()}


def test_conversations_read_back(spark):
    said = "</s>[INST] ok [/INST]"
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", said), (1, 2, None, None), (1, 3, "assistant", "\\[x\\\\<"), (2, 5, "assistant", None), (3, 0, "user", "a"), (3, 0, "user", "b"), (3, 0, "user", "b"), (None, 1, "user", "x"), (4, None, "we[ird<\\", "y" * 50_000)]
    turns += [(7, k, "assistant" if k % 2 else "user", f"t{k}é") for k in range(37)]
    got = read_back(spark, turns)
    by = {}
    for c, k, role, text in turns:
        by.setdefault(c, []).append((k if k is not None else -1, role or "", text or ""))
    assert set(got) == set(by)
    for c, rows in by.items():
        rows.sort()
        said = "".join(t for _, r, t in rows if r == "assistant")
        r = got[c]
        assert r["n_turns"] == len(rows)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in rows).encode()).hexdigest()
        assert r["loss_chars"] == len(said) and r["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    empty = spark.createDataFrame([], CONV)
    assert R.format_paths(R.chain_nodes(empty)).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "s<y", ""]), st.text(st.sampled_from("<>[]/\\INSTs \n")), ), min_size=1, max_size=6))
def test_any_turns_read_back(spark, turns):
    got = read_back(spark, [(1, k, *t) for k, t in enumerate(turns)])[1]
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_branches_by_score(spark):
    random.seed(3)
    parent = {i: (None if i == 0 else random.randrange(max(0, i - 6), i)) for i in range(60)}
    score = {i: random.randint(0, 5) / 4 for i in parent}
    rows = [("t", 9, i, p, "user", f"m{i}", score[i]) for i, p in parent.items()] + [("cycle", 1, 1, 2, "user", "a", 0.0), ("cycle", 1, 2, 1, "user", "b", 0.0), ("orphan", 2, 5, 77, "user", "o", None)]
    nodes = spark.createDataFrame(rows, "tree string, conv_id long, node long, parent long, role string, text string, score double")
    leaves = set(parent) - set(parent.values())

    def path(i):
        return ([] if parent[i] is None else path(parent[i])) + [i]

    order = sorted(leaves, key=lambda i: (-sum(score[k] for k in path(i)), i))[:3]
    steps = R.root_to_leaf(nodes, best=3).orderBy("branch", "depth").collect()
    for rank, leaf in enumerate(order, 1):
        mine = [r for r in steps if r["tree"] == "t" and r["branch"] == rank]
        assert [r["node"] for r in mine] == path(leaf) and [r["depth"] for r in mine] == list(range(1, len(mine) + 1))
    assert [r["node"] for r in steps if r["tree"] == "orphan"] == [5] and not [r for r in steps if r["tree"] == "cycle"]
    first = R.format_paths(nodes, 1).where("tree = 't'").first()["formatted"]
    assert first == "".join(f"<s>user[INST]m{i}[/INST]" for i in path(order[0]))


@pytest.mark.parametrize("name", [q for q in __spark_entry__.oracle_sql() if q.startswith("op")])
def test_same_rows_as_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{folder}/{f}')")
    want = con.execute(__spark_entry__.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    got = __spark_entry__.queries()[name](spark, folder).collect()
    assert sorted((tuple(plain(v) for v in r) for r in want.fetchall()), key=str) == sorted((tuple(plain(r[c]) for c in columns) for r in got), key=str)


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    extra = docs(spark, [(90_001, None), (90_002, "12 34"), (90_003, "")]).select(*table.columns)
    now, kept = table.unionByName(extra), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, folder).cache()
        if name != "piece_ids":
            assert out.columns == table.columns
        kept[name] = out
        before, now = now, out
        if name == "exact_dedup":
            texts = [r["text"] for r in out.collect()]
            assert len(texts) == len(set(texts)) == before.select("text").distinct().count()
    clean = table.count()
    assert kept["language_id"].count() >= 0.99 * clean and kept["language_id"].where("doc_id > 90000").count() == 0
    sources = kept["mixing"].groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), r"\s+"))).alias("n")).collect()
    assert len(sources) > 3
    model = SentencePieceProcessor(model_file=corpus_pipeline.public_tokenizers.path("piece_bpe_32k.model"))
    text = {r["doc_id"]: r["text"] for r in kept["mixing"].collect()}
    ids = kept["piece_ids"].limit(50).collect()
    assert all(r["ids"] == model.encode(text[r["doc_id"]]) and r["lossless"] for r in ids)
    assert ids[0]["ids_crc32"] == zlib.crc32(np.array(ids[0]["ids"], "<u4").tobytes())
