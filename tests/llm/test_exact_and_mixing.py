import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm.exact_dedup import drop_exact, exact_groups, merge_runs
from cellweave.llm.mixing import mix_documents, mix_sizes, permuted, split_quotas, targets, tree_draws
from cellweave.llm.near_dedup import drop_near

from .helpers import docs, rows

EDGE = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "a"), (5, "x" * 200_000), (6, "x" * 200_000), (None, "lone"), (7, "A")]


def test_exact_groups(spark):
    got = rows(exact_groups(docs(spark, EDGE), keep="largest"), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    groups = defaultdict(list)
    for i, t in EDGE:
        groups[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    assert got == sorted(((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in EDGE), key=str)
    small = {r["keep_id"] for r in exact_groups(docs(spark, EDGE)).where("text_sha256 = sha2('a', 256)").collect()}
    assert small == {1}
    assert exact_groups(docs(spark, EDGE).where("doc_id > 99")).count() == 0


def test_drop_exact_keeps_one_row_of_each_text(spark):
    table = docs(spark, EDGE)
    left = drop_exact(table, keep="largest")
    assert left.columns == table.columns
    assert sorted((r["text"] or "")[:5] for r in left.collect()) == sorted({(t or "")[:5] for _, t in EDGE})
    assert drop_exact(table.where("doc_id > 99")).count() == 0


def test_targets_stop_and_share_again():
    assert targets([100, 10, 1000]) == [300.0, 30.0, 780.0]
    assert targets([]) == [] and targets([0, 0]) == [0.0, 0.0]
    got = targets([10, 10, 10, 10, 10, 1000])
    assert abs(sum(got) - 1050) < 1e-9 and all(g <= 3 * s + 1e-9 for g, s in zip(got, [10] * 5 + [1000]))


def test_split_quotas_are_exact():
    q = [1000, 1, 0, 57]
    split = split_quotas(q, 7, 3)
    assert split.sum(0).tolist() == q and set(split.sum(1).tolist()) <= {151, 152}
    assert (split == split_quotas(q, 7, 3)).all() and split_quotas([], 1, 0).shape == (1, 0)


def test_mix_takes_the_targets(spark):
    random.seed(4)
    table = docs(spark, [(i, " w" * random.randint(0, 90), random.choice(["b", "b", "b", "a", None, "c"])) for i in range(400)] + [(900, None, "z"), (901, "w " * 20000, "b"), (905, "w", "b"), (905, "w", "b"), (None, "w w", None)])
    out = mix_sizes(table, block_words=500, shard_blocks=4).toPandas()
    assert len(out) == 405
    source = {(r["doc_id"]): r["source"] for r in table.collect()}
    out["source"] = [str(source[i if i == i else None]) for i in out.doc_id]
    sums = out.groupby("source").agg({"taken": "sum", "target": "first", "source_size": "first", "size": "sum"})
    assert (abs(sums.taken - sums.target) <= 0.5).all()
    assert (out.taken <= 3 * out["size"]).all()
    again = mix_sizes(table, block_words=500, shard_blocks=4).toPandas()
    assert sorted(zip(out.doc_id.fillna(-1), out.taken)) == sorted(zip(again.doc_id.fillna(-1), again.taken))
    assert mix_sizes(table.where("doc_id > 9999")).count() == 0


def test_mix_documents_repeats_whole_rows(spark):
    table = docs(spark, [(i, "w " * 10, "a" if i < 50 else "b") for i in range(100)])
    out = mix_documents(table, block_words=100, shard_blocks=2)
    assert out.columns == table.columns
    got = [r["doc_id"] for r in out.collect()]
    assert sum(i < 50 for i in got) == round(1000 * 5 / 7 / 10) and max(np.bincount(got)) <= 3
    assert mix_documents(table.where("doc_id > 999")).count() == 0


def test_equal_digests_with_other_proofs_stay_apart(spark):
    level = [(r, 0, b"d", p, n, i, 1) for r, p, n, i in ((0, b"p", 3, 5), (1, b"p", 3, 4), (2, b"q", 3, 1), (3, b"p", 4, 2), (5, b"p", 3, 9), (6, b"q", 3, None))]
    made = spark.createDataFrame(level, "run int, slot int, digest binary, proof binary, chars int, keep_id long, n long")
    got = rows(merge_runs(made, "smallest", runs=7, fan_in=2), "proof", "chars", "keep_id", "group_size")
    assert got == sorted([(b"p", 3, 4, 3), (b"q", 3, 1, 2), (b"p", 4, 2, 1)], key=str)
    assert {r["keep_id"] for r in merge_runs(made, "largest", runs=7).where("chars = 3").collect()} == {9, 1}


NAMES = ["__id", "__n", "__digest", "__text", "__s", "__need", "id", "run", "proof", "chars", "row", "place", "own", "sid", "block", "taken", "size", "epoch", "shard", "each", "blank", "same"]


def test_rows_keep_columns_of_any_name(spark):
    table = docs(spark, EDGE).select("doc_id", "text", "source", *[F.lit(10).alias(n) for n in NAMES])
    for left in (drop_exact(table, keep="largest"), drop_near(table), mix_documents(table.where("doc_id = 5"))):
        assert left.columns == table.columns
        got = left.collect()
        assert got and all(r[n] == 10 for r in got for n in NAMES)


def mixed_by_hand(table, seed, block_words, shard_blocks, whole):
    """(words, shards) that the plan takes of each row, one source after another in plain Python."""
    known = sorted({r[2] for r in table if r[2] is not None}) + ([None] if any(r[2] is None for r in table) else [])
    size = [sum(r[1] for r in table if r[2] == s) for s in known]
    goal = targets(size)
    take = [int(g + 0.5) for g in goal]
    wide = [max(1, -(-s // block_words)) for s in size]
    epochs, rest = [t // max(1, s) for t, s in zip(take, size)], [t % max(1, s) for t, s in zip(take, size)]
    drawn = [-(-r * w // max(1, s)) for r, w, s in zip(rest, wide, size)]
    quota = np.array([e * w for e, w in zip(epochs, wide)] + drawn + [w - d if r else 0 for w, d, r in zip(wide, drawn, rest)])
    shards, n = max(1, -(-(sum(quota[: len(known)]) + sum(drawn)) // shard_blocks)), len(known)
    tree = split_quotas(quota.tolist(), int(shards), seed)
    out = {i: [0, []] for i in range(len(table))}
    for k in range(n):
        blocks = [[] for _ in range(wide[k])]
        for i, (ident, words, source) in enumerate(table):
            if source == known[k]:
                place = int(hashlib.md5(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()[:15], 16)
                blocks[((place >> 20) * wide[k]) >> 40].append((place, -(2**63) if ident is None else ident, words, i))
        at, order = 0, []
        for shard in range(int(shards)):
            for _ in range(tree[shard, k]):
                b = int(permuted(np.array([at]), int(quota[k]), (seed, k, 0))[0]) % wide[k]
                for *_, words, i in blocks[b]:
                    out[i][0] += words
                    out[i][1] += [shard] * (words > 0)
                at += 1
        at = 0
        for shard in range(int(shards)):
            for j in range(tree[shard, n + k] + tree[shard, 2 * n + k]):
                order.append((j >= tree[shard, n + k], shard, at, int(permuted(np.array([at]), wide[k], (seed, k, 1))[0])))
                at += 1
        left = rest[k]
        for _, shard, _, b in sorted(order):
            for _, _, words, i in sorted(blocks[b]):
                part = min(words, left)
                left -= part
                if whole and part < words:
                    part = words if part * 2 >= words and part else 0
                out[i][0] += part
                out[i][1] += [shard] * (part > 0)
    return out


@pytest.mark.parametrize("block_words, shard_blocks", [(300, 3), (40, 5), (10**6, 100)])
def test_mix_matches_plain_loops(spark, block_words, shard_blocks):
    rng = random.Random(8)
    table = [(i, rng.randint(0, 60), rng.choice("aaabc")) for i in range(300)] + [(1000, 9000, "a"), (1001, 3, None), (1002, 0, "z")]
    made = docs(spark, [(i, "w " * n, s) for i, n, s in table])
    want = mixed_by_hand(table, 0, block_words, shard_blocks, False)
    got = {r["doc_id"]: (r["taken"], r["shards"]) for r in mix_sizes(made, block_words=block_words, shard_blocks=shard_blocks).collect()}
    assert got == {table[i][0]: (t, sorted(s)) for i, (t, s) in want.items()}
    want = mixed_by_hand(table, 0, block_words, shard_blocks, True)
    copies = {r["doc_id"]: r["count"] for r in mix_documents(made, block_words=block_words, shard_blocks=shard_blocks).groupBy("doc_id").count().collect()}
    assert copies == {table[i][0]: len(s) for i, (_, s) in want.items() if s}


def test_draws_are_disjoint_and_quotas_exact(spark):
    wide, epochs, drawn = np.array([50, 7, 1]), np.array([2, 0, 1]), np.array([13, 5, 0])
    left = np.array([37, 2, 0])
    draws = tree_draws(spark, epochs * wide, drawn, left, wide, 9, 3).toPandas()
    assert not draws.duplicated(["sid", "block", "epoch"]).any()
    last = draws[draws.epoch == epochs[draws.sid]]
    assert (draws[draws.epoch < epochs[draws.sid]].groupby("sid").size() == (epochs * wide)[[0, 2]]).all()
    assert last[last.passed == 0].groupby("sid").size().to_dict() == {0: 13, 1: 5} and last[last.passed == 1].groupby("sid").size().to_dict() == {0: 37, 1: 2}
    assert set(draws.groupby("shard").size()) <= {len(draws) // 9, len(draws) // 9 + 1}
    # what is drawn is not the head of the permutation, but what the tree drew in each shard
    assert last[(last.sid == 0) & (last.passed == 0)]["rank"].max() >= 13


def test_permuted_is_a_permutation():
    for size in (1, 2, 3, 5, 64, 1000):
        assert sorted(permuted(np.arange(size), size, (1, 2)).tolist()) == list(range(size))


def test_mixing_starts_no_workers_for_rows_of_objects(spark, monkeypatch):
    def refuse(self, *rows, **more):
        raise AssertionError("rows of Python objects")

    table = docs(spark, [(i, "a b c " * (1 + i % 5), f"s{i % 3}") for i in range(60)])
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refuse)
    assert mix_documents(table).count() > 0
    assert mix_documents(table.limit(0)).count() == 0
