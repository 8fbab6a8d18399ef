"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are ordered by a hash of (seed, identifier) and cut into blocks. A target of
several times the source's size draws every block once an epoch, and of the last epoch a part: about
as many blocks as the rest of the target needs are marked drawn, the others left.

The tree starts from the sources' exact numbers of block draws (of full epochs; drawn and left of the
last) and all output shards; each node draws, without replacement, how many of each go to its left
half. A shard takes the next draws of each source's permutation, so that no draw occurs twice, and of
its blocks of the last epoch the number that the tree drew: the tree decides what is taken. Blocks
differ in words, so the order (drawn before left, then by shard and rank) is cut where the source's
target is met, inside a document. A shard orders its rows by a hash of its own.

The upper tree is split on the driver, into at most TOP parts, the rest by tasks, one a part. The
driver holds a few whole numbers a source and part, no names and no blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

WORD = r"[^\x20\x09-\x0D]+"
#: Weights by the sources' order, repeating; the most times a source is taken; words in a block and blocks in a shard.
WEIGHTS, MOST, BLOCK_WORDS, SHARD_BLOCKS = (5, 2, 1), 3, 1 << 13, 1 << 9
#: Parts of the tree that tasks split further.
TOP = 256
NONE = -(2**63)
DRAWS = "sid long, block long, epoch long, shard int, rank long, passed int"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(ident: Column, seed: int) -> Column:
    """A document's place in its source's order, as 60 bits."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> list[float]:
    """Targets of sources in order: shares of the total by weight, stopped at most times a size, the excess shared again."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    rest, left, level = sum(sizes), sum(weight), 0.0
    for i in sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weight[i]):
        level = rest / left
        if most * sizes[i] / weight[i] >= level:
            break
        rest, left = rest - most * sizes[i], left - weight[i]
    return [min(float(most * s), w * level) for s, w in zip(sizes, weight, strict=True)]


def split(quotas: np.ndarray, starts: np.ndarray, span: tuple[int, int], shards: int, total: int, seed: int, stop: int = 1) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first shard, end, quotas, draws before them) of the parts of at most ``stop`` shards below a node, in order."""
    a, b = span
    if b - a <= stop:
        yield a, b, quotas, starts
        return
    mid = (a + b) // 2
    room = total * mid // shards - total * a // shards
    left = np.random.default_rng((seed, a, b)).multivariate_hypergeometric(quotas, room, method="marginals") if len(quotas) else quotas
    yield from split(left, starts, (a, mid), shards, total, seed, stop)
    yield from split(quotas - left, starts + left, (mid, b), shards, total, seed, stop)


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Draws of each source in each shard: an array of shards by sources with the quotas as column sums."""
    q = np.array(quotas, np.int64)
    return np.stack([x for _, _, x, _ in split(q, np.zeros_like(q), (0, shards), shards, int(q.sum()), seed)])


def permuted(x: np.ndarray, size: int, seed: tuple[int, ...]) -> np.ndarray:
    """Places of ranks in a permutation of range(size): a Feistel network, walked until it falls into the range."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask, keys = np.uint64((1 << half) - 1), np.random.default_rng(seed).integers(1, 1 << 62, 4, dtype=np.uint64)
    out, left = x.astype(np.uint64), np.arange(len(x))
    while len(left):
        high, low = out[left] >> np.uint64(half), out[left] & mask
        for key in keys:
            mixed = (low + key) * np.uint64(0x9E3779B97F4A7C15)
            high, low = low, high ^ ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(17) & mask)
        out[left] = high << np.uint64(half) | low
        left = left[out[left] >= np.uint64(size)]
    return out.astype(np.int64)


def numbered(sizes: DataFrame) -> DataFrame:
    """sizes(source, source_size) with sid, the source's number by code point, null last."""
    ordered = written(sizes.repartitionByRange(F.asc_nulls_last("source")).sortWithinPartitions(F.asc_nulls_last("source")).withColumn("mid", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("mid", 33)
    count = sorted((r["part"], r["n"]) for r in ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row a partition
    before = np.cumsum([0, *(n for _, n in count)])
    offsets = sizes.sparkSession.createDataFrame(pa.table({"part": pa.array([p for p, _ in count], pa.int64()), "before": pa.array(before[: len(count)], pa.int64())}))
    return ordered.withColumn("part", part).join(offsets, "part").select("source", "source_size", (F.col("before") + F.col("mid").bitwiseAND((1 << 33) - 1)).alias("sid"))


def tree_draws(spark, full: np.ndarray, drawn: np.ndarray, left: np.ndarray, blocks: np.ndarray, shards: int, seed: int) -> DataFrame:
    """DRAWS of sources with so many draws of full epochs, and blocks drawn and left of the last. passed: the tree left this block."""
    n, quotas = len(blocks), np.concatenate([full, drawn, left])
    total = int(quotas.sum())
    parts = list(split(quotas, np.zeros_like(quotas), (0, shards), shards, total, seed, -(-shards // TOP))) if n else []
    shared = spark.sparkContext.broadcast((full, blocks))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, wide = shared.value
        for batch in batches:
            for a, b, q, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for shard, _, own, start in split(np.array(q, np.int64), np.array(s, np.int64), (a, b), shards, total, seed):
                    for sid in np.flatnonzero(own[:n]).tolist():
                        rank = start[sid] + np.arange(own[sid])
                        at = permuted(rank, int(whole[sid]), (seed, sid, 0))
                        yield _draws(sid, at % wide[sid], at // wide[sid], shard, rank, np.zeros(len(rank), np.int32))
                    pool, begin = own[n : 2 * n] + own[2 * n :], start[n : 2 * n] + start[2 * n :]
                    for sid in np.flatnonzero(pool).tolist():
                        rank = begin[sid] + np.arange(pool[sid])
                        passed = (np.arange(pool[sid]) >= own[n + sid]).astype(np.int32)
                        yield _draws(sid, permuted(rank, int(wide[sid]), (seed, sid, 1)), np.full(len(rank), whole[sid] // wide[sid]), shard, rank, passed)

    kinds = {"a": pa.int32(), "b": pa.int32(), "q": pa.list_(pa.int64()), "s": pa.list_(pa.int64())}
    # as Arrow: rows of Python objects would start RDD workers on the executors, which stay
    table = pa.table({c: pa.array([x[k] for x in parts], kind) for k, (c, kind) in enumerate(kinds.items())})
    rows = spark.createDataFrame(table).repartition(max(1, len(parts)))
    return written(rows.mapInArrow(leaves, DRAWS), "tree")


def _draws(sid: int, block: np.ndarray, epoch: np.ndarray, shard: int, rank: np.ndarray, passed: np.ndarray) -> pa.RecordBatch:
    n = len(rank)
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, sid)), pa.array(block), pa.array(epoch), pa.array(np.full(n, shard, np.int32)), pa.array(rank), pa.array(passed)], names=["sid", "block", "epoch", "shard", "rank", "passed"])


def plan_mix(rows: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sources, draws) for rows(source, place, doc_id, size).

    sources: source, sid, source_size, target, blocks. draws: sid, block, epoch, shard, and of the
    one block that ends a source's last epoch cut_place, cut_id and cut_words, of the document that
    it ends in. With whole, that document is taken whole or not at all, whichever is nearer.
    """
    spark = rows.sparkSession
    found = written(numbered(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), "found")
    sizes = found.select("sid", "source_size").toPandas().sort_values("sid")["source_size"].to_numpy(np.int64)
    goal = np.array(targets(sizes.tolist(), weights, most))
    take, wide, some = (goal + 0.5).astype(np.int64), np.maximum(1, -(-sizes // block_words)), np.maximum(sizes, 1)
    epochs, rest = take // some, take % some
    drawn = -(-rest * wide // some)
    shards = max(1, -(-int((epochs * wide + drawn).sum()) // shard_blocks))
    facts = spark.createDataFrame(pa.table({"sid": np.arange(len(sizes)), "target": goal.astype(float), "blocks": wide, "epochs": epochs, "rest": rest}))
    sources = written(found.join(facts, "sid"), "sources")
    tree = tree_draws(spark, epochs * wide, drawn, np.where(rest > 0, wide - drawn, 0), wide, shards, seed)

    laid = rows.join(sources.select(F.col("source").alias("same"), "sid", "blocks", "epochs", "rest"), F.col("source").eqNullSafe(F.col("same"))).withColumn("block", block_of())
    blocks = laid.groupBy("sid", "block", "epochs", "rest").agg(F.sum("size").alias("words")).where("rest > 0 and words > 0")
    last = written(blocks.join(tree, ["sid", "block"]).where("epoch = epochs").select("sid", "block", "passed", "shard", "rank", "words", "rest"), "last")
    # the target is met in one shard's drawn or left blocks, there in one block, and there in one document
    group = ["passed", "shard"]
    sums = last.groupBy("sid", *group, "rest").agg(F.sum("words").alias("words"))
    met = _met(sums, group, "rest").select("sid", *group, "need")
    met = _met(last.drop("rest").join(met, ["sid", *group]), ["rank"], "need").select("sid", "block", *group, "rank", "need")
    inside = laid.select("sid", "block", "place", F.coalesce("doc_id", F.lit(NONE).cast("long")).alias("id"), F.col("size").alias("words")).join(met, ["sid", "block"])
    ends = _met(inside, ["place", "id", "words"], "need").groupBy("sid", "block", *group, "rank").agg(F.max(F.struct("place", "id", "need", "words")).alias("end"))
    part = F.when(F.lit(whole), F.when(F.col("end.need") * 2 >= F.col("end.words"), F.col("end.words")).otherwise(0)).otherwise(F.col("end.need"))
    ends = written(ends.select("sid", F.struct(*group, "rank").alias("cut"), F.col("end.place").alias("cut_place"), F.col("end.id").alias("cut_id"), part.alias("cut_words")), "ends")

    here = F.struct(*group, "rank")
    placed = tree.join(sources.select("sid", "epochs"), "sid").join(ends, "sid", "left")
    at_cut = (F.col("epoch") == F.col("epochs")) & (here == F.col("cut"))
    kept = placed.where((F.col("epoch") < F.col("epochs")) | (here <= F.col("cut")))
    cut = [F.when(at_cut, F.col(c)).alias(c) for c in ("cut_place", "cut_id", "cut_words")]
    return sources.select("source", "sid", "source_size", "target", "blocks"), written(kept.select("sid", "block", "epoch", "shard", *cut), "draws")


def _met(rows: DataFrame, order: list[str], goal: str) -> DataFrame:
    """Of each source's rows in order, the one in which the sum of words reaches the goal; need is the part of its words."""
    before = F.sum("words").over(Window.partitionBy("sid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words")
    return rows.withColumn("__need", F.col(goal) - before).where("__need > 0 and __need <= words").drop("need").withColumnRenamed("__need", "need")


def block_of() -> Column:
    """The block of a row with place and its source's number of blocks."""
    return F.shiftright(F.shiftright("place", 20) * F.col("blocks"), 40)


def taken_of() -> Column:
    """Words that one draw takes of a document: all, or in the block that ends the last epoch up to the cut."""
    ident = F.coalesce(F.col("doc_id"), F.lit(NONE).cast("long"))
    ahead = (F.col("place") < F.col("cut_place")) | ((F.col("place") == F.col("cut_place")) & (ident < F.col("cut_id")))
    here = (F.col("place") == F.col("cut_place")) & (ident == F.col("cut_id"))
    return F.when(F.col("cut_place").isNull() | ahead, F.col("size")).when(here, F.least("size", "cut_words")).otherwise(0)


def draw_documents(docs: DataFrame, sources: DataFrame, draws: DataFrame) -> DataFrame:
    """Each drawn copy of a document with its columns, sid, epoch, shard, taken; docs has source, place, doc_id, size."""
    known = sources.select(F.col("source").alias("same"), "sid", "blocks")
    laid = docs.join(known, docs["source"].eqNullSafe(F.col("same"))).withColumn("block", block_of())
    return laid.join(draws, ["sid", "block"]).withColumn("taken", taken_of()).drop("same", "blocks", "cut_place", "cut_id", "cut_words", "block")


def mix_sizes(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **plan) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken, shards (of the draws that take words of it, in order).

    Null and blank texts have size 0 and nothing is taken of them. Rows that repeat an identifier
    lie next to one another in their source's order. An empty table gives an empty result.
    """
    rows = written(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), words(F.col(text_col)).alias("size"), F.col(source_col).cast("string").alias("source"))
        .withColumn("place", place(F.col("doc_id"), seed)).withColumn("rid", F.monotonically_increasing_id()),
        "sizes",
    )
    sources, draws = plan_mix(rows, seed, **plan)
    copies = draw_documents(rows, sources, draws).where("taken > 0")
    taken = copies.groupBy("rid").agg(F.sum("taken").alias("taken"), F.sort_array(F.collect_list("shard")).alias("shards"))
    facts = sources.select(F.col("source").alias("same"), "source_size", "target")
    shown = rows.join(taken, "rid", "left").join(facts, F.col("source").eqNullSafe(F.col("same")))
    return shown.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("shards", F.array().cast("array<int>")).alias("shards"))


def mix_documents(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **plan) -> DataFrame:
    """The mixed corpus: rows of docs with their own columns, a row for each copy, dealt to shards and shuffled in them.

    Documents are taken whole; empty ones have no words to take and stay out.
    """
    sized = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("doc_id"), words(F.col(text_col)).alias("size"), F.col(source_col).cast("string").alias("source")).withColumn("place", place(F.col("doc_id"), seed))
    rows = written(sized.drop("row"), "sizes")
    sources, draws = plan_mix(rows, seed, whole=True, **plan)
    drawn = draw_documents(sized, sources, draws).where("taken > 0")
    return drawn.repartition("shard").sortWithinPartitions("shard", F.xxhash64("shard", "epoch", "place")).select("row.*")
