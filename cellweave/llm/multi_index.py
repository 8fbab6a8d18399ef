"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes by a learned rotation: quantization error against the signs is
minimised by turns over a bounded sample. Codes are cut into byte-wide substrings, and each
substring is indexed: in a shard of rows, a bitmap of rows for every value. By the pigeonhole
principle a code within radius r agrees with the query's to within r // m in one of m substrings,
so the union of the bitmaps of all values in such balls holds every code within the radius; those
are checked against the whole code, and what remains is ranked by the vectors themselves. Where a
shard has too few within the radius, it is widened until there are enough or all have been seen.

Inner products of vectors of any length are searched as angles: candidates get one more component
that makes all lengths equal, and queries get zero there.

Each block of queries meets each shard in a task of bounded size, and the shards' best are merged; equal vectors are
searched once, as they tie for every query and only the smallest identifiers can be in a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import written

#: Bits of a code; rows the rotation is learned on, expected; rounds; rows in a shard; queries in a block.
BITS, SAMPLE, ROUNDS, SHARD, BLOCK = 256, 20_000, 25, 8192, 4096
#: Share of the sample's neighbours that the radius has to hold.
RECALL = 0.985

RESULT = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
_POP = np.array([bin(k).count("1") for k in range(256)], np.uint8)
#: Values within each distance of each byte: [distance][value] is a list.
_BALLS = [[np.flatnonzero(_POP[np.arange(256) ^ v] <= r) for v in range(256)] for r in range(9)]


class Rotation:
    """Centre, and rotations learned from different starts, one for each width of the vectors."""

    def __init__(self, sample: np.ndarray, longest: float, bits: int = BITS, rounds: int = ROUNDS, seed: int = 3):
        width = sample.shape[1]
        self.longest = longest
        rng, points = np.random.default_rng(seed), self.lifted(sample)
        self.centre, turns = points.mean(0) if len(points) else np.zeros(width + 1), []
        points = points - self.centre
        for _ in range(-(-bits // (width + 1))):
            turn = np.linalg.qr(rng.normal(size=(width + 1, width + 1)))[0]
            for _ in range(rounds if len(points) else 0):
                a, _, b = np.linalg.svd(points.T @ np.where(points @ turn > 0, 1.0, -1.0))
                turn = a @ b
            turns.append(turn)
        self.turn = np.concatenate(turns, axis=1)[:, :bits]

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Candidates divided by the greatest length, with the component that makes lengths one."""
        x = x / self.longest
        return np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x**2).sum(1, keepdims=True)))], axis=1)

    def codes(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Packed bits, a byte for each substring."""
        if query:
            x = np.concatenate([x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300), np.zeros((len(x), 1))], axis=1)
        else:
            x = self.lifted(x)
        return np.packbits((x - self.centre) @ self.turn > 0, axis=1)


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows with one vector, in double precision, each row's sum in the same order."""
    return np.einsum("ij,j->i", x, q)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids."""
    if len(ids) > 4 * k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(ids))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


class Index:
    """One shard: rows' vectors and codes, and for each substring and value a bitmap of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rotation: Rotation):
        self.ids, self.vectors, self.codes = ids, vectors, rotation.codes(vectors)
        self.words = self.codes.view(np.uint64)
        n, self.m = self.codes.shape
        hot = np.zeros((self.m, 256, -(-n // 8) * 8), np.uint8)
        hot[np.repeat(np.arange(self.m), n), self.codes.T.ravel(), np.tile(np.arange(n), self.m)] = 1
        self.maps = np.packbits(hot, axis=2)
        self.balls: dict = {}

    def ball(self, sub: int, value: int, radius: int) -> np.ndarray:
        if (known := self.balls.get((sub, value, radius))) is None:
            known = self.balls[sub, value, radius] = np.bitwise_or.reduce(self.maps[sub, _BALLS[min(radius, 8)][value]], axis=0)
        return known

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within the radius of the query's."""
        each, more = divmod(radius, self.m)
        found = np.zeros(self.maps.shape[2], np.uint8)
        for sub in range(self.m):  # the first more + 1 substrings to r // m, the others to one less
            near = each if sub <= more else each - 1
            if near >= 0:
                found |= self.ball(sub, int(code[sub]), near)
        rows = np.flatnonzero(np.unpackbits(found)[: len(self.ids)])
        return rows[np.bitwise_count(self.words[rows] ^ code.view(np.uint64)).sum(1) <= radius]

    def search(self, code: np.ndarray, query: np.ndarray, radius: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best of the rows within the radius, widened while there are fewer than k."""
        while True:
            rows = self.within(code, radius)
            if len(rows) >= min(k, len(self.ids)) or radius >= 8 * self.m:
                break
            radius += self.m
        scores = products(self.vectors[rows], query)
        at = best(self.ids[rows], scores, k)
        return self.ids[rows[at]], scores[at]


def learn(sample: np.ndarray, longest: float, k: int, recall: float = RECALL, bits: int = BITS) -> tuple[Rotation, int]:
    """The rotation, and the radius that holds the share ``recall`` of the k nearest of sampled queries in the sample."""
    rotation = Rotation(sample, longest, bits)
    if len(sample) < 2:
        return rotation, bits
    queries = sample[:: max(1, len(sample) // 300)][:300]
    codes, own = rotation.codes(sample).view(np.uint64), rotation.codes(queries, query=True).view(np.uint64)
    far = []
    for q, c in zip(queries, own, strict=True):
        near = np.argsort(-products(sample, q), kind="stable")[: k + 1]
        far.append(np.bitwise_count(codes[near] ^ c).sum(1))
    return rotation, int(np.quantile(np.concatenate(far), recall))


def clean_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part: not null, zero, or with a null, NaN or infinite component."""
    v = F.col(vector_col).cast("array<double>")
    return table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector")).where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)).where(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    )


def nearest(table: DataFrame, queries: DataFrame, k: int = 20, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's k nearest rows of table by inner product, but for rows of its own identifier: query_id, rank, vec_id, score.

    queries has the columns of table. Vectors of another width than the most frequent one, null or
    zero ones and ones with components that are not finite take no part. Rows that repeat an
    identifier and a vector count once. Empty tables give an empty result.
    """
    spark = table.sparkSession
    rows = written(clean_vectors(table, id_col, vector_col), "vectors")
    widths = rows.groupBy(F.size("vector").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").first()
    if widths is None:
        return spark.createDataFrame([], RESULT)
    rows = rows.where(F.size("vector") == widths["w"])
    share = min(1.0, SAMPLE / widths["n"])
    chosen = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30)) < share * (1 << 30)).limit(2 * SAMPLE).toPandas()
    chosen = chosen.sort_values("vec_id", kind="stable")
    longest = rows.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))).first()[0] ** 0.5
    rotation, radius = learn(np.stack(chosen["vector"].tolist()) if len(chosen) else np.zeros((0, widths["w"])), longest, k, recall)
    tools = spark.sparkContext.broadcast((rotation, radius))

    # candidates: a distinct vector and its k + 1 smallest identifiers
    ranked = rows.dropDuplicates(["vec_id", "vector"]).withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    distinct = ranked.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    distinct = written(distinct.select(F.element_at("ids", 1).alias("vid"), "vector", "ids"), "distinct")
    shards = max(1, -(-distinct.count() // SHARD))
    wanted = clean_vectors(queries, id_col, vector_col).where(F.size("vector") == widths["w"]).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("qv")).distinct()
    asked = written(wanted.join(distinct.select(F.col("vector").alias("qv"), F.col("vid").alias("qid"), "ids"), "qv", "left"), "asked")
    points = asked.select(F.coalesce("qid", -1 - F.col("query_id")).alias("qid"), "qv").dropDuplicates(["qid"])
    blocks = max(1, -(-points.count() // BLOCK))
    dealt = points.withColumn("block", F.pmod(F.xxhash64("qid"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    base = distinct.select("vid", "vector", F.pmod(F.xxhash64("vid"), F.lit(shards)).cast("int").alias("shard")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"qid": [], "vid": [], "score": []})
        turn, r = tools.value
        right = right.sort_values("vid")
        index = Index(right["vid"].to_numpy(), np.stack(right["vector"].tolist()), turn)
        q = np.stack(left["qv"].tolist())
        found = [index.search(c, v, r, k + 1) for c, v in zip(turn.codes(q, query=True), q, strict=True)]
        return pd.DataFrame({"qid": np.repeat(left["qid"].to_numpy(), [len(i) for i, _ in found]), "vid": np.concatenate([i for i, _ in found]), "score": np.concatenate([s for _, s in found])})

    parts = dealt.groupBy("shard", "block").cogroup(base.groupBy("shard", "block")).applyInPandas(probe, "qid long, vid long, score double")
    merged = Window.partitionBy("qid").orderBy(F.desc("score"), "vid")
    top = parts.withColumn("place", F.row_number().over(merged)).where(F.col("place") <= k + 1).drop("place")
    # a query's own vector may stand for several rows; the query itself leaves, and others follow
    each = asked.withColumn("qid", F.coalesce("qid", -1 - F.col("query_id"))).select("query_id", "qid").join(top, "qid").join(distinct.select("vid", "ids"), "vid")
    rows = each.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
