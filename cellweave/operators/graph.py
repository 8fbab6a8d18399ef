"""Neighbour graphs, diffusion, projections and clustering over vectors (cell, vector)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.checkpoints import saved

#: Rows of a block in the neighbour search, rows compared at once, and dimensions up to which a covariance goes to the driver.
BLOCK, CHUNK, MOST_FEATURES = 16_384, 512, 10_000
#: Features of a slice where rows are multiplied with rows; vectors that the search of eigenvectors has beside those wanted.
SLICE, SPARE = 256, 5


def neighbours(vectors: DataFrame, k: int, id_col: str = "cell", vector_col: str = "vector") -> DataFrame:
    """src, dst, distance of the k nearest rows by Euclidean distance, itself included; ties to the smaller id.

    Rows are dealt to blocks, and a task has one block against another: memory is bounded by two
    blocks, and each pair of blocks gives k rows for each of its rows.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    blocks = max(1, -(-rows.count() // BLOCK))
    own = rows.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    left = own.withColumnRenamed("b", "a").withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = own.withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def pairs(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"src": [], "dst": [], "distance": []})
        y = y.sort_values("id")
        p, q, ids = np.stack(x["v"].tolist()).astype(float), np.stack(y["v"].tolist()).astype(float), y["id"].to_numpy()
        srcs, kept, far = x["id"].to_numpy(), [], []
        size = (q * q).sum(axis=1)
        for lo in range(0, len(p), CHUNK):  # products choose rows that may be among the k, differences decide
            some = p[lo : lo + CHUNK]
            own = (some * some).sum(axis=1)
            near = size - 2 * (some @ q.T)
            most = np.partition(near, k - 1, axis=1)[:, k - 1] if k < len(q) else np.full(len(some), np.inf)
            for i, v in enumerate(some):
                at = np.flatnonzero(near[i] <= most[i] + 1e-9 * (own[i] + size.max())) if np.isfinite(most[i]) else np.arange(len(q))
                d = np.sqrt(((q[at] - v) ** 2).sum(axis=1))
                first = np.lexsort((ids[at], d))[:k]
                kept.append(at[first])
                far.append(d[first])
        return pd.DataFrame({"src": np.repeat(srcs, [len(a) for a in kept]), "dst": ids[np.concatenate(kept)], "distance": np.concatenate(far)})

    kind = vectors.schema[id_col].dataType.simpleString()
    parts = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(pairs, f"src {kind}, dst {kind}, distance double")
    near = Window.partitionBy("src").orderBy("distance", "dst")
    return parts.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= k).select("src", "dst", "distance", "rank")


def smooth(matrix: DataFrame, edges: DataFrame) -> DataFrame:
    """cell, gene, value: the mean over each cell's neighbours, zeros included."""
    n = edges.groupBy("src").agg(F.count(F.lit(1)).alias("k"))
    sums = edges.join(matrix.withColumnRenamed("cell", "dst"), "dst").groupBy("src", "gene").agg(F.sum("value").alias("s"))
    return sums.join(n, "src").select(F.col("src").alias("cell"), "gene", (F.col("s") / F.col("k")).alias("value"))


def affinity(edges: DataFrame, epsilon: float = 1.0) -> DataFrame:
    """src, dst, w = exp(-d / epsilon ** 2), made symmetric by the mean of both directions."""
    w = edges.select("src", "dst", F.exp(-F.col("distance") / (epsilon * epsilon)).alias("w"))
    both = w.unionByName(w.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return both.groupBy("src", "dst").agg((F.sum("w") / 2).alias("w"))


def adaptive_affinity(edges: DataFrame, ka: int = 10) -> DataFrame:
    """src, dst, w = exp(-d / s), s being src's distance to its ka-th neighbour but itself; both directions' sum.

    edges: those of neighbours with a k above ka. Where s is 0, only rows at distance 0 are near: they weigh 1, others 0.
    """
    width = edges.where(F.col("rank") == ka + 1).select("src", F.col("distance").alias("s"))
    w = F.when(F.col("s") > 0, F.exp(-F.col("distance") / F.col("s"))).otherwise((F.col("distance") == 0).cast("double"))
    one = edges.join(width, "src").select("src", "dst", w.alias("w")).where("w > 0")
    return one.unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w")).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def normalise(weights: DataFrame, kind: str = "markov") -> DataFrame:
    """Edges scaled by row sums: markov (rows sum to one), smarkov (by roots on both sides), beltrami, sbeltrami, fokkerplanck, sfokkerplanck."""
    side = lambda t, name: t.groupBy("src").agg(F.sum("w").alias(name))
    on_dst = lambda t, name: t.select(F.col("src").alias("dst"), F.col(name).alias(f"{name}_d"))

    def scaled(t: DataFrame, power: float, both: bool) -> DataFrame:
        sums = side(t, "d")
        out = t.join(sums, "src")
        if both:
            return out.join(on_dst(sums, "d"), "dst").select("src", "dst", (F.col("w") / F.pow(F.col("d") * F.col("d_d"), F.lit(power))).alias("w"))
        return out.select("src", "dst", (F.col("w") / F.pow("d", F.lit(power))).alias("w"))

    steps = {
        "markov": [(1.0, False)], "smarkov": [(0.5, True)], "beltrami": [(1.0, True), (1.0, False)], "sbeltrami": [(1.0, True), (0.5, True)],
        "fokkerplanck": [(0.5, True), (1.0, False)], "sfokkerplanck": [(0.5, True), (0.5, True)],
    }
    out = weights
    for power, both in steps[kind]:
        out = scaled(out, power, both)
    return out


def bistochastic(weights: DataFrame, rounds: int = 30) -> DataFrame:
    """Symmetric scaling to row sums near one, by repeated division through the roots of the sums."""
    out = weights
    for _ in range(rounds):
        out = saved(normalise(out, "smarkov"))
    return out


def power(weights: DataFrame, matrix: DataFrame, steps: int = 3) -> DataFrame:
    """The matrix (cell, gene, value) after so many multiplications by the weights."""
    for _ in range(steps):
        matrix = weights.join(matrix.withColumnRenamed("cell", "dst"), "dst").groupBy(F.col("src").alias("cell"), "gene").agg(F.sum(F.col("w") * F.col("value")).alias("value"))
    return matrix


def eigenpairs(weights: DataFrame, k: int = 10, rounds: int = 200, seed: int = 1, tolerance: float = 1e-6) -> tuple[np.ndarray, DataFrame]:
    """(eigenvalues descending, cell, component, x) of a symmetric sparse operator: the k largest by magnitude.

    Locally optimal block conjugate gradients: a round multiplies the residuals by the operator, a join
    over the edges, and takes the best vectors among old ones, residuals and last steps. Vectors stay
    distributed; only products of 3 * (k + 5) columns reach the driver. It ends when |Ax - ax| of unit
    vectors x is under the tolerance, and raises RuntimeError where the rounds don't suffice.
    Operators of fewer than k cells have as many components as cells, an empty one none.
    """
    weights = saved(weights)
    width = k + SPARE
    hashed = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: F.pmod(F.xxhash64(F.col("cell"), j, F.lit(seed)), F.lit(2_000_003)) / 1_000_001.5 - 1)
    zeros = F.array_repeat(F.lit(0.0), width)
    cells = saved(weights.select(F.col("src").alias("cell")).distinct())
    size = min(k, cells.count())
    if not size:
        return np.zeros(0), cells.select("cell", F.lit(0).alias("component"), F.lit(0.0).alias("x"))
    kind = cells.schema["cell"].dataType.simpleString()
    # s: vectors, residuals and steps side by side; t: the operator's products with the vectors and the steps
    state = cells.select("cell", F.concat(hashed, zeros, zeros).alias("s"), F.concat(zeros, zeros).alias("t"))
    at, values = 0, np.zeros(width)
    for n in range(rounds + 1):
        sums = [F.sum(F.col("w") * F.get("u", F.lit(j))) for j in range(width)]
        turn = state.select(F.col("cell").alias("dst"), F.slice("s", at + 1, width).alias("u"))
        product = weights.join(turn, "dst").groupBy(F.col("src").alias("cell")).agg(F.array(*sums).alias("a"))
        old, last = F.slice("t", 1, width), F.slice("t", width + 1, width)
        t = F.concat("a", zeros, zeros) if n == 0 else F.concat(old, "a", last)
        table = saved(state.join(product, "cell").select("cell", "s", t.alias("t")))
        inner, outer = _products(table, 3 * width)
        left = np.sqrt(np.maximum(np.diag(inner)[width : width + size], 0.0))
        if n and left.max() < tolerance:
            order = np.argsort(-values[:size])
            x = F.array(*[F.get("s", F.lit(int(i))) for i in order])
            return values[order], table.select("cell", F.posexplode(x).alias("component", "x"))
        mix, values = _ritz(inner, outer, width)
        state = _combined(table, mix, values, kind)
        at = width
    raise RuntimeError(f"residuals of {left.max():.1e} after {rounds} rounds")


def _products(table: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Products of the columns of s with those of s and of t, summed over rows."""

    def sums(batches):
        total = np.zeros(2 * width * width)
        for b in batches:
            if len(b):
                s, t = np.stack(b["s"].tolist()), np.stack(b["t"].tolist())
                total += np.concatenate([(s.T @ s).ravel(), (s.T @ t).ravel()])
        yield pd.DataFrame({"p": [total.tolist()]})

    parts = table.select("s", "t").mapInPandas(sums, "p array<double>").select(F.posexplode("p").alias("i", "p"))
    total = parts.groupBy("i").agg(F.sum("p").alias("p")).orderBy("i").toPandas()["p"].to_numpy()
    inner, outer = total.reshape(2, width, width)
    return inner, (outer + outer.T) / 2


def _ritz(inner: np.ndarray, outer: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(combinations of the columns, values) of the largest Ritz pairs by magnitude; dependent columns take no part."""
    norms = np.sqrt(np.maximum(np.diag(inner), 0.0))
    scale = np.where(norms > 0, 1 / np.where(norms > 0, norms, 1.0), 0.0)
    spread, axes = np.linalg.eigh(inner * np.outer(scale, scale))
    kept = spread > 1e-10 * spread.max()
    basis = scale[:, None] * axes[:, kept] / np.sqrt(spread[kept])
    values, turns = np.linalg.eigh(basis.T @ outer @ basis)
    first = np.argsort(-np.abs(values), kind="stable")[:width]
    mix, out = np.zeros((len(inner), width)), np.zeros(width)
    mix[:, : len(first)], out[: len(first)] = basis @ turns[:, first], values[first]
    return mix, out


def _combined(table: DataFrame, mix: np.ndarray, values: np.ndarray, kind: str) -> DataFrame:
    """The next vectors, residuals and steps with the products that are known of them."""
    steps = mix.copy()
    steps[: len(values)] = 0.0

    def rows(batches):
        for b in batches:
            if len(b):
                s, t = np.stack(b["s"].tolist()), np.stack(b["t"].tolist())
                x, a = s @ mix, t @ mix
                yield pd.DataFrame({"cell": b["cell"], "s": list(np.hstack([x, a - x * values, s @ steps])), "t": list(np.hstack([a, t @ steps]))})

    return table.mapInPandas(rows, f"cell {kind}, s array<double>, t array<double>")


def covariance(vectors: DataFrame, vector_col: str = "vector") -> tuple[np.ndarray, np.ndarray, int]:
    """(mean, covariance, rows) from one pass of sums of products."""

    def sums(batches):
        total = None
        for b in batches:
            x = np.stack(b["v"].tolist()) if len(b) else None
            if x is not None:
                part = np.concatenate([[len(x)], x.sum(0), (x.T @ x).ravel()])
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"s": [total.tolist()]})

    parts = vectors.select(F.col(vector_col).cast("array<double>").alias("v")).mapInPandas(sums, "s array<double>")
    total = parts.select(F.posexplode("s").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").toPandas()["s"].to_numpy()
    n = int(total[0])
    width = int(round((-1 + np.sqrt(1 + 4 * (len(total) - 1))) / 2))
    if width > MOST_FEATURES:
        raise ValueError(f"more than {MOST_FEATURES} features")
    mean = total[1 : 1 + width] / n
    return mean, (total[1 + width :].reshape(width, width) - n * np.outer(mean, mean)) / max(1, n - 1), n


def pca(vectors: DataFrame, components: int | float = 20, id_col: str = "cell", vector_col: str = "vector", drop_first: bool = False) -> tuple[np.ndarray, DataFrame]:
    """(eigenvalues, id and projection of the centred rows); a fraction asks for that share of the variance."""
    mean, cov, _ = covariance(vectors, vector_col)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1, 1)
    n = components if components >= 1 else int(np.searchsorted(np.cumsum(values) / values.sum(), components) + 1)
    kept = axes[:, int(drop_first) : int(n)]

    def project(batches):
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "projection": list((np.stack(b["v"].tolist()) - mean) @ kept) if len(b) else []})

    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).mapInPandas(project, f"id {kind}, projection array<double>")
    return values, rows.withColumnRenamed("id", id_col)


def gram_pca(vectors: DataFrame, components: int = 20, id_col: str = "cell", vector_col: str = "vector", drop_first: bool = False) -> tuple[np.ndarray, DataFrame]:
    """pca where rows are fewer than features: (eigenvalues, id and projection of the centred rows).

    A task has a slice of the features of all rows and sums its products of rows; only the rows by rows
    matrix reaches the driver. More than MOST_FEATURES rows are refused, as pca takes those.
    """
    ids = [r["id"] for r in vectors.select(F.col(id_col).alias("id")).orderBy("id").limit(MOST_FEATURES + 1).collect()]
    n = len(ids)
    if n > MOST_FEATURES:
        raise ValueError(f"more than {MOST_FEATURES} rows")
    row = vectors.select((F.row_number().over(Window.orderBy(id_col)) - 1).alias("i"), F.col(vector_col).cast("array<double>").alias("v"))
    slices = row.select("i", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((F.size("v") - 1) / SLICE).cast("int")), lambda b: F.slice("v", b * SLICE + 1, F.lit(SLICE)))).alias("b", "part"))

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf.sort_values("i")["part"].tolist())
        x -= x.mean(axis=0)
        g = x @ x.T
        return pd.DataFrame({"i": np.arange(len(g)), "g": list(g)})

    parts = slices.groupBy("b").applyInPandas(products, "i int, g array<double>").select("i", F.posexplode("g").alias("j", "g"))
    sums = parts.groupBy("i", "j").agg(F.sum("g").alias("g")).toPandas()
    gram = np.zeros((n, n))
    gram[sums["i"], sums["j"]] = sums["g"]
    values, rows = np.linalg.eigh(gram)
    values, rows = np.maximum(values[::-1], 0.0), rows[:, ::-1]
    rows = rows * np.where(rows[np.abs(rows).argmax(0), np.arange(n)] < 0, -1, 1)
    placed = (rows * np.sqrt(values))[:, int(drop_first) : int(components)]
    kind = vectors.schema[id_col].dataType.simpleString()
    out = vectors.sparkSession.createDataFrame([(i, [float(v) for v in p]) for i, p in zip(ids, placed)], f"{id_col} {kind}, projection array<double>")
    return values / max(1, n - 1), out


def regress_out(projection: DataFrame, sizes: DataFrame) -> DataFrame:
    """Components less their line on library size: cell, component, x from cell, component, x and cell, size."""
    rows = projection.join(sizes, "cell")
    line = rows.groupBy("component").agg(F.regr_slope("x", "size").alias("m"), F.regr_intercept("x", "size").alias("c"))
    return rows.join(line, "component").select("cell", "component", (F.col("x") - F.coalesce(F.col("m") * F.col("size") + F.col("c"), F.lit(0.0))).alias("x"))


def jaccard_edges(edges: DataFrame) -> DataFrame:
    """src, dst (src < dst), w: overlap of the neighbour sets of neighbours."""
    sets = edges.groupBy("src").agg(F.sort_array(F.collect_set("dst")).alias("s"))
    pairs = edges.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    both = pairs.join(sets, "src").join(sets.select(F.col("src").alias("dst"), F.col("s").alias("t")), "dst")
    return both.select("src", "dst", (F.size(F.array_intersect("s", "t")) / F.size(F.array_union("s", "t"))).alias("w")).where("w > 0")


def communities(weights: DataFrame, rounds: int = 20) -> DataFrame:
    """cell, cluster by label propagation: each round takes the heaviest label among neighbours, ties to the smallest.

    A cell's own label counts with its heaviest edge, which stops two labels from changing places.
    """
    both = weights.unionByName(weights.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    own = both.groupBy("src").agg(F.max("w").alias("w")).select("src", F.col("src").alias("dst"), "w")
    both = saved(both.unionByName(own))
    now = both.select(F.col("src").alias("cell")).distinct().withColumn("cluster", F.col("cell"))
    for _ in range(rounds):
        heard = both.join(now.select(F.col("cell").alias("dst"), "cluster"), "dst").groupBy("src", "cluster").agg(F.sum("w").alias("w"))
        new = saved(heard.groupBy("src").agg(F.max(F.struct(F.round("w", 12).alias("w"), (-F.col("cluster")).alias("low")))["low"].alias("low")).select(F.col("src").alias("cell"), (-F.col("low")).alias("cluster")))
        moved = new.join(now.withColumnRenamed("cluster", "old"), "cell").where("cluster <> old").limit(1).count()
        now = new
        if not moved:
            break
    return now


def tree_paths(merges: DataFrame) -> DataFrame:
    """node, ancestor pairs of a dendrogram given as edges (parent, child), itself included, by doubling joins.

    Rows are the sum of the nodes' depths, the size of the result.
    """
    up = merges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor"))
    nodes = up.select("node").unionByName(up.select(F.col("ancestor").alias("node"))).distinct()
    every = up
    while True:
        more = every.join(every.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("next")), "ancestor").select("node", F.col("next").alias("ancestor"))
        grown = saved(every.unionByName(more).distinct())
        if grown.count() == every.count():
            return grown.unionByName(nodes.select("node", F.col("node").alias("ancestor")))
        every = grown


def linkage_edges(linkage: DataFrame) -> DataFrame:
    """parent, child, side (0 left, 1 right), distance of a linkage table (step from 0, left, right, distance).

    Leaves are numbered 0 to the number of steps, and step s makes the node after them all: steps + 1 + s.
    """
    steps = linkage.agg(F.count(F.lit(1)).alias("__n"))
    sides = F.array(F.struct(F.col("left").cast("long").alias("child"), F.lit(0).alias("side")), F.struct(F.col("right").cast("long").alias("child"), F.lit(1).alias("side")))
    rows = linkage.crossJoin(F.broadcast(steps)).select((F.col("step") + F.col("__n") + 1).cast("long").alias("parent"), "distance", F.inline(sides))
    return rows.select("parent", "child", "side", "distance")


def tree_order(edges: DataFrame) -> DataFrame:
    """node, depth, dfs, bfs: places, from 0, of a depth-first walk that takes right sides first and a breadth-first one that takes left sides first.

    edges: parent, child, side. A node's path is the sides from the root down to it; sorted paths give both walks.
    """
    above = saved(tree_paths(edges.select("parent", "child")))
    depth = above.groupBy("node").agg((F.count(F.lit(1)) - 1).alias("depth"))
    turns = above.join(depth.select(F.col("node").alias("ancestor"), F.col("depth").alias("d")), "ancestor").join(edges.select(F.col("child").alias("ancestor"), "side"), "ancestor", "left")
    path = F.transform(F.array_sort(F.collect_list(F.when(F.col("d") > 0, F.struct("d", "side")))), lambda t: t["side"])
    nodes = turns.groupBy("node").agg(path.alias("path")).join(depth, "node")
    deep, wide = Window.orderBy(F.transform("path", lambda s: 1 - s)), Window.orderBy("depth", "path")
    return nodes.select("node", "depth", (F.row_number().over(deep) - 1).cast("long").alias("dfs"), (F.row_number().over(wide) - 1).cast("long").alias("bfs"))
