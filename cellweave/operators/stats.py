"""Statistics over long matrices: rank tests, G-test, correlation, distances, normalisation, resampling.

A matrix is rows (cell, gene, value); cells and genes without a row have value 0. Rank tests add
the zeros as one tied value with a count, so that no dense matrix is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.checkpoints import saved
from cellweave.functions import special

from .testing import tsbh_adjust


#: Rows of a block in the correlation of all rows with all rows: a block of pairs has this number squared. Pairs that a worker hands over at once.
#: Pairs of a run that is followed by the same pairs the other way round: Parquet's compressor sees 64 KB, so the second run must be near.
BLOCK, PAIRS, RUN = 1024, 1 << 16, 32


def with_zeros(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """gene, label, value, n: how many cells of each label have each value of each gene, zeros included."""
    seen = matrix.join(labels, "cell").where("value <> 0").groupBy("gene", "label", "value").agg(F.count(F.lit(1)).alias("n"))
    sizes = labels.groupBy("label").agg(F.countDistinct("cell").alias("cells"))
    genes = matrix.select("gene").distinct()
    nonzero = seen.groupBy("gene", "label").agg(F.sum("n").alias("seen"))
    groups = [(r["label"], r["cells"]) for r in sizes.orderBy("label").collect()]
    every = genes.withColumn("g", F.explode(F.array(*[F.struct(F.lit(k).alias("label"), F.lit(n).cast("long").alias("cells")) for k, n in groups]))).select("gene", "g.label", "g.cells")
    zeros = every.join(nonzero, ["gene", "label"], "left").select("gene", "label", F.lit(0).cast(matrix.schema["value"].dataType).alias("value"), (F.col("cells") - F.coalesce("seen", F.lit(0))).alias("n")).where("n > 0")
    return seen.unionByName(zeros)


def non_negative(rows: DataFrame, value: str = "value") -> DataFrame:
    """The rows as they are; the job that reads them fails at a value under zero."""
    refused = F.raise_error(F.concat(F.lit("negative value "), F.col(value).cast("string"))).cast(rows.schema[value].dataType)
    return rows.withColumn(value, F.when(F.col(value) < 0, refused).otherwise(F.col(value)))


def aligned(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """cell and label of every cell of cells(cell), once; the job fails at a cell with no label row or with several."""
    once = labels.groupBy("cell").agg(F.first("label").alias("label"), F.count(F.lit(1)).alias("rows"))
    found = cells.select("cell").distinct().join(once, "cell", "left")
    refused = F.raise_error(F.concat(F.lit("no single label for cell "), F.col("cell").cast("string"))).cast(labels.schema["label"].dataType)
    return found.select("cell", F.when(F.coalesce("rows", F.lit(0)) != 1, refused).otherwise(F.col("label")).alias("label"))


def by_q(tests: DataFrame, rounded: list[str]) -> DataFrame:
    """Tests in the order of q, then gene, with columns rounded to two places."""
    places = [F.bround(F.col(c), 2).alias(c) if c in rounded else F.col(c) for c in tests.columns]
    return tests.select(*places).orderBy("q", "gene")


def _ranked(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """gene, label, value, n, rank (average over ties of all labels), ties (number of tied cells)."""
    rows = saved(with_zeros(saved(matrix.select("cell", "gene", "value")), saved(labels)))
    values = rows.groupBy("gene", "value").agg(F.sum("n").alias("ties"))
    before = F.sum("ties").over(Window.partitionBy("gene").orderBy("value")) - F.col("ties")
    return saved(rows.join(values.withColumn("rank", before + (F.col("ties") + 1) / 2.0), ["gene", "value"]))


def mann_whitney(matrix: DataFrame, labels: DataFrame, first, second) -> DataFrame:
    """gene, u (the smaller), z (of the first label, with tie and continuity correction) for two labels."""
    ranked = _ranked(matrix, labels.where(F.col("label").isin(first, second)))
    one = F.col("label") == F.lit(first)
    sums = ranked.groupBy("gene").agg(F.sum(F.when(one, F.col("rank") * F.col("n"))).alias("r1"), F.sum(F.when(one, F.col("n")).otherwise(0)).alias("n1"), F.sum(F.when(one, 0).otherwise(F.col("n"))).alias("n2"))
    ties = ranked.select("gene", "value", "ties").distinct().groupBy("gene").agg(F.sum(F.pow("ties", F.lit(3.0)) - F.col("ties")).alias("t"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    nt, u = n1 + n2, F.col("r1") - n1 * (n1 + 1) / 2
    variance = ((nt * nt * nt - nt) / 12 - F.col("t") / 12) * n1 * n2 / (nt * (nt - 1))
    z = F.when(variance > 0, (u - 0.5 - n1 * n2 / 2) / F.sqrt(variance))
    return sums.join(ties, "gene").select("gene", F.least(u, n1 * n2 - u).alias("u"), z.alias("z"))


def kruskal(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """gene, h (tie-corrected), df."""
    ranked = _ranked(matrix, labels)
    each = ranked.groupBy("gene", "label").agg(F.sum(F.col("rank") * F.col("n")).alias("r"), F.sum("n").alias("n"))
    ties = ranked.select("gene", "value", "ties").distinct().groupBy("gene").agg(F.sum(F.pow("ties", F.lit(3.0)) - F.col("ties")).alias("t"))
    total = each.groupBy("gene").agg(F.sum("n").cast("double").alias("nt"), F.sum(F.col("r") * F.col("r") / F.col("n")).alias("s"), (F.count(F.lit(1)) - 1).alias("df"))
    nt = F.col("nt")
    correction = 1 - F.col("t") / (nt * nt * nt - nt)
    return total.join(ties, "gene").select("gene", F.when(correction > 0, (12 / (nt * (nt + 1)) * F.col("s") - 3 * (nt + 1)) / correction).alias("h"), F.col("df").cast("long").alias("df"))


def post_hoc(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """Welch's t on ranks for each gene and pair of labels a < b: gene, a, b, t, df."""
    ranked = _ranked(matrix, labels)
    stat = ranked.groupBy("gene", "label").agg(F.sum("n").cast("double").alias("n"), F.sum(F.col("rank") * F.col("n")).alias("s"), F.sum(F.col("rank") * F.col("rank") * F.col("n")).alias("q"))
    stat = stat.select("gene", "label", "n", (F.col("s") / F.col("n")).alias("m"), ((F.col("q") - F.col("s") * F.col("s") / F.col("n")) / F.nullif(F.col("n") - 1, F.lit(0.0)) / F.col("n")).alias("v"))
    a = stat.select("gene", *[F.col(c).alias(f"a_{c}") for c in ("label", "n", "m", "v")])
    b = stat.select("gene", *[F.col(c).alias(f"b_{c}") for c in ("label", "n", "m", "v")])
    both = a.join(b, "gene").where("a_label < b_label")
    pool = F.col("a_v") + F.col("b_v")
    df = pool * pool / (F.col("a_v") * F.col("a_v") / (F.col("a_n") - 1) + F.col("b_v") * F.col("b_v") / (F.col("b_n") - 1))
    return both.select("gene", F.col("a_label").alias("a"), F.col("b_label").alias("b"), F.when(pool > 0, (F.col("a_m") - F.col("b_m")) / F.sqrt(pool)).alias("t"), F.when(pool > 0, df).alias("df"))


def with_p(tests: DataFrame, kind: str) -> DataFrame:
    """Adds the two-sided p of column z (normal), h and df (chi-squared) or t and df (Student)."""
    take = {"normal": ("z",), "chi2": ("h", "df"), "student": ("t", "df")}[kind]
    tail = {"normal": special.normal_two_sided, "chi2": special.chi2_tail, "student": special.student_two_sided}[kind]

    @F.pandas_udf("double")
    def p(*columns: pd.Series) -> pd.Series:
        known = ~pd.concat(columns, axis=1).isna().any(axis=1)
        out = pd.Series(np.nan, index=columns[0].index)
        out[known] = tail(*[c[known].to_numpy(float) for c in columns])
        return out.where(known, None)

    return tests.withColumn("p", p(*[F.col(c).cast("double") for c in take]))


def population_markers(matrix: DataFrame, labels: DataFrame, alpha: float = 0.05) -> DataFrame:
    """gene, label with the highest mean, and how many of its pairs with others are significant."""
    tests = tsbh_adjust(with_p(post_hoc(matrix, labels), "student"), "p", alpha).where(F.col("q") <= alpha)
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("cells"))
    means = matrix.join(labels, "cell").groupBy("gene", "label").agg(F.sum("value").alias("s")).join(sizes, "label").groupBy("gene").agg(F.max(F.struct((F.col("s") / F.col("cells")).alias("mean"), "label"))["label"].alias("label"))
    sides = tests.select("gene", F.explode(F.array("a", "b")).alias("label")).groupBy("gene", "label").agg(F.count(F.lit(1)).alias("n_pairs"))
    return means.join(sides, ["gene", "label"], "left").fillna(0, ["n_pairs"])


def g_test(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """gene, g over row-normalised values, where expected sums follow the labels' shares of cells."""
    return scaled_differences(matrix, labels).groupBy("gene").agg((2 * F.sum("scaled")).alias("g"))


def scaled_differences(matrix: DataFrame, labels: DataFrame) -> DataFrame:
    """gene, label, scaled: observed * ln(observed / expected)."""
    total = Window.partitionBy("cell")
    share = matrix.withColumn("f", F.col("value") / F.sum("value").over(total)).join(labels, "cell")
    observed = share.groupBy("gene", "label").agg(F.sum("f").alias("o"))
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("cells")).withColumn("part", F.col("cells") / F.sum("cells").over(Window.partitionBy(F.lit(1))))
    expected = observed.withColumn("all", F.sum("o").over(Window.partitionBy("gene"))).join(sizes, "label")
    return expected.select("gene", "label", F.when(F.col("o") > 0, F.col("o") * F.log(F.col("o") / (F.col("all") * F.col("part")))).otherwise(0.0).alias("scaled"))


def enriched_labels(scaled: DataFrame) -> DataFrame:
    """gene, label, enriched: in the upper part of the best split of a gene's values in two."""
    order = Window.partitionBy("gene").orderBy("scaled", "label")
    whole = Window.partitionBy("gene")
    rows = scaled.withColumn("k", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(whole))
    rows = rows.withColumn("s", F.sum("scaled").over(order)).withColumn("all", F.sum("scaled").over(whole))
    between = F.when(F.col("k") < F.col("n"), F.col("s") * F.col("s") / F.col("k") + (F.col("all") - F.col("s")) * (F.col("all") - F.col("s")) / (F.col("n") - F.col("k")))
    cut = rows.withColumn("between", between).groupBy("gene").agg(F.max(F.struct(F.col("between"), -F.col("k")))["col2"].alias("cut"))
    return rows.join(cut, "gene").select("gene", "label", F.coalesce(F.col("k") > -F.col("cut"), F.lit(False)).alias("enriched"))


def pearson(x: DataFrame, matrix: DataFrame) -> DataFrame:
    """gene, r of x(cell, x) with each gene over all cells of x, zeros included."""
    base = x.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx")).first()
    sums = matrix.join(x, "cell").groupBy("gene").agg(F.sum("value").cast("double").alias("sy"), F.sum(F.col("value") * F.col("value")).cast("double").alias("syy"), F.sum(F.col("x") * F.col("value")).cast("double").alias("sxy"))
    n, sx, sxx = (float(base[k] or 0) for k in ("n", "sx", "sxx"))
    top = F.lit(n) * F.col("sxy") - F.lit(sx) * F.col("sy")
    low = F.lit(n * sxx - sx * sx) * (F.lit(n) * F.col("syy") - F.col("sy") * F.col("sy"))
    return sums.select("gene", F.when(low > 0, top / F.sqrt(low)).alias("r"))


def correlation_map(x: DataFrame, y: DataFrame) -> DataFrame:
    """a, b, r of each row of x(id, vector) with each row of y(id, vector); null where a row is constant.

    A task has a block of x against a block of y, one matrix product; the result has a row for each pair.
    Each side is dealt into blocks once: tasks fetch the same blocks again, and no copies of them are written.
    Of one table with itself, two blocks meet once and give their pairs both ways, a run and then the same run
    turned round, so that a compressor finds every r a second time. Its rows are dealt by what they hold: both sides have the same blocks.
    """
    own = x is y

    def dealt(rows: DataFrame) -> DataFrame:
        rows, n = rows.select("id", F.col("vector").cast("array<double>").alias("v")), max(1, -(-rows.count() // BLOCK))
        if not own:
            return rows.withColumn("block", F.lit(0)).repartition(n)
        return rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")).repartitionById(n, "block")

    def packed(rows: DataFrame, side: str) -> tuple[DataFrame, str]:
        kind = rows.schema["id"].dataType.simpleString()
        return rows.mapInArrow(_pack, f"{side}_ids array<{kind}>, {side}_wide int, {side}_units binary, {side}_block int"), kind

    first = dealt(x)
    (left, a), (right, b) = packed(first, "a"), packed(first if own else dealt(y), "b")
    met = left.crossJoin(right.hint("shuffle_replicate_nl"))
    if own:  # of (i, j) and (j, i) one, so that every block has as many partners on either side
        met = met.where("a_block = b_block or (a_block < b_block) = ((a_block + b_block) % 2 = 0)")
    return met.mapInArrow(_products, f"a {a}, b {b}, r double")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for all rows (id, v, block) of a block: ids, width, the centred vectors of length one, NaN where there is none, and the block."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    ids, vectors = (pa.chunked_array([b.column(c) for b in held]).combine_chunks() for c in range(2))
    sizes = np.nan_to_num(pc.list_value_length(vectors).to_numpy(zero_copy_only=False)).astype(int)
    wide = int(sizes.max())
    if not np.isin(sizes, (0, wide)).all():
        raise ValueError("vectors have different lengths")
    v = np.full((len(ids), wide), np.nan)
    if wide:
        v[sizes > 0] = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, wide)
        v -= v.mean(axis=1, keepdims=True)
        size = np.sqrt((v * v).sum(axis=1, keepdims=True))
        v = np.divide(v, size, out=np.full_like(v, np.nan), where=size > 1e-12)
    own = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    yield pa.RecordBatch.from_arrays([own, pa.array([wide], pa.int32()), pa.array([v.tobytes()], pa.binary()), held[0].column(2)[:1]], names=["ids", "wide", "units", "block"])


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, r of every pair of two packed blocks, some PAIRS rows at a time; of blocks with different numbers both ways."""
    for batch in batches:
        for k in range(batch.num_rows):
            (a, p), (b, q) = ((batch.column(c)[k].values, np.frombuffer(batch.column(c + 2)[k].as_buffer()).reshape(-1, max(1, batch.column(c + 1)[k].as_py()))) for c in (0, 4))
            if len(p) and len(q) and p.shape[1] != q.shape[1]:
                raise ValueError("vectors have different lengths")
            turned = batch.column(3)[k].as_py() != batch.column(7)[k].as_py()
            left, right, shift, run = (*[pa.concat_arrays([a, b])] * 2, len(a), RUN) if turned else (a, b, 0, len(b))
            for start in range(0, len(b), run):
                to = np.arange(start, min(start + run, len(b)))
                step = max(1, PAIRS // (len(to) * (1 + turned)))
                for lo in range(0, len(a), step):
                    own = np.arange(lo, min(lo + step, len(a)))
                    r = p[own] @ q[to].T if len(p) and len(q) else np.full((len(own), len(to)), np.nan)  # blocks without any vector have no units
                    i, j = np.broadcast_arrays(own[:, None], to + shift)
                    if turned:
                        i, j, r = np.stack([i, j], 1), np.stack([j, i], 1), np.stack([r, r], 1)
                    yield pa.RecordBatch.from_arrays([left.take(pa.array(i.ravel())), right.take(pa.array(j.ravel())), pa.array(r.ravel(), from_pandas=True)], names=["a", "b", "r"])


def smoothed_correlation(vectors: DataFrame, values: DataFrame, knn: int = 10) -> DataFrame:
    """component, gene, r of rolling means over cells in a component's order.

    vectors: cell, component, x; values: cell, gene, value for every pair. Component 0 is left out,
    and so are the first knn places of each order.
    """
    rows = vectors.where("component <> 0").join(values, "cell")
    order = Window.partitionBy("component", "gene").orderBy("x", "cell")
    frame = order.rowsBetween(-(knn - 1), 0)
    smooth = rows.select("component", "gene", F.row_number().over(order).alias("k"), F.avg("x").over(frame).alias("sx"), F.avg("value").over(frame).alias("sv")).where(F.col("k") > knn)
    return smooth.groupBy("component", "gene").agg(F.corr("sx", "sv").alias("r"))


def jensen_shannon(rows: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """a, b, distance (square root, base 2) of distributions in rows(key, feature, p): of the wanted pairs (a, b), or of all with a < b.

    All pairs are for clusters or samples; for cells, hand in the wanted pairs, say those of a neighbour search.
    Then only rows of wanted pairs meet. Keys without rows have no distance and are left out.
    """
    # with m = (p + q) / 2, features of one side alone add p / 2 each: 1 - (shared mass) / 2 + the shared terms
    a, b = rows.select(F.col("key").alias("a"), "feature", F.col("p").alias("pa")), rows.select(F.col("key").alias("b"), "feature", F.col("p").alias("pb"))
    m = (F.col("pa") + F.col("pb")) / 2
    own = wanted.select("a", "b").distinct() if wanted is not None else None
    met = a.join(b, "feature").where("a < b") if own is None else own.join(a, "a").join(b, ["b", "feature"])
    shared = met.where("pa > 0 and pb > 0")
    part = shared.groupBy("a", "b").agg(F.sum(0.5 * F.col("pa") * F.log2(F.col("pa") / m) + 0.5 * F.col("pb") * F.log2(F.col("pb") / m)).alias("s"), F.sum((F.col("pa") + F.col("pb")) / 2).alias("mass"))
    keys = rows.select("key").distinct()
    left, right = keys.select(F.col("key").alias("a")), keys.select(F.col("key").alias("b"))
    pairs = left.join(right, F.col("a") < F.col("b")) if own is None else own.join(left, "a", "left_semi").join(right, "b", "left_semi")
    return pairs.join(part, ["a", "b"], "left").select("a", "b", F.sqrt(F.greatest(F.lit(0.0), 1 - F.coalesce("mass", F.lit(0.0)) + F.coalesce("s", F.lit(0.0)))).alias("distance"))


def median_normalise(counts: DataFrame, value: str = "n_molecules") -> DataFrame:
    """cell, gene, value scaled so that every cell has the median library size."""
    counts = saved(counts.select("cell", "gene", value))
    sizes = saved(counts.groupBy("cell").agg(F.sum(value).alias("size")))
    middle = sizes.agg(F.percentile("size", F.lit(0.5)).alias("m")).first()["m"]
    return counts.join(sizes, "cell").select("cell", "gene", (F.col(value) / F.col("size") * F.lit(middle)).alias("value"))


def log2_transform(matrix: DataFrame, pseudo: float = 0.1) -> DataFrame:
    """log2(value + pseudo) of stored values; those of absent ones are log2(pseudo)."""
    return matrix.withColumn("value", F.log2(F.col("value") + pseudo))


def linear_scale(rows: DataFrame, value: str) -> Column:
    """Expression that maps the range of a column to -1 to 1."""
    ends = rows.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")).first()
    return (F.col(value) - F.lit(ends["lo"])) / F.nullif(F.lit(ends["hi"]) - F.lit(ends["lo"]), F.lit(0.0)) * 2 - 1


def logistic_scale(x: Column) -> Column:
    return 2 / (1 + F.exp(-x)) - 1


def enrichment_scores(ranks: DataFrame, sets: DataFrame) -> DataFrame:
    """gene_set, es, n_hits of running sums: hits weigh |score|, misses alike.

    ranks: gene, score; sets: gene_set, gene. Only the hits are ordered: between two hits the
    sum falls by the misses between, so its extremes lie just before or at a hit.
    """
    placed = ranks.withColumn("place", F.row_number().over(Window.orderBy(F.desc("score"), "gene")))
    n = placed.count()
    hits = sets.distinct().join(placed, "gene")
    order = Window.partitionBy("gene_set").orderBy("place")
    whole = Window.partitionBy("gene_set")
    rows = hits.withColumn("k", F.row_number().over(order)).withColumn("n_hits", F.count(F.lit(1)).over(whole)).withColumn("total", F.sum(F.abs("score")).over(whole))
    miss = (F.col("place") - F.col("k")) / F.nullif(F.lit(n) - F.col("n_hits"), F.lit(0))
    after = F.sum(F.abs("score")).over(order) / F.col("total") - F.coalesce(miss, F.lit(0.0))
    rows = rows.withColumn("after", after).withColumn("before", F.col("after") - F.abs("score") / F.col("total"))
    ends = rows.groupBy("gene_set").agg(F.max("after").alias("hi"), F.min("before").alias("lo"), F.max("n_hits").alias("n_hits"))
    return ends.select("gene_set", F.when(F.col("hi") >= -F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("es"), "n_hits")


def gsea(ranks: DataFrame, sets: DataFrame, permutations: int = 1000, seed: int = 1) -> DataFrame:
    """gene_set, n_hits, es, nes, p from permuted hit places; one task for each set, whose ranks are shared.

    The rank list has one row for each gene and goes to every executor.
    """
    top = ranks.orderBy(F.desc("score"), "gene").toPandas()
    if not top["score"].between(-1, 1).all():
        raise ValueError("scores lie between -1 and 1")
    shared = ranks.sparkSession.sparkContext.broadcast((dict(zip(top["gene"], range(len(top)), strict=True)), top["score"].abs().to_numpy(float)))

    def score(places: np.ndarray, weight: np.ndarray) -> float:
        places = np.sort(places)
        w = weight[places]
        after = np.cumsum(w) / w.sum() - (places - np.arange(len(places))) / max(1, len(weight) - len(places))
        before = after - w / w.sum()
        return float(after.max() if after.max() >= -before.min() else before.min())

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        place, weight = shared.value
        hits = np.array(sorted({place[g] for g in pdf["gene"] if g in place}))
        if not len(hits) or weight[hits].sum() == 0:
            return pd.DataFrame({"gene_set": [pdf["gene_set"].iloc[0]], "n_hits": [len(hits)], "es": [np.nan], "nes": [np.nan], "p": [np.nan]})
        rng, es = np.random.default_rng((seed, len(hits))), score(hits, weight)
        chance = np.array([score(rng.choice(len(weight), len(hits), replace=False), weight) for _ in range(permutations)])
        side = chance[chance >= 0] if es >= 0 else chance[chance < 0]
        p = (np.sum(np.abs(side) >= abs(es)) + 1) / (len(side) + 1)
        nes = es / np.abs(side).mean() if len(side) else np.nan
        return pd.DataFrame({"gene_set": [pdf["gene_set"].iloc[0]], "n_hits": [len(hits)], "es": [es], "nes": [nes], "p": [float(p)]})

    return sets.select("gene_set", "gene").distinct().groupBy("gene_set").applyInPandas(each, "gene_set string, n_hits long, es double, nes double, p double")


def sampled_size(matrix: DataFrame, labels: DataFrame, percentile: float = 0.1) -> tuple[float, int]:
    """(smallest of the labels' percentiles of library size, smallest number of cells of a label)."""
    sizes = matrix.groupBy("cell").agg(F.sum("value").alias("s")).join(labels, "cell").groupBy("label").agg(F.percentile("s", F.lit(percentile)).alias("v"), F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.min("v").alias("v"), F.min("n").alias("n")).first()
    return float(row["v"]), int(row["n"])


def resampled(matrix: DataFrame, labels: DataFrame, n_iter: int, percentile: float = 0.1, upsample: bool = False, seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(iter, cell, gene, value; iter, cell, label): bootstraps of equal numbers of cells of equal size.

    Cells under the common size are left out unless upsample. A cell drawn several times counts as
    several cells; values are scaled and rounded up with the probability of their fraction. All
    draws are hashes of (seed, iteration, draw), so reruns agree.
    """
    value, _ = sampled_size(matrix, labels, percentile)
    sizes = matrix.groupBy("cell").agg(F.sum("value").alias("s")).join(labels, "cell").where(F.lit(upsample) | (F.col("s") >= value))
    placed = sizes.withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy("cell"))).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("label")))
    least = placed.agg(F.min("n")).first()[0] or 0
    unit = lambda *c: F.pmod(F.xxhash64(*c, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    draws = sizes.select("label").distinct().withColumn("iter", F.explode(F.sequence(F.lit(0), F.lit(n_iter - 1)))).withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(max(1, least)))))
    counts = placed.groupBy("label").agg(F.max("n").alias("n"))
    picked = draws.join(counts, "label").withColumn("place", (F.floor(unit("iter", "draw", "label") * F.col("n")) + 1).cast("int")).drop("n").join(placed.select("label", "place", F.col("cell").alias("source"), "s"), ["label", "place"])
    cell = F.concat_ws("/", F.col("label").cast("string"), F.col("draw").cast("string"))
    x = F.col("value") * (F.lit(value) / F.col("s"))
    rows = picked.join(matrix.withColumnRenamed("cell", "source"), "source").select("iter", cell.alias("cell"), "gene", (F.floor(x) + (unit("iter", "draw", "label", "gene") < x - F.floor(x)).cast("long")).alias("value"))
    return rows.where("value > 0"), picked.select("iter", cell.alias("cell"), "label")




def resampled_tests(matrix: DataFrame, labels: DataFrame, n_iter: int = 50, alpha: float = 0.05, seed: int = 1, percentile: float = 0.1, upsample: bool = False) -> DataFrame:
    """gene, statistic, lo, hi, p, q: medians over bootstraps of Mann-Whitney (two labels) or Kruskal-Wallis tests.

    lo and hi are the 2.5 and 97.5 percentiles of the statistic.
    """
    drawn, own = resampled(matrix, labels, n_iter, percentile, upsample, seed)
    names = [r["label"] for r in labels.select("label").distinct().orderBy("label").collect()]
    # the iteration is part of the gene, so that one plan tests all of them
    m, lab = drawn.select(F.struct("iter", "gene").alias("gene"), "cell", "value"), own.select("cell", "label").distinct()
    if len(names) == 2:
        tests = with_p(mann_whitney(m, lab, *names), "normal").withColumnRenamed("z", "x")
    else:
        tests = with_p(kruskal(m, lab), "chi2").withColumnRenamed("h", "x")
    every = tests.select(F.col("gene.gene").alias("gene"), "x", "p")
    mid = every.groupBy("gene").agg(F.percentile("x", F.lit(0.5)).alias("statistic"), F.percentile("x", F.lit(0.025)).alias("lo"), F.percentile("x", F.lit(0.975)).alias("hi"), F.percentile("p", F.lit(0.5)).alias("p"))
    return tsbh_adjust(mid.fillna({"statistic": 0.0, "p": 1.0}), "p", alpha)


def bootstrap_t(matrix: DataFrame, labels: DataFrame, first, second, n_samples: int = 100, n_cells: int | None = None, alpha: float = 0.05, seed: int = 1, size: float = 0.5) -> DataFrame:
    """gene, t, t_low, t_high, p, q of Welch's test between bootstrap draws of two labels' cells.

    t is the median of |t| over the draws, t_low and t_high its 2.5 and 97.5 percentiles; a draw
    without variance has 0. Degrees of freedom come from the variances' means over the draws. size is
    the percentile of library sizes that gives the common one (the smaller label's); larger cells are
    scaled down to it, smaller ones up. n_cells stands for the numbers of drawn cells in the test.
    """
    names = (first, second)
    drawn, own = resampled(non_negative(matrix), labels.where(F.col("label").isin(first, second)), n_samples, size, True, seed)
    drawn, own = saved(drawn), saved(own)
    sizes = {r["label"]: r["n"] for r in own.where("iter = 0").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = [float(n_cells or sizes.get(k, 0)) for k in names]
    sums = drawn.join(own, ["iter", "cell"]).groupBy("gene", "iter", "label").agg(F.sum("value").cast("double").alias("s"), F.sum(F.col("value") * F.col("value")).cast("double").alias("q"))
    pick = lambda label, c: F.coalesce(F.max(F.when(F.col("label") == F.lit(label), F.col(c))), F.lit(0.0))
    seen = sums.groupBy("gene", "iter").agg(*[pick(k, c).alias(f"{c}{i}") for i, k in enumerate(names) for c in ("s", "q")])
    every = seen.select("gene").distinct().withColumn("iter", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))
    draws = every.join(seen, ["gene", "iter"], "left").fillna(0.0)

    def moments(i: int) -> tuple[Column, Column]:
        n = float(sizes.get(names[i], 0)) or 1.0
        mean = F.col(f"s{i}") / n
        return mean, F.greatest((F.col(f"q{i}") / n - mean * mean) * (n / max(n - 1, 1.0)), F.lit(0.0)) / max(cells[i], 1.0)

    (m0, v0), (m1, v1) = moments(0), moments(1)
    each = draws.select("gene", F.when(v0 + v1 > 0, F.abs(m0 - m1) / F.sqrt(v0 + v1)).otherwise(0.0).alias("t"), v0.alias("v0"), v1.alias("v1"))
    at = lambda p: F.percentile("t", F.lit(p))
    mid = each.groupBy("gene").agg(at(0.5).alias("t"), at(0.025).alias("t_low"), at(0.975).alias("t_high"), F.avg("v0").alias("v0"), F.avg("v1").alias("v1"))
    v0, v1 = F.col("v0"), F.col("v1")
    df = (v0 + v1) * (v0 + v1) / (v0 * v0 / max(cells[0] - 1, 1.0) + v1 * v1 / max(cells[1] - 1, 1.0))
    tests = with_p(mid.select("gene", "t", "t_low", "t_high", F.when(v0 + v1 > 0, df).alias("df")), "student")
    return tsbh_adjust(tests.fillna({"p": 1.0}), "p", alpha)


def hurdle_tests(matrix: DataFrame, labels: DataFrame, least_fold: float = 1.25, alpha: float = 0.05) -> DataFrame:
    """cluster, gene, p, logfc, q of each cluster against the rest, for q <= alpha and a fold change of at least least_fold.

    A gene's detection is a logistic and its log2(x + 1) where detected a linear model of the cluster
    and the cells' scaled number of genes; p is of both models' likelihood ratios together. Each task
    has one gene's nonzero values; the cells' clusters and covariates go to every executor.
    """
    from .testing import bh_adjust

    cells = labels.join(matrix.where("value > 0").groupBy("cell").agg(F.count(F.lit(1)).alias("genes")), "cell", "left").fillna(0, ["genes"]).toPandas().sort_values("cell")
    detected = cells["genes"].to_numpy(float)
    scaled = (detected - detected.mean()) / (detected.std(ddof=1) or 1.0) if len(detected) > 1 else detected
    shared = matrix.sparkSession.sparkContext.broadcast((cells["cell"].to_numpy(), cells["label"].to_numpy(), scaled))

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, label, cov = shared.value
        y = np.zeros(len(ids))
        at = np.searchsorted(ids, pdf["cell"].to_numpy())
        y[at] = np.log2(pdf["value"].to_numpy(float) + 1)
        out = []
        for cluster in np.unique(label):
            x = np.column_stack([np.ones(len(ids)), cov, (label == cluster).astype(float)])
            seen = y > 0
            ratio = 2 * (_logistic(x, seen) - _logistic(x[:, :2], seen))
            df, fold = 1, 0.0
            if seen.sum() > 4 and 0 < x[seen, 2].sum() < seen.sum():
                ratio, df = ratio + seen.sum() * np.log(max(_residual(x[seen, :2], y[seen]), 1e-12) / max(_residual(x[seen], y[seen]), 1e-12)), 2
            inside = label == cluster
            fold = float(y[inside].mean() - y[~inside].mean()) if 0 < inside.sum() < len(ids) else 0.0
            out.append((str(cluster), pdf["gene"].iloc[0], float(special.chi2_tail(max(ratio, 0.0), df)), fold))
        return pd.DataFrame(out, columns=["cluster", "gene", "p", "logfc"])

    kind = matrix.schema["gene"].dataType.simpleString()
    tests = matrix.where("value > 0").groupBy("gene").applyInPandas(each, f"cluster string, gene {kind}, p double, logfc double")
    return bh_adjust(tests, "p", ["cluster"]).where((F.col("q") <= alpha) & (F.abs("logfc") >= float(np.log2(least_fold))))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> float:
    """Log-likelihood of a logistic model by Newton steps with a small ridge."""
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(len(b)), x.T @ (y - p) - 1e-6 * b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    z = np.clip(x @ b, -30, 30)
    return float((y * z - np.log1p(np.exp(z))).sum())


def _residual(x: np.ndarray, y: np.ndarray) -> float:
    return float(((y - x @ np.linalg.lstsq(x, y, rcond=None)[0]) ** 2).sum())
