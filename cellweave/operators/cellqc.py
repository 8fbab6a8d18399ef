"""Cell filters and summaries over the per-cell table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.checkpoints import saved


class EmptyMatrixError(ValueError):
    """A count matrix without rows."""


def cell_sizes(counts: DataFrame, mt: Column | None = None) -> DataFrame:
    """cell, n_reads, n_molecules, n_genes and mt_fraction (share of molecules of genes for which mt holds)."""
    mt = F.lit(False) if mt is None else mt
    return counts.groupBy("cell").agg(
        F.sum("n_reads").alias("n_reads"), F.sum("n_molecules").alias("n_molecules"), F.count(F.lit(1)).alias("n_genes"),
        (F.sum(F.when(mt, F.col("n_molecules")).otherwise(0)) / F.sum("n_molecules")).alias("mt_fraction"),
    )


def size_quantiles(sizes: DataFrame, value: str = "n_molecules") -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles, maximum of a column."""
    v = F.col(value)
    return sizes.agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).cast("double").alias("min"),
        F.percentile(v, F.lit(0.25)).alias("q25"), F.percentile(v, F.lit(0.5)).alias("q50"), F.percentile(v, F.lit(0.75)).alias("q75"), F.max(v).cast("double").alias("max"),
    )


def saturation(counts: DataFrame) -> DataFrame:
    """Reads in a molecule, reads in a cell, and saturation (r - 1) * 100 / r."""
    one = counts.agg(F.sum("n_reads").alias("reads"), F.sum("n_molecules").alias("molecules"), F.countDistinct("cell").alias("cells"))
    r = F.col("reads") / F.col("molecules")
    return one.select(r.alias("reads_per_molecule"), (F.col("reads") / F.col("cells")).alias("reads_per_cell"), ((r - 1) * 100 / r).alias("saturation"))


def size_histogram(sizes: DataFrame, value: str = "n_molecules") -> DataFrame:
    """Number of cells of each size: what cutoffs over sorted sizes need, without a row for each cell."""
    return sizes.groupBy(F.col(value).alias("size")).agg(F.count(F.lit(1)).alias("n"))


def low_count_cutoff(sizes: DataFrame, value: str = "n_molecules", window: int = 10) -> float | None:
    """Size under which cells are dropped: where the smoothed second difference of the cumulative share vanishes first.

    The histogram of sizes goes to the driver; its length is bounded by the distinct sizes. None where there is no such place.
    """
    rows = sorted(((r["size"], r["n"]) for r in size_histogram(sizes, value).collect()), reverse=True)
    x = np.repeat(np.array([s for s, _ in rows], float), [n for _, n in rows]) if rows else np.zeros(0)
    if len(x) < 2 * window + 2 or x.sum() == 0:
        return None

    def smooth_difference(v: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(v)])
        mean = np.full(len(v), np.nan)
        mean[window - 1 :] = (sums[window:] - sums[:-window]) / window
        return np.diff(mean[window:])

    second = smooth_difference(smooth_difference(np.cumsum(x) / x.sum()))
    flat = np.flatnonzero(np.abs(second) <= 1e-15)
    return float(x[int(flat[0] * 0.9)]) if len(flat) else None


def mixture_bic(ratios: DataFrame, value: str, k: int, seed: int = 1) -> tuple[float, list[float], DataFrame]:
    """(BIC, means, rows with column component) of a one-dimensional Gaussian mixture."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import array_to_vector

    if k == 1:
        row = ratios.agg(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v")).first()
        n, v = row["n"], max(row["v"] or 0.0, 1e-12)
        return 2 * float(np.log(n)) + n * float(np.log(2 * np.pi * v) + 1), [row["m"]], ratios.withColumn("component", F.lit(0))
    rows = ratios.withColumn("__v", array_to_vector(F.array(F.col(value).cast("double"))))
    model = GaussianMixture(featuresCol="__v", predictionCol="component", probabilityCol="__p", k=k, tol=1e-6, maxIter=200, seed=seed).fit(rows)
    free = 3 * k - 1
    means = [float(r["mean"][0]) for r in model.gaussiansDF.collect()]
    return free * float(np.log(rows.count())) - 2 * model.summary.logLikelihood, means, model.transform(rows).drop("__v", "__p")


def low_coverage(sizes: DataFrame, ratio: float = 0.95, least: int = 10) -> DataFrame:
    """sizes with low_coverage: in the component with the smaller mean number of molecules, where two fit clearly better than one."""
    if sizes.limit(least).count() < least:
        return sizes.withColumn("low_coverage", F.lit(False))
    rows = sizes.withColumn("__ratio", F.col("n_reads") / F.col("n_molecules"))
    one, _, _ = mixture_bic(rows, "__ratio", 1)
    two, _, placed = mixture_bic(rows, "__ratio", 2)
    if not two / one < ratio:
        return sizes.withColumn("low_coverage", F.lit(False))
    means = {r["component"]: r["m"] for r in placed.groupBy("component").agg(F.avg("n_molecules").alias("m")).collect()}
    return placed.withColumn("low_coverage", F.lit(len(means) > 1) & (F.col("component") == min(means, key=means.get))).drop("component", "__ratio")


def high_mitochondrial(sizes: DataFrame, most: float = 0.2) -> DataFrame:
    if not 0 <= most <= 1:
        raise ValueError("the share of mitochondrial molecules is between 0 and 1")
    return sizes.withColumn("high_mt", F.col("mt_fraction") > most)


def low_gene_abundance(sizes: DataFrame, most: float = 0.15) -> DataFrame:
    """sizes with low_genes: log10 genes more than ``most`` below the line fitted on log10 molecules."""
    x, y = F.log10("n_molecules"), F.log10("n_genes")
    line = sizes.agg(F.regr_slope(y, x).alias("__slope"), F.regr_intercept(y, x).alias("__intercept"))
    return sizes.crossJoin(F.broadcast(line)).withColumn("residual", F.col("__slope") * x + F.col("__intercept") - y).withColumn("low_genes", F.coalesce(F.col("residual") > most, F.lit(False))).drop("__slope", "__intercept")


def filter_cells(counts: DataFrame, mt: Column | None = None, most_mt: float = 0.2, coverage: bool = True, low_count: bool = True) -> tuple[DataFrame, DataFrame]:
    """(counts of the cells that stay, cell table with failed_filter): the filters in sequence, each over what is left."""
    sizes = saved(cell_sizes(counts, mt))
    if not sizes.take(1):
        raise EmptyMatrixError("no cells")
    sizes = sizes.withColumn("failed_filter", F.lit(None).cast("string"))
    left = lambda: sizes.where("failed_filter is null")
    fail = lambda name, bad: sizes.join(bad.select("cell", F.lit(True).alias("__bad")), "cell", "left").withColumn("failed_filter", F.when(F.col("__bad"), name).otherwise(F.col("failed_filter"))).drop("__bad")
    if low_count and (cut := low_count_cutoff(sizes)) is not None:
        sizes = sizes.withColumn("failed_filter", F.when(F.col("n_molecules") < cut, "low_count"))
    if coverage:
        sizes = fail("low_coverage", low_coverage(left()).where("low_coverage"))
    sizes = sizes.withColumn("failed_filter", F.when(F.col("failed_filter").isNull() & (F.col("mt_fraction") > most_mt), "high_mt").otherwise(F.col("failed_filter")))
    sizes = fail("low_gene_abundance", low_gene_abundance(left()).where("low_genes"))
    return counts.join(left().select("cell"), "cell", "left_semi"), sizes


def filter_losses(sizes: DataFrame) -> DataFrame:
    """Cells and molecules that each filter took."""
    return sizes.where("failed_filter is not null").groupBy("failed_filter").agg(F.count(F.lit(1)).alias("cells"), F.sum("n_molecules").alias("molecules"))


def library_threshold(counts: DataFrame, least_log10: float = 3.75) -> DataFrame:
    """Counts of cells whose log10 library size exceeds the threshold; genes without counts have no rows."""
    big = counts.groupBy("cell").agg(F.sum("n_molecules").alias("s")).where(F.log10("s") > least_log10)
    return counts.join(big.select("cell"), "cell", "left_semi")


def detected_genes(counts: DataFrame, least: Column | int) -> DataFrame:
    """gene, n_cells of genes seen in at least so many cells."""
    least = F.lit(least) if isinstance(least, int) else least
    return counts.where("n_molecules > 0").groupBy("gene").agg(F.count(F.lit(1)).alias("n_cells")).where(F.col("n_cells") >= least)


def common_genes(counts: DataFrame) -> DataFrame:
    """Genes seen in at least min(30, a fifth of the cells, rounded down)."""
    cells = counts.select("cell").distinct().count()
    return detected_genes(counts, min(30, int(0.2 * cells)))


def run_warnings(summary: DataFrame) -> DataFrame:
    """Warnings of a run from mt_percent, pc1_percent and saturation."""
    return summary.select("*", (F.col("mt_percent") >= 30).alias("warn_cell_death"), (F.col("pc1_percent") <= 5).alias("warn_library_size"), (F.col("saturation") <= 5).alias("warn_saturation"))


def size_bins(sizes: DataFrame, value: str = "n_molecules", bins: int = 25) -> DataFrame:
    """Histogram of log10 sizes in equal bins: bin, n."""
    x = F.log10(value)
    ends = sizes.agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    at = F.least(F.floor((x - F.col("__lo")) / F.nullif(F.col("__hi") - F.col("__lo"), F.lit(0.0)) * bins), F.lit(bins - 1))
    return sizes.crossJoin(F.broadcast(ends)).groupBy(F.coalesce(at, F.lit(0)).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def cumulative_sizes(sizes: DataFrame, value: str = "n_molecules") -> DataFrame:
    """Distinct sizes in descending order with the share of molecules in cells of at least that size.

    The histogram is ordered, not the cells, so the single ordered pass has a row for each distinct size.
    """
    rows = size_histogram(sizes, value)
    down = Window.orderBy(F.desc("size"))
    total = F.sum(F.col("size") * F.col("n")).over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.withColumn("share", F.sum(F.col("size") * F.col("n")).over(down) / total)


#: Kinds of rejected reads in a yield summary.
REJECTED = ("genomic", "phix", "no_cell", "rmt_n", "cell_n", "poly_t", "dust", "wrong_cell")


def yield_summary(totals: DataFrame) -> DataFrame:
    """Percentages of a run, to one decimal: aligned reads, their origin, and each kind of rejected read.

    totals: n_input, n_aligned and the kinds in REJECTED (wrong_cell may be null, as some platforms
    don't have it). Rows whose input or alignments are unknown, as in runs started later, drop out.
    """
    known = totals.where("n_input > 0 and n_aligned > 0").withColumn("wrong_cell", F.coalesce("wrong_cell", F.lit(0)))
    bad = sum((F.col(k) for k in REJECTED[1:]), F.col(REJECTED[0]))
    rows = known.withColumn("n_rejected", bad).withColumn("n_good", F.col("n_aligned") - F.col("n_rejected")).withColumn("n_transcriptomic", F.col("n_aligned") - F.col("genomic") - F.col("phix"))
    share = lambda part, whole: F.bround(F.col(part) / F.nullif(F.col(whole), F.lit(0)) * 100, 1)
    return rows.select(
        "*", share("n_aligned", "n_input").alias("pct_aligned"), F.bround(100 - share("n_aligned", "n_input"), 1).alias("pct_unaligned"),
        share("genomic", "n_aligned").alias("pct_genomic"), share("phix", "n_aligned").alias("pct_phix"), share("n_transcriptomic", "n_aligned").alias("pct_transcriptomic"),
        share("n_rejected", "n_input").alias("pct_rejected"), share("n_good", "n_input").alias("pct_good"), *[share(k, "n_rejected").alias(f"pct_bad_{k}") for k in REJECTED],
    )


def density_grid(points: DataFrame, bins: int = 50) -> DataFrame:
    """Cells of a grid over x and y with the number of points and its arcsinh, for density plots."""
    ends = points.agg(*[f(c).alias(f"__{c}_{n}") for c in ("x", "y") for n, f in (("lo", F.min), ("hi", F.max))])
    at = lambda c: F.coalesce(F.least(F.floor((F.col(c) - F.col(f"__{c}_lo")) / F.nullif(F.col(f"__{c}_hi") - F.col(f"__{c}_lo"), F.lit(0.0)) * bins), F.lit(bins - 1)), F.lit(0)).cast("long")
    return points.crossJoin(F.broadcast(ends)).groupBy(at("x").alias("x_bin"), at("y").alias("y_bin")).agg(F.count(F.lit(1)).alias("n")).withColumn("density", F.asinh(F.col("n").cast("double")))
