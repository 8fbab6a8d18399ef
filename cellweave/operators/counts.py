"""Count matrix in long form, its coordinates and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .reads import active


def count_matrix(reads: DataFrame, *ignore: str) -> DataFrame:
    """Reads and distinct tags of active reads by cell and gene.

    Counts by (cell, gene, tag) first, so that a hot cell or gene is combined before its exchange.
    """
    tags = active(reads, *ignore).groupBy("cell", "gene", "rmt").agg(F.count(F.lit(1)).alias("n"))
    return tags.groupBy("cell", "gene").agg(F.sum("n").alias("n_reads"), F.count(F.lit(1)).alias("n_molecules"))


def coordinates(counts: DataFrame, value: str = "n_molecules") -> DataFrame:
    """1-based row, col and value, cells and genes in ascending order.

    Ids come from the distinct axes, which are far smaller than the matrix.
    """
    axis = lambda key, name: counts.select(key).distinct().withColumn(name, F.row_number().over(Window.orderBy(key)))
    return counts.join(axis("cell", "row"), "cell").join(axis("gene", "col"), "gene").select(F.col("row").cast("long"), F.col("col").cast("long"), F.col(value).alias("value"))


def axis_index(counts: DataFrame, key: str) -> DataFrame:
    """0-based index of each value of an axis."""
    return counts.select(key).distinct().withColumn("idx", (F.row_number().over(Window.orderBy(key)) - 1).cast("long")).select("idx", key)


def axis_sums(counts: DataFrame, key: str, value: str = "n_molecules") -> DataFrame:
    return counts.groupBy(key).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("nonzero"))


def with_symbols(counts: DataFrame, symbols: DataFrame) -> DataFrame:
    """Genes by symbol; genes without one get an empty symbol."""
    return counts.join(symbols.select("gene", "symbol"), "gene", "left").withColumn("symbol", F.coalesce("symbol", F.lit("")))


def merge_samples(*samples: DataFrame) -> DataFrame:
    """Long matrices of several samples under sample numbers from 0; missing columns are 0."""
    out = None
    for i, s in enumerate(samples):
        s = s.withColumn("sample_number", F.lit(i))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    numeric = [f.name for f in out.schema if f.dataType.typeName() in ("long", "integer", "double")]
    return out.fillna(0, subset=numeric)


def dense(counts: DataFrame, genes: list, value: str = "n_molecules", labels: DataFrame | None = None) -> DataFrame:
    """One row for each cell and one column for each gene, 0 where there is no count; labels(cell, cluster) come first."""
    wide = counts.groupBy("cell").pivot("gene", genes).agg(F.sum(value)).fillna(0)
    return wide if labels is None else labels.join(wide, "cell").select("cluster", "cell", *[str(g) for g in genes])


def composition(rows: DataFrame) -> DataFrame:
    """sample, cluster, n, share: rows of each sample in each cluster and their share of the sample, to two places."""
    n = rows.groupBy("sample", "cluster").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("sample")), 2))
