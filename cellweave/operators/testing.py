"""Multiple testing and rank statistics as window expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.checkpoints import saved


def bh_adjust(tests: DataFrame, p: str = "p", by: list[str] | None = None) -> DataFrame:
    """Adds q, Benjamini-Hochberg adjusted p values, over all rows or within groups.

    Distinct p values are dealt to ranges and numbered inside each; one row a range and group
    gives the numbers before it and the least value after it, so that no task has a whole group.
    Tests whose p is null or NaN aren't counted and have a null q.
    """
    tests = saved(tests)
    key, value = _group(by), F.col(p).cast("double")
    seen = tests.where(value.isNotNull() & ~F.isnan(value)).groupBy(key.alias("__key"), value.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    laid = saved(seen.repartitionByRange("__key", "__p").withColumn("__part", F.spark_partition_id()))
    place, inside = ["__part", "__key"], Window.partitionBy("__part", "__key")
    totals = laid.groupBy(*place).agg(F.sum("__n").alias("__here"))
    upward, whole = Window.partitionBy("__key").orderBy("__part"), Window.partitionBy("__key")
    totals = totals.select(*place, (F.sum("__here").over(upward) - F.col("__here")).alias("__before"), F.sum("__here").over(whole).alias("__m"))
    upto = laid.withColumn("__upto", F.sum("__n").over(inside.orderBy("__p")))
    raw = upto.join(totals, place).select(*place, "__p", (F.col("__p") * F.col("__m") / (F.col("__before") + F.col("__upto"))).alias("__raw"))
    after = Window.partitionBy("__key").orderBy(F.desc("__part")).rowsBetween(Window.unboundedPreceding, -1)
    least = raw.groupBy(*place).agg(F.min("__raw").alias("__least")).select(*place, F.min("__least").over(after).alias("__later"))
    here = raw.withColumn("__here", F.min("__raw").over(inside.orderBy(F.desc("__p"))))
    found = here.join(least, place).select("__key", "__p", F.least("__here", "__later", F.lit(1.0)).alias("q"))
    return tests.drop("q").withColumn("__key", key).withColumn("__p", value).join(found, ["__key", "__p"], "left").drop("__key", "__p")


def tsbh_adjust(tests: DataFrame, p: str = "p", alpha: float = 0.05, by: list[str] | None = None) -> DataFrame:
    """Adds q by the two-stage procedure: the first stage at alpha / (1 + alpha) estimates the number of true nulls."""
    first = saved(bh_adjust(tests, p, by).withColumn("__key", _group(by)))
    m, rejected = F.count("q"), F.count_if(F.col("q") <= alpha / (1 + alpha))
    nulls = F.when((rejected == 0) | (rejected == m), m).otherwise(m - rejected)
    shares = first.groupBy("__key").agg((nulls / F.nullif(m, F.lit(0))).alias("__share"))
    adjusted = F.when(F.col("q").isNotNull(), F.least(F.col("q") * F.col("__share") * (1 + alpha), F.lit(1.0)))
    return first.join(shares, "__key").withColumn("q", adjusted).drop("__key", "__share")


def _group(by: list[str] | None) -> Column:
    """The columns of a group as one value, in which nulls are equal."""
    return F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))


def average_rank(by: list[str], value: str) -> Column:
    """Rank of value within groups, ties at their mean rank."""
    return F.rank().over(Window.partitionBy(*by).orderBy(value)) + (F.count(F.lit(1)).over(Window.partitionBy(*by, value)) - 1) / F.lit(2.0)


def value_ranks(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Distinct values of each group with their number n and average rank: ties are combined before any ordering."""
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*by).orderBy(value)) - F.col("n")
    return counts.withColumn("rank", before + (F.col("n") + 1) / 2.0)
