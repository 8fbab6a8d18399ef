"""Molecular tag (RMT) error correction within each cell and gene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.checkpoints import saved
from cellweave.functions import dna
from cellweave.functions import status as S

from .reads import active, log_factorial

#: Segments of a tag: with two errors, one of three has none.
SEGMENTS = 3


def tag_groups(reads: DataFrame) -> DataFrame:
    """Active reads by cell, gene and tag: n and the set of positions."""
    return active(reads).groupBy("cell", "gene", "rmt").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("position")).alias("positions"))


def close_tags(groups: DataFrame) -> DataFrame:
    """Ordered pairs (target, donor) of different tags of a cell and gene within two errors.

    Two such tags agree in one of three segments, so a group's tags meet by segment and not all with all.
    A pair is made by the first segment it shares. All conditions are arithmetic on packed values.
    """
    wide = F.ceil(F.col("bases") / F.lit(SEGMENTS)).cast("int") * 3
    cut = F.call_function("shiftleft", F.lit(1).cast("long"), wide) - 1
    keyed = groups.withColumn("bases", dna.seq_len(F.col("rmt")))
    for i in range(SEGMENTS):
        keyed = keyed.withColumn(f"s{i}", F.call_function("shiftright", F.col("rmt"), wide * i).bitwiseAND(cut))
    keyed = keyed.withColumn("part", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"s{i}").alias("s")) for i in range(SEGMENTS)]))).select("*", F.col("part.i").alias("i"), F.col("part.s").alias("s")).drop("part")
    donor = keyed.select("cell", "gene", "bases", "i", "s", F.col("rmt").alias("donor"), F.col("n").alias("donor_n"), F.col("positions").alias("donor_positions"), F.col("s0").alias("d0"), F.col("s1").alias("d1"))
    x = F.col("rmt").bitwiseXOR(F.col("donor"))
    distance = F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseOR(F.shiftright(x, 2)).bitwiseAND(F.lit(dna.LOW_BITS))).cast("int")
    first = (F.col("i") == 0) | ((F.col("s0") != F.col("d0")) & ((F.col("i") == 1) | (F.col("s1") != F.col("d1"))))
    pairs = keyed.join(donor, ["cell", "gene", "bases", "i", "s"]).where((F.col("rmt") != F.col("donor")) & first)
    return pairs.withColumn("distance", distance).where("distance <= 2").select("cell", "gene", "rmt", "n", "positions", "donor", "donor_n", "donor_positions", "distance")


def poisson_tail(n: Column, mean: Column) -> Column:
    """P(X >= n) for a Poisson mean, the regularised lower incomplete gamma function of integer n."""
    below = F.aggregate(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), F.lit(0.0), lambda a, k: a + F.exp(k * F.log(mean) - mean - log_factorial(k)))
    return F.when(mean <= 0, 0.0).otherwise(F.greatest(F.lit(1.0) - below, F.lit(0.0)))


def tag_errors(reads: DataFrame, rate: float = 0.02, alpha: float = 0.05, rates: Column | None = None) -> DataFrame:
    """cell, gene, rmt, n, expected, p, donor, is_error for tags with close donors.

    expected is the number of reads that donors' errors give. A tag is an error where some donor
    has all its positions and p exceeds alpha; the named donor is the one with most reads, then
    the smallest.
    """
    chance = F.pow(F.lit(rate), F.col("distance")) if rates is None else dna.conversion_probability_table(F.col("donor"), F.col("rmt"), rates)
    pairs = close_tags(saved(tag_groups(reads))).withColumn("chance", chance).withColumn("covers", F.size(F.array_except("positions", "donor_positions")) == 0)
    best = F.max(F.when(F.col("covers"), F.struct(F.col("donor_n"), (-F.col("donor")).alias("low"))))
    sums = pairs.groupBy("cell", "gene", "rmt").agg(F.first("n").alias("n"), F.sum(F.col("donor_n") * F.col("chance")).alias("expected"), best.alias("best"))
    tail = sums.withColumn("p", poisson_tail(F.col("n"), F.col("expected")))
    return tail.select("cell", "gene", "rmt", "n", "expected", "p", (-F.col("best.low")).alias("donor"), (F.col("best").isNotNull() & (F.col("p") > alpha)).alias("is_error"))


def flag_tag_errors(reads: DataFrame, rate: float = 0.02, alpha: float = 0.05, rates: DataFrame | None = None) -> DataFrame:
    """Reads of wrong tags get rmt_error and the donor's tag. rates(from_b, to_b, rate), of 20 rows, go before rate."""
    table = None
    if rates is not None:
        table = F.create_map(*[F.lit(v) for r in rates.collect() for v in (r["from_b"] * 10 + r["to_b"], float(r["rate"]))])
    bad = tag_errors(reads, rate, alpha, table).where("is_error").select("cell", "gene", "rmt", F.col("donor").alias("__donor"))
    joined = reads.join(bad, ["cell", "gene", "rmt"], "left").withColumn("__wrong", F.col("__donor").isNotNull() & (F.col("status") == 0))
    return joined.withColumn("status", S.with_flag(F.col("status"), "rmt_error", F.col("__wrong"))).withColumn("rmt", F.when(F.col("__wrong"), F.col("__donor")).otherwise(F.col("rmt"))).select(*reads.columns)
