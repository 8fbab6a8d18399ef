"""Read table: initial status, active reads, multi-mapped molecules, lonely triplets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.checkpoints import saved
from cellweave.functions import status as S


def n_poly_t(tail: Column) -> Column:
    """T and N symbols of a poly-T tail."""
    return F.length(tail) - F.length(F.translate(tail, "TN", ""))


def initial_status(reads: DataFrame, required_poly_t: int = 1) -> DataFrame:
    """Sets no_gene, gene_not_unique, primer_missing and low_polyt; each test is on its own.

    A read of several alignments is not unique even where they name the same gene.
    """
    n = F.coalesce(F.size(F.filter("alignments", lambda a: a["gene"].isNotNull() & (a["gene"] != 0))), F.lit(0))
    flags = [
        ("no_gene", n == 0),
        ("gene_not_unique", n > 1),
        ("primer_missing", (F.coalesce("rmt", F.lit(0)) == 0) | (F.coalesce("cell", F.lit(0)) == 0)),
        ("low_polyt", F.coalesce("n_poly_t", F.lit(0)) < required_poly_t),
    ]
    value = F.lit(0)
    for name, when in flags:
        value = value.bitwiseOR(F.when(when, S.FLAGS[name]).otherwise(0))
    return reads.withColumn("status", value)


def first_alignment(reads: DataFrame) -> DataFrame:
    """gene and position of the first alignment, 0 where there is none."""
    first = F.get("alignments", F.lit(0))
    return reads.withColumn("gene", F.coalesce(first["gene"], F.lit(0))).withColumn("position", F.coalesce(first["position"], F.lit(0)))


def active(reads: DataFrame, *ignore: str) -> DataFrame:
    return reads.where(S.passes(F.col("status"), *ignore))


def status_counts(reads: DataFrame) -> DataFrame:
    """Reads and percentage for each failure."""
    total = F.count(F.lit(1))
    one = reads.agg(total.alias("total"), *[F.sum(S.flagged(F.col("status"), n).cast("long")).alias(n) for n in S.FLAGS])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("failure"), F.coalesce(F.col(n), F.lit(0)).alias("n_reads")) for n in S.FLAGS]))
    return one.select("total", rows.alias("r")).select("r.failure", "r.n_reads", F.round(F.col("r.n_reads") * 100.0 / F.greatest("total", F.lit(1)), 6).alias("percent"))


def _molecule_sets(reads: DataFrame) -> DataFrame:
    """Distinct sorted gene sets of each molecule: cell, rmt, genes, set_id."""
    usable = active(reads, "gene_not_unique").withColumn("genes", F.array_sort(F.array_distinct(F.transform("alignments", lambda a: a["gene"]))))
    return usable.groupBy("cell", "rmt", "genes").agg(F.count(F.lit(1)).alias("n_reads"))


def _overlap_components(sets: DataFrame) -> DataFrame:
    """A component for each set of a molecule: sets joined by shared genes, by smallest-label rounds inside the row.

    Sets of one molecule are few, so all rounds are one expression over an array and need no further shuffle.
    """
    grouped = sets.groupBy("cell", "rmt").agg(F.array_sort(F.collect_list("genes")).alias("sets"))
    label = F.sequence(F.lit(0), F.size("sets") - 1)

    def step(now: Column, _: Column) -> Column:
        return F.transform(now, lambda _v, i: F.array_min(F.transform(F.filter(F.arrays_zip(F.col("sets").alias("s"), now.alias("l")), lambda z: F.arrays_overlap(z["s"], F.get("sets", i))), lambda z: z["l"])))

    return grouped.withColumn("label", F.aggregate(F.sequence(F.lit(1), F.size("sets")), label, step))


def resolve_multimapping(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reads with gene, position and status resolved, counters outcome and n).

    Molecules are the reads of a cell and tag that pass but for uniqueness. Where several gene sets
    of a molecule overlap and have one gene in common, all their reads get that gene.
    """
    sets = saved(_overlap_components(_molecule_sets(reads)))
    each = sets.select("cell", "rmt", F.size("sets").alias("n_sets"), F.explode(F.arrays_zip(F.col("sets").alias("genes"), F.col("label").alias("label"))).alias("z")).select("cell", "rmt", "n_sets", "z.genes", "z.label")
    parts = each.groupBy("cell", "rmt", "label").agg(F.first("n_sets").alias("n_sets"), F.count(F.lit(1)).alias("size"), F.collect_list("genes").alias("groups"))
    common = F.aggregate(F.slice("groups", 2, F.greatest(F.size("groups") - 1, F.lit(1))), F.get("groups", F.lit(0)), F.array_intersect)
    parts = parts.withColumn("common", common).withColumn(
        "outcome",
        F.when(F.col("n_sets") == 1, "unique").when(F.col("size") == 1, "disjoint").when(F.size("common") == 1, "model").otherwise("ambiguous"),
    )
    collisions = sets.where(F.size("sets") > 1).agg(F.count(F.lit(1)).alias("n")).select(F.lit("collisions").alias("outcome"), "n")
    counters = parts.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).unionByName(collisions)
    chosen = parts.where("outcome = 'model'").select("cell", "rmt", F.explode("groups").alias("genes"), F.get("common", F.lit(0)).alias("chosen"))
    keyed = first_alignment(reads).withColumn("genes", F.array_sort(F.array_distinct(F.transform("alignments", lambda a: a["gene"]))))
    open_ = S.passes(F.col("status"), "gene_not_unique")
    joined = keyed.join(chosen, ["cell", "rmt", "genes"], "left").withColumn("chosen", F.when(open_, F.col("chosen")))
    place = F.get(F.filter("alignments", lambda a: a["gene"] == F.col("chosen")), F.lit(0))["position"]
    resolved = (
        joined.withColumn("position", F.when(F.col("chosen").isNotNull(), place).otherwise(F.col("position")))
        .withColumn("gene", F.coalesce("chosen", "gene"))
        .withColumn("status", F.when(F.col("chosen").isNotNull(), F.col("status").bitwiseAND(F.lit(S.mask("gene_not_unique")))).otherwise(F.col("status")))
    )
    return resolved.select(*reads.columns, *[c for c in ("gene", "position") if c not in reads.columns]), counters


def log_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series from 16 on and a sum below; exact to double precision."""
    x = n.cast("double") + 1
    series = (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, 5)) - 1 / (1680 * F.pow(x, 7))
    small = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(n, F.lit(16)).cast("int"), F.lit(1))), F.lit(0.0), lambda a, k: a + F.log(k.cast("double")))
    return F.when(n < 16, small).otherwise(series)


def hypergeometric_tail(k: Column, total: Column, good: Column, drawn: Column) -> Column:
    """P(X > k) for the number of good ones among drawn of total."""
    choose = lambda n, r: log_factorial(n) - log_factorial(r) - log_factorial(n - r)
    least, most = F.greatest(k + 1, good + drawn - total), F.least(good, drawn)
    terms = F.transform(F.sequence(least, F.greatest(most, least)), lambda x: F.when((x <= most) & (drawn - x <= total - good) & (x >= 0), F.exp(choose(good, x) + choose(total - good, drawn - x) - choose(total, drawn))).otherwise(0.0))
    return F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def lonely_positions(reads: DataFrame) -> DataFrame:
    """For each gene and position with lonely triplets: their number there and in the gene, reads there and in the gene, p.

    A triplet (cell, gene, tag) is lonely where all its reads have one position. Reads at position 0 don't count.
    """
    live = active(reads)
    there = live.groupBy("gene", "position").agg(F.sum((F.col("position") != 0).cast("long")).alias("n_position"))
    gene = Window.partitionBy("gene")
    there = there.withColumn("n_gene", F.sum("n_position").over(gene))
    lonely = live.groupBy("gene", "cell", "rmt").agg(F.min("position").alias("position"), F.max("position").alias("other")).where(F.col("position") == F.col("other"))
    at = lonely.groupBy("gene", "position").agg(F.count(F.lit(1)).alias("lonely_position")).withColumn("lonely_gene", F.sum("lonely_position").over(gene))
    both = at.join(there, ["gene", "position"])
    return both.withColumn("p", hypergeometric_tail(F.col("lonely_position"), F.col("n_gene"), F.col("lonely_gene"), F.col("n_position")))


def flag_lonely_triplets(reads: DataFrame, alpha: float = 0.25) -> DataFrame:
    """Flags the reads at gene positions with more lonely triplets than chance gives, by Benjamini-Hochberg."""
    from cellweave.operators.testing import bh_adjust

    bad = bh_adjust(lonely_positions(reads), "p").where(F.col("q") <= alpha).select("gene", "position", F.lit(True).alias("__bad"))
    joined = reads.join(bad, ["gene", "position"], "left")
    return joined.withColumn("status", S.with_flag(F.col("status"), "lonely_triplet", F.coalesce("__bad", F.lit(False)) & (F.col("status") == 0))).select(*reads.columns)
