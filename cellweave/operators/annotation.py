"""Genes: interval join of alignments, truncated exons, symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions in a bin of the interval join.
BIN = 1 << 14


def genes_at(alignments: DataFrame, intervals: DataFrame, keys: list[str], bin_size: int = BIN) -> DataFrame:
    """The gene of each alignment: that of the intervals [start, end) which hold its position, null for none or several.

    alignments: keys, chrom, strand, pos. Intervals are repeated for each bin they touch, so that the
    join has the bin among its equal keys; a long interval costs a row a bin and no alignment meets
    more intervals than its bin holds. Equal places are looked up once.
    """
    places = alignments.select("chrom", "strand", "pos").distinct().withColumn("bin", F.floor(F.col("pos") / bin_size))
    binned = intervals.where("end > start").withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / bin_size), F.floor((F.col("end") - 1) / bin_size))))
    hits = places.join(binned, ["chrom", "strand", "bin"]).where("pos >= start and pos < end")
    found = hits.groupBy("chrom", "strand", "pos").agg(F.min("gene").alias("lo"), F.max("gene").alias("hi"))
    gene = found.select("chrom", "strand", "pos", F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("gene"))
    return alignments.join(gene, ["chrom", "strand", "pos"], "left").select(*keys, "chrom", "strand", "pos", "gene")


def truncated_exons(exons: DataFrame, most: int = 1000) -> DataFrame:
    """Exons of each transcript from its 3' end until ``most`` positions are used, the last one clipped.

    exons: transcript, strand, ord (file order), start, end. The exon last in file order is nearest the 3' end.
    """
    order = Window.partitionBy("transcript").orderBy(F.desc("ord"))
    size = F.col("end") - F.col("start")
    left = F.lit(most) - (F.sum(size).over(order) - size)
    kept = exons.where("end > start").withColumn("left", left).withColumn("rank", F.row_number().over(order)).where("left > 0")
    clip = size >= F.col("left")
    return kept.select(
        "transcript", "strand", "rank",
        F.when(clip & (F.col("strand") == "+"), F.col("end") - F.col("left")).otherwise(F.col("start")).alias("start"),
        F.when(clip & (F.col("strand") == "-"), F.col("start") + F.col("left")).otherwise(F.col("end")).alias("end"),
    )


def transcripts(records: DataFrame) -> DataFrame:
    """Exon rows with the ordinal of the transcript they follow, from records with line, feature and seqname.

    Ordinals run within a sequence name, whose rows stand together in a file.
    """
    order = Window.partitionBy("seqname").orderBy("line")
    return records.withColumn("transcript", F.sum((F.col("feature") == "transcript").cast("long")).over(order)).where("feature = 'exon' and transcript > 0")


def gene_symbols(records: DataFrame) -> DataFrame:
    """gene and symbol of gene rows: upper-case names, several joined by '-' in order."""
    return records.where("feature = 'gene'").groupBy("gene").agg(F.array_join(F.array_sort(F.collect_set(F.upper("name"))), "-").alias("symbol"))


def gene_subset(records: DataFrame, ids: DataFrame, biotypes: tuple[str, ...] = ("protein_coding", "lincRNA")) -> DataFrame:
    """Rows whose gene_id has another id in ids(gene_id, other ids...) and whose biotype is one of biotypes."""
    others = [c for c in ids.columns if c != "gene_id"]
    known = ids.where(F.coalesce(*[F.col(c).cast("string") for c in others]).isNotNull()).select("gene_id").distinct()
    return records.where(F.col("biotype").isin(*biotypes)).join(known, "gene_id", "left_semi")


def distinct_records(records: DataFrame) -> DataFrame:
    """One record of each place (seqname, strand, start, end), the first in file order, with its size."""
    first = records.groupBy("seqname", "strand", "start", "end").agg(F.min("line").alias("line"))
    return records.join(first.select("line"), "line", "left_semi").withColumn("size", F.col("end") - F.col("start"))


def integer_gene_id(gene_id: Column) -> Column:
    """The number in an id like ENSG00000000003.14; ids without one raise an error."""
    digits = F.regexp_extract(gene_id, r"^[^0-9]*([0-9]+)", 1)
    return F.when(digits != "", digits.cast("long")).otherwise(F.raise_error(F.concat(F.lit("no number in gene id "), gene_id)).cast("long"))


def organism_prefix(gene_id: Column) -> Column:
    return F.regexp_extract(gene_id, r"^([^0-9]*)", 1)


def string_gene_id(number: Column, prefix: str = "ENSG") -> Column:
    """At least 11 digits after the prefix."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= 11, digits).otherwise(F.lpad(digits, 11, "0")))


def tiles(name: str, length: int, step: int = 1000):
    """Rows of a pseudo-annotation: tiles of a sequence on both strands, as (seqname, strand, start, end, gene)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    starts = spark.range(0, max(0, length), step).select(F.col("id").alias("start"), F.least(F.col("id") + step, F.lit(length)).alias("end"))
    sides = F.explode(F.array(F.struct(F.lit("+").alias("strand"), F.lit(0).alias("side")), F.struct(F.lit("-").alias("strand"), F.lit(1).alias("side"))))
    return starts.withColumn("s", sides).select(F.lit(name).alias("seqname"), "s.strand", "start", "end", (F.floor(F.col("start") / step) * 2 + F.col("s.side") + 1).alias("gene"))
