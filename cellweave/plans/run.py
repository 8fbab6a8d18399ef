"""The whole run: read table to filtered counts, by a platform's corrections.

Every stage takes and returns a read table, so a run resumes from any stage that was written.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.checkpoints import saved
from cellweave.operators import annotation, barcodes, cellqc, reads, rmt
from cellweave.operators.counts import count_matrix
from cellweave.operators.platforms import PLATFORMS
from cellweave.sources import readers


@dataclass
class Run:
    reads: DataFrame
    counts: DataFrame
    filtered: DataFrame
    cells: DataFrame
    multimapping: DataFrame
    error_rates: DataFrame | None


def correct_barcodes(table: DataFrame, name: str, whitelists: list[DataFrame]) -> tuple[DataFrame, DataFrame | None]:
    """(reads under corrected cells, error rates where the platform gives them)."""
    p = PLATFORMS[name]
    if p.correction is None:
        raise NotImplementedError(f"{name} has no barcode correction")
    if p.correction == "ten_x":
        every = reduce(DataFrame.unionByName, [w.select("barcode") for w in whitelists])
        return barcodes.apply_corrections(table, barcodes.tenx_corrections(table, every)), None
    if p.correction == "drop_seq":
        return barcodes.dropseq_correction(table), None
    found = saved(barcodes.indrop_corrections(table, whitelists, p.layout, p.max_errors))
    return barcodes.apply_corrections(table, found), barcodes.error_rates(found)


def run(raw: DataFrame, name: str, whitelists: list[DataFrame], required_poly_t: int = 1, mitochondrial: DataFrame | None = None, most_mt: float = 0.2) -> Run:
    """mitochondrial: genes (column gene) whose molecules count for the high_mt filter."""
    p = PLATFORMS[name]
    table = saved(reads.initial_status(raw, required_poly_t))
    table, rates = correct_barcodes(table, name, whitelists)
    table, outcomes = reads.resolve_multimapping(saved(table))
    table = saved(table)
    if p.tag_correction:
        table = saved(rmt.flag_tag_errors(table, p.tag_rate or 0.02, rates=None if p.tag_rate else rates))
    if p.lonely_triplets:
        table = saved(reads.flag_lonely_triplets(table))
    counts = saved(count_matrix(table))
    marked, mt = counts, None
    if mitochondrial is not None:
        marked = counts.join(mitochondrial.select("gene", F.lit(True).alias("mt")).distinct(), "gene", "left")
        mt = F.coalesce("mt", F.lit(False))
    kept, cells = cellqc.filter_cells(marked, mt, most_mt, coverage=p.correction != "ten_x", low_count=p.low_count)
    return Run(table, counts, kept.select(*counts.columns), cells, outcomes, rates)


def gene_intervals(records: DataFrame, most: int = 1000) -> DataFrame:
    """Intervals of genes from GTF records: the last ``most`` positions of each transcript's exons."""
    exons = annotation.transcripts(records).select(
        F.concat_ws(":", "seqname", F.col("transcript").cast("string")).alias("transcript"), "strand", F.col("line").alias("ord"), "start", "end",
        F.col("seqname").alias("chrom"), annotation.integer_gene_id(F.element_at("attributes", "gene_id")).cast("int").alias("gene"),
    )
    owner = exons.select("transcript", "chrom", "gene").distinct()
    return annotation.truncated_exons(exons, most).join(owner, "transcript").select("chrom", "strand", "start", "end", "gene").distinct()


def mitochondrial_genes(records: DataFrame) -> DataFrame:
    """gene of the GTF records' genes whose symbol starts with MT-."""
    named = records.where("feature = 'gene'").select(annotation.integer_gene_id(F.element_at("attributes", "gene_id")).cast("int").alias("gene"), F.try_element_at("attributes", F.lit("gene_name")).alias("name"))
    return annotation.gene_symbols(named.withColumn("feature", F.lit("gene"))).where("symbol like 'MT-%'").select("gene")


#: Positions from a transcript's 3' end where its reads may lie, and those of platforms that read whole transcripts.
INSERT, WHOLE_INSERT = 1000, 10_000


def from_alignments(alignments: DataFrame, records: DataFrame, name: str) -> DataFrame:
    """The read table of annotated alignments of a platform by the genes of GTF records."""
    most = WHOLE_INSERT if PLATFORMS[name].correction == "ten_x" else INSERT
    return readers.read_table(alignments, gene_intervals(records, most))
