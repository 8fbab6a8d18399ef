"""Command line: run a read table or alignments to filtered counts, or merge count tables."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cellweave.operators.counts import merge_samples
from cellweave.operators.platforms import PLATFORMS
from cellweave.plans.run import from_alignments, mitochondrial_genes, run
from cellweave.sources import readers, writers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cellweave")
    commands = top.add_subparsers(dest="command", required=True)
    r = commands.add_parser("run", help="counts from alignments or from a saved read table")
    r.add_argument("platform", choices=sorted(PLATFORMS))
    r.add_argument("out")
    r.add_argument("--alignments", nargs="*", default=[], help="SAM or BAM files with annotated names")
    r.add_argument("--annotation", help="GTF file; its MT- genes are those of the mitochondrial filter")
    r.add_argument("--reads", help="read table to start from instead")
    r.add_argument("--whitelist", nargs="*", default=[], help="barcode files, one for each part of the cell")
    r.add_argument("--min-poly-t", type=int, default=0)
    r.add_argument("--max-mitochondrial", type=float, default=0.2)
    m = commands.add_parser("merge", help="one table of several samples' count tables")
    m.add_argument("out")
    m.add_argument("tables", nargs="+")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("cellweave").getOrCreate()
    if args.command == "merge":
        merge_samples(*[spark.read.parquet(t) for t in args.tables]).write.mode("overwrite").parquet(args.out)
        return
    if not args.reads and not (args.alignments and args.annotation):
        raise SystemExit("run needs --reads, or --alignments and --annotation")
    records = readers.gtf(spark, args.annotation) if args.annotation else None
    mitochondrial = mitochondrial_genes(records) if records is not None else None
    if args.reads:
        raw = spark.read.parquet(args.reads)
    else:
        bam = [f for f in args.alignments if f.endswith(".bam")]
        sam = [f for f in args.alignments if not f.endswith(".bam")]
        tables = [read(spark, files) for read, files in ((readers.bam, bam), (readers.sam, sam)) if files]
        raw = from_alignments(tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1]), records, args.platform)
    done = run(raw, args.platform, [readers.whitelist(spark, w) for w in args.whitelist], args.min_poly_t, mitochondrial, args.max_mitochondrial)
    box = writers.Archive(spark, args.out)
    for name, table in (("reads", done.reads), ("counts", done.counts), ("filtered", done.filtered), ("cells", done.cells), ("multimapping", done.multimapping)):
        box.save(table, name)
    writers.write_matrix_market(done.counts, f"{args.out}/molecules.mtx")


if __name__ == "__main__":
    main()
