"""Schemas of the engine's relations."""

from __future__ import annotations

from pyspark.sql import types as T

FASTQ = T.StructType([T.StructField("ord", T.LongType()), *[T.StructField(n, T.StringType()) for n in ("name", "sequence", "name2", "quality")]])
SAM = T.StructType(
    [T.StructField(n, t()) for n, t in (("qname", T.StringType), ("flag", T.IntegerType), ("rname", T.StringType), ("pos", T.IntegerType), ("mapq", T.IntegerType), ("cigar", T.StringType), ("rnext", T.StringType), ("pnext", T.IntegerType), ("tlen", T.IntegerType), ("seq", T.StringType), ("qual", T.StringType))]
    + [T.StructField("tags", T.MapType(T.StringType(), T.IntegerType()))]
)
GTF = T.StructType([T.StructField(n, t()) for n, t in (("seqname", T.StringType), ("source", T.StringType), ("feature", T.StringType), ("start", T.LongType), ("end", T.LongType), ("score", T.StringType), ("strand", T.StringType), ("frame", T.StringType), ("attribute", T.StringType))])
ALIGNMENTS = T.ArrayType(T.StructType([T.StructField("gene", T.IntegerType()), T.StructField("position", T.IntegerType())]))
READS = T.StructType([T.StructField("read_id", T.LongType()), T.StructField("status", T.IntegerType()), T.StructField("cell", T.LongType()), T.StructField("rmt", T.LongType()), T.StructField("n_poly_t", T.IntegerType()), T.StructField("alignments", ALIGNMENTS)])
INTERVALS = T.StructType([T.StructField("chrom", T.StringType()), T.StructField("strand", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("gene", T.IntegerType())])
COUNTS = T.StructType([T.StructField("cell", T.LongType()), T.StructField("gene", T.IntegerType()), T.StructField("n_reads", T.LongType()), T.StructField("n_molecules", T.LongType())])
