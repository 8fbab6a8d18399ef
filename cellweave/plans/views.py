"""Relations of the engine made from the driver's tables, with the SQL that makes the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions import dna
from cellweave.operators.counts import count_matrix
from cellweave.operators.reads import first_alignment, initial_status


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sequence(x: Column, n: int) -> Column:
    """n bases of an integer, two bits each, lowest first."""
    return F.concat(*[F.substr(F.lit("ACGT"), (F.shiftright(x, 2 * i).bitwiseAND(F.lit(3).cast("long")) + 1).cast("int"), F.lit(1)) for i in range(n)])


def packed(x: Column, n: int) -> Column:
    return dna.encode(sequence(x, n))


def sequence_sql(x: str, n: int) -> str:
    return " || ".join(f"substr('ACGT', CAST((({x}) >> {2 * i}) & 3 AS INTEGER) + 1, 1)" for i in range(n))


def packed_sql(x: str, n: int) -> str:
    return "(" + " + ".join(f"[4, 6, 5, 3][CAST((({x}) >> {2 * i}) & 3 AS INTEGER) + 1]::BIGINT * {8 ** (n - 1 - i)}" for i in range(n)) + ")"


def alignments_of(gene: Column, position: Column, second: Column, other: Column) -> Column:
    entry = lambda g, p, when: F.when(when & (g != 0), F.array(F.struct(g.cast("int").alias("gene"), p.cast("int").alias("position")))).otherwise(F.array().cast("array<struct<gene:int,position:int>>"))
    return F.concat(entry(gene, position, F.lit(True)), entry(other, position + 1, second))


def raw_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of lineitem: every seventh order has a second alignment; zeros are missing values."""
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("read_id"), F.lit(0).alias("status"), c("l_suppkey").cast("long").alias("cell"), (c("l_orderkey") % 64).cast("long").alias("rmt"),
        (c("l_quantity").cast("int") % 10).alias("n_poly_t"), alignments_of(c("l_partkey") % 20, c("l_linenumber"), c("l_orderkey") % 7 == 0, (c("l_partkey") + 7) % 20).alias("alignments"),
    )


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_alignment(initial_status(raw_reads(spark, sf_dir)))


READS = """
raw AS (
  SELECT l_orderkey AS read_id, l_suppkey AS cell, CAST(l_partkey % 20 AS INTEGER) AS g, l_orderkey % 64 AS rmt, CAST(l_linenumber AS INTEGER) AS pos, CAST(l_quantity AS INTEGER) % 10 AS n_poly_t,
         l_orderkey % 7 = 0 AND (l_partkey + 7) % 20 <> 0 AS two, CAST((l_partkey + 7) % 20 AS INTEGER) AS g2 FROM lineitem
), reads AS (
  SELECT *, CASE WHEN g = 0 AND NOT two THEN 1 ELSE 0 END + CASE WHEN g <> 0 AND two THEN 16 ELSE 0 END + CASE WHEN rmt = 0 OR cell = 0 THEN 32 ELSE 0 END + CASE WHEN n_poly_t < 1 THEN 8 ELSE 0 END AS status,
         CASE WHEN g <> 0 THEN g WHEN two THEN g2 ELSE 0 END AS gene, CASE WHEN g <> 0 THEN pos WHEN two THEN pos + 1 ELSE 0 END AS position FROM raw
), counts AS (
  SELECT cell, gene, count(*) AS n_reads, count(DISTINCT rmt) AS n_molecules FROM reads WHERE status = 0 GROUP BY cell, gene
)"""


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_matrix(reads(spark, sf_dir))


def dna_reads(spark: SparkSession, sf_dir: str, cell_bases: int = 4) -> DataFrame:
    """Reads with packed cells and three-base tags; all of them active."""
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("read_id"), F.lit(0).alias("status"), packed(c("l_suppkey").cast("long"), cell_bases).alias("cell"), packed((c("l_orderkey") % 64).cast("long"), 3).alias("rmt"),
        F.lit(5).alias("n_poly_t"), (c("l_partkey") % 20).cast("int").alias("gene"), c("l_linenumber").cast("int").alias("position"),
    )


DNA_READS = f"""
dna_reads AS (
  SELECT l_orderkey AS read_id, {packed_sql("l_suppkey", 4)} AS cell, {packed_sql("l_orderkey % 64", 3)} AS rmt, CAST(l_partkey % 20 AS INTEGER) AS gene, CAST(l_linenumber AS INTEGER) AS position FROM lineitem
)"""


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("chrom"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"), F.col("l_partkey").alias("pos"))


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (k % 3 + 1).cast("int")).alias("chrom"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"),
        k.alias("start"), (k + 1 + F.col("p_size") % 10).alias("end"), (k % 20).cast("int").alias("gene"),
    )


INTERVALS = """
al AS (SELECT l_orderkey, l_returnflag AS chrom, CASE l_linestatus WHEN 'O' THEN '+' ELSE '-' END AS strand, l_partkey AS pos FROM lineitem),
iv AS (SELECT ['A', 'N', 'R'][CAST(p_partkey % 3 AS INTEGER) + 1] AS chrom, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey AS s, p_partkey + 1 + p_size % 10 AS e, p_partkey % 20 AS gene FROM part)"""


def labels(frame: DataFrame, groups: int = 3) -> DataFrame:
    """cell and label of every cell of a frame."""
    return frame.select("cell").distinct().withColumn("label", (F.col("cell") % groups).cast("int"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cell"), F.col("embedding").alias("vector"), "label")
