"""Sinks: FASTQ, MatrixMarket, dense and rank files, reports, a table archive."""

from __future__ import annotations

import json
from html import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.counts import coordinates


def write_fastq(records: DataFrame, path: str) -> None:
    """Records in order, four lines each."""
    records.repartitionByRange("ord").sortWithinPartitions("ord").select(F.concat_ws("\n", "name", "sequence", "name2", "quality").alias("value")).write.mode("overwrite").text(path)


def write_truncated_fastq(records: DataFrame, path: str, lengths: list[int], most: int = 10_000_000) -> None:
    """A folder len=n for each length under a record's own, of the first records."""
    first = records.where(F.col("ord") < most)
    cut = first.withColumn("len", F.explode(F.array(*[F.lit(n) for n in lengths]))).where(F.col("len") < F.length("sequence"))
    rows = cut.select("len", F.concat_ws("\n", "name", F.substr("sequence", F.lit(1), "len"), "name2", F.substr("quality", F.lit(1), "len")).alias("value"))
    rows.write.mode("overwrite").partitionBy("len").text(path)


def write_matrix_market(counts: DataFrame, path: str, value: str = "n_molecules") -> None:
    """Header and 1-based row, col, value lines; row and column ids follow the sorted cells and genes."""
    rows = coordinates(counts, value)
    n = rows.agg(F.max("row"), F.max("col"), F.count(F.lit(1))).first()
    head = f"%%MatrixMarket matrix coordinate integer general\n%\n{n[0] or 0} {n[1] or 0} {n[2]}"
    top = counts.sparkSession.createDataFrame([(0, 0, head)], "row long, col long, value string")
    body = rows.select("row", "col", F.concat_ws(" ", F.col("row").cast("string"), F.col("col").cast("string"), F.col("value").cast("string")).alias("value"))
    top.unionByName(body).repartitionByRange("row", "col").sortWithinPartitions("row", "col").select("value").write.mode("overwrite").text(path)


def write_csv(rows: DataFrame, path: str, sep: str = ",") -> None:
    rows.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_gtf(records: DataFrame, path: str) -> None:
    """GTF lines in file order; missing fields are dots."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in ("seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attribute")]
    records.repartitionByRange("line").sortWithinPartitions("line").select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").text(path)


def write_rank_file(ranks: DataFrame, path: str) -> None:
    """gene and score by tab, highest first."""
    ranks.select("gene", "score").repartitionByRange(F.desc("score")).sortWithinPartitions(F.desc("score")).write.mode("overwrite").option("sep", "\t").csv(path)


def write_gene_lists(tests: DataFrame, path: str) -> None:
    """A line for each significant gene of a cluster: cluster, gene, q, fold change."""
    tests.orderBy("cluster", "q").select(F.format_string("%s\t%s\t%.6g\t%.4f", F.col("cluster").cast("string"), F.col("gene").cast("string"), "q", "logfc").alias("value")).write.mode("overwrite").text(path)


def summary_json(metrics: DataFrame) -> str:
    """A one-row metrics frame as JSON."""
    return json.dumps(metrics.first().asDict(), default=float, sort_keys=True)


def summary_html(sections: dict[str, dict[str, object]], title: str = "run summary") -> str:
    """Sections of name and value as a page."""
    body = "".join(f"<h2>{escape(s)}</h2><table>" + "".join(f"<tr><th>{escape(str(k))}</th><td>{escape(str(v))}</td></tr>" for k, v in rows.items()) + "</table>" for s, rows in sections.items())
    return f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><h1>{escape(title)}</h1>{body}"


class Archive:
    """Named tables under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def save(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def ls(self, prefix: str = "") -> list[str]:
        fs, path = self._fs()
        return sorted(n for s in (fs.listStatus(path) if fs.exists(path) else []) if (n := s.getPath().getName()).startswith(prefix))

    def remove(self, prefix: str) -> None:
        fs, _ = self._fs()
        for name in self.ls(prefix):
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}"), True)
