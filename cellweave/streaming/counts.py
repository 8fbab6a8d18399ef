"""Count matrix over a stream of reads: each batch merges its distinct tags into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellweave.operators.reads import active


def count_stream(reads: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends (cell, gene, rmt, n) partials of active reads under path, one folder a batch.

    A batch that runs again overwrites its own folder, so each read counts once.
    """

    def batch(rows: DataFrame, epoch: int) -> None:
        partial = active(rows).groupBy("cell", "gene", "rmt").agg(F.count(F.lit(1)).alias("n"))
        partial.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return reads.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_so_far(spark: SparkSession, path: str) -> DataFrame:
    """The count matrix of all batches written."""
    tags = spark.read.parquet(path).groupBy("cell", "gene", "rmt").agg(F.sum("n").alias("n"))
    return tags.groupBy("cell", "gene").agg(F.sum("n").alias("n_reads"), F.count(F.lit(1)).alias("n_molecules"))
