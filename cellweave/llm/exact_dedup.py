"""Exact dedup: tree-merge of sorted digest runs, with DataFrame functions only.

The key of a text is its SHA-256, and its proof MD5 and length. Every input partition belongs to
one run; a run holds each key once, combined before any exchange, with its extreme identifier and
its number of rows. Runs are cut at the same places of the digest space into slots. In a round,
``fan_in`` runs of a slot go to one task, are merged into one order by digest, and of neighbours
with equal digests and equal proofs one row stays, until one run is left. A key has at most
``fan_in`` rows in any round, and no task holds more than a slot of some runs.

The answer goes back down: the runs that held a key learn its group, and rows ask their own run,
so that the rows of a large group are dealt over all runs.

A proof is compared wherever two digests meet, at every level. Texts of equal SHA-256, MD5 and length
are taken as equal; comparing their bytes as well would send all texts through every round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

#: Runs of the first round, and runs merged into one in each further round.
RUNS, FAN_IN = 64, 4
KEY = ["digest", "proof", "chars"]


def text_key(text: Column) -> list[Column]:
    """SHA-256 and MD5 of the UTF-8 text as bytes, and its length; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return [F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), F.unhex(F.md5(text.cast("binary"))).alias("proof"), F.length(text).alias("chars")]


def first_runs(rows: DataFrame, keep: str = "smallest") -> DataFrame:
    """rows(id, run, digest, proof, chars) with each key once in its run: keep_id, n and slot as well."""
    best = F.min if keep == "smallest" else F.max
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lead = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    return rows.groupBy("run", *KEY).agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("n")).withColumn("slot", F.shiftright(lead * slots, 32).cast("int"))


def merge_round(level: DataFrame, keep: str, fan_in: int) -> DataFrame:
    """Runs of one number merged: of equal neighbours in the order the first stays, with the sum of their rows."""
    first = F.asc_nulls_last("keep_id") if keep == "smallest" else F.desc_nulls_last("keep_id")
    order = Window.partitionBy("run", "slot").orderBy(*KEY, first)

    def same(shift) -> Column:
        return F.coalesce(reduce(lambda a, b: a & b, [shift(c) == F.col(c) for c in KEY]), F.lit(False))

    more = [F.when(same(lambda c, k=k: F.lead(c, k).over(order)), F.lead("n", k).over(order)).otherwise(0) for k in range(1, fan_in)]
    heads = level.select("run", "slot", *KEY, "keep_id", reduce(lambda a, b: a + b, more, F.col("n")).alias("n"), (~same(lambda c: F.lag(c).over(order))).alias("head"))
    return heads.where("head").drop("head")


def merge_runs(level: DataFrame, keep: str = "smallest", runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per key of runs(run, slot, digest, proof, chars, keep_id, n), each of which holds a key once: KEY, keep_id, group_size."""
    while runs > 1:
        runs = -(-runs // fan_in)
        level = merge_round(level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")), keep, fan_in)
    return level.select(*KEY, "keep_id", F.col("n").alias("group_size"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, keep: str) -> DataFrame:
    """id, KEY, keep_id and group_size of every row of docs."""
    run = F.pmod(F.spark_partition_id(), F.lit(RUNS)).alias("run")
    rows = written(docs.select(F.col(id_col).cast("long").alias("id"), *text_key(F.col(text_col)), run), "digests")
    level = written(first_runs(rows, keep), "runs")
    told = level.select("run", *KEY).join(merge_runs(level, keep), KEY)
    return rows.join(told, ["run", *KEY])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty text. A null identifier loses against any other; a group of null
    identifiers alone keeps null. Rows that repeat identifier and text are all marked kept.
    Columns of docs other than the two named are not read, so their names can't clash. An empty
    table gives an empty result.
    """
    return _grouped(docs, id_col, text_col, keep).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of docs that stay, one for each distinct text, with their own columns, whatever their names.

    Of rows that repeat identifier and text, one stays, whichever comes first. Null text counts as
    empty text, a null identifier loses against any other, and an empty table stays empty.
    """
    ident = F.coalesce(F.col("id"), F.lit(-(2**63)).cast("long"))
    kept = _grouped(docs, id_col, text_col, keep).where(F.col("id").eqNullSafe(F.col("keep_id"))).select(ident.alias("own"), *KEY).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("id"), *text_key(F.col(text_col))).select("row", ident.alias("own"), *KEY)
    same = Window.partitionBy("own", *KEY).orderBy("own")
    return keyed.join(kept, ["own", *KEY], "left_semi").withColumn("place", F.row_number().over(same)).where("place = 1").select("row.*")
