"""Cell barcode correction: whitelists, error rates, synthesis errors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.checkpoints import saved
from cellweave.functions import dna
from cellweave.functions import status as S

from .reads import active

#: Rate of an error that no barcode shows.
DEFAULT_RATE = 0.02


def split_barcode(cell: Column, layout: tuple[int, ...]) -> list[Column]:
    """Parts of a packed cell from its end; a length of -1 takes the rest. Parts come in the sequence's order."""
    parts, rest = [], cell
    for n in reversed(layout):
        if n == -1:
            parts.append(rest)
        else:
            parts.append(rest.bitwiseAND(F.lit((1 << 3 * n) - 1).cast("long")))
            rest = F.shiftright(rest, 3 * n)
    return parts[::-1]


def nearest_in_whitelist(barcodes: DataFrame, whitelist: DataFrame, most: int = 2) -> DataFrame:
    """barcode, correct, distance for distinct barcodes within ``most`` (0 to 2) errors of whitelist(barcode).

    Ties go to the smallest barcode. Neighbours of both sides meet half-way, so that two errors need
    no enumeration of all pairs: rows are the barcodes' one-error neighbours, not pairs.
    """
    codes = barcodes.select("barcode").distinct()
    known = whitelist.select(F.col("barcode").alias("correct")).distinct()
    exact = codes.join(known.withColumn("barcode", F.col("correct")), "barcode")
    found = [exact.select("barcode", "correct")]
    rest = codes.join(known.select(F.col("correct").alias("barcode")), "barcode", "left_anti")
    near = rest.select("barcode", F.explode(dna.neighbours(F.col("barcode"))).alias("near"))
    if most >= 1:
        found.append(near.join(known.withColumn("near", F.col("correct")), "near").select("barcode", "correct"))
    if most >= 2:
        spread = known.select("correct", F.explode(dna.neighbours(F.col("correct"))).alias("near"))
        found.append(near.join(spread, "near").select("barcode", "correct"))
    every = reduce(DataFrame.unionByName, found).withColumn("distance", dna.hamming(F.col("barcode"), F.col("correct")))
    best = every.groupBy("barcode").agg(F.min(F.struct("distance", "correct")).alias("best"))
    return best.select("barcode", F.col("best.correct").alias("correct"), F.col("best.distance").alias("distance"))


def tenx_corrections(reads: DataFrame, whitelist: DataFrame) -> DataFrame:
    """cell, corrected (null where there is none) for every cell of the reads.

    A whitelisted cell stays; another becomes the observed whitelisted cell at distance one with the
    most reads, ties to the neighbour that comes first by place from the end, then A, C, G, T, N.
    """
    cells = saved(reads.groupBy("cell").agg(F.sum(S.passes(F.col("status"), "gene_not_unique").cast("long")).alias("n")))
    known = cells.join(whitelist.select(F.col("barcode").alias("cell")).distinct(), "cell", "left_semi")
    seen = known.where("n > 0")
    rest = cells.join(known.select("cell"), "cell", "left_anti").select("cell")
    near = rest.select("cell", F.posexplode(dna.neighbours(F.col("cell"))).alias("ord", "near"))
    best = near.join(seen.select(F.col("cell").alias("near"), "n"), "near").groupBy("cell").agg(F.max(F.struct(F.col("n"), (-F.col("ord")).alias("first"), "near"))["near"].alias("corrected"))
    return rest.join(best, "cell", "left").unionByName(known.select("cell", F.col("cell").alias("corrected")))


def apply_corrections(reads: DataFrame, corrections: DataFrame) -> DataFrame:
    """Reads under their corrected cells; reads of cells without one get cell_error."""
    fixed = corrections.select("cell", "corrected")
    return reads.join(fixed, "cell", "left").withColumn("status", S.with_flag(F.col("status"), "cell_error", F.col("corrected").isNull())).withColumn("cell", F.coalesce("corrected", "cell")).select(*reads.columns)


def indrop_corrections(reads: DataFrame, whitelists: list[DataFrame], layout: tuple[int, ...], most: int = 2) -> DataFrame:
    """cell, corrected (null above ``most`` errors in a part), total (errors over all parts) for distinct cells.

    Cells come from reads that pass but for uniqueness. Each part is corrected by its own whitelist.
    """
    cells = saved(active(reads, "gene_not_unique").select("cell").distinct())
    parts = [f"part{i}" for i in range(len(layout))]
    out = cells.select("cell", *[p.alias(n) for p, n in zip(split_barcode(F.col("cell"), layout), parts, strict=True)])
    for name, white in zip(parts, whitelists, strict=True):
        near = nearest_in_whitelist(out.select(F.col(name).alias("barcode")), white, most)
        out = out.join(near.select(F.col("barcode").alias(name), F.col("correct").alias(f"{name}_c"), F.col("distance").alias(f"{name}_d")), name, "left")
    fits = reduce(Column.__and__, [F.col(f"{n}_d").isNotNull() & (F.col(f"{n}_d") <= most) for n in parts])
    total = reduce(Column.__add__, [F.col(f"{n}_d") for n in parts])
    return out.select("cell", F.when(fits, dna.concat(*[F.col(f"{n}_c") for n in parts])).alias("corrected"), F.when(fits, total).alias("total"))


def error_rates(corrections: DataFrame, default: float = DEFAULT_RATE) -> DataFrame:
    """from_b, to_b, rate for the 20 ordered pairs of bases, from distinct cells (cell, corrected, total).

    Errors count where a cell has one in all; right bases count in every corrected cell. A base that
    never occurs has the default rate, and errors of N have 0.
    """
    kept = corrections.where("corrected is not null")
    places = F.transform(F.sequence(F.lit(0), dna.seq_len(F.col("corrected")) - 1), lambda i: F.struct(dna.base_at(F.col("corrected"), i).cast("int").alias("from_b"), dna.base_at(F.col("cell"), i).cast("int").alias("to_b")))
    each = kept.where("corrected > 0").select("total", F.explode(places).alias("e")).groupBy("e.from_b", "e.to_b").agg(F.sum(F.when((F.col("e.from_b") == F.col("e.to_b")) | (F.col("total") == 1), 1).otherwise(0)).alias("n"))
    spark = corrections.sparkSession
    codes = list(dna.CODES.values())
    pairs = spark.createDataFrame([(a, b) for a in codes for b in codes], "from_b int, to_b int")
    full = pairs.join(each, ["from_b", "to_b"], "left").fillna(0, ["n"]).withColumn("all", F.sum("n").over(Window.partitionBy("from_b")))
    rate = F.when(F.col("from_b") == dna.CODES["N"], 0.0).when(F.col("all") == 0, default).otherwise(F.col("n") / F.nullif(F.col("all"), F.lit(0)))
    return full.where("from_b <> to_b").select("from_b", "to_b", rate.alias("rate"))


def shifted_headers(reads: DataFrame, least_tags: int = 10, share: float = 0.9) -> DataFrame:
    """Headers (cells without the last base) of at least so many distinct tags that mostly end in T: header, n_tags, n_t."""
    tags = active(reads).select(F.shiftright("cell", 3).alias("header"), "rmt").distinct()
    counts = tags.groupBy("header").agg(F.count(F.lit(1)).alias("n_tags"), F.sum((F.col("rmt").bitwiseAND(F.lit(7)) == dna.CODES["T"]).cast("long")).alias("n_t"))
    return counts.where((F.col("n_tags") >= least_tags) & (F.col("n_t") > share * F.col("n_tags")))


def repair_shift(reads: DataFrame, least_tags: int = 10, share: float = 0.9) -> DataFrame:
    """Gives active reads of shifted headers their tag back: the cell's last base leads it, and N ends the cell."""
    bad = shifted_headers(reads, least_tags, share).select(F.col("header").alias("__header"), F.lit(True).alias("__shifted"))
    joined = reads.withColumn("__header", F.shiftright("cell", 3)).join(bad, "__header", "left")
    fix = F.coalesce("__shifted", F.lit(False)) & (F.col("status") == 0)
    tag = dna.concat(F.col("cell").bitwiseAND(F.lit(7).cast("long")), F.shiftright("rmt", 3))
    cell = F.shiftleft("__header", 3).bitwiseOR(F.lit(dna.CODES["N"]).cast("long"))
    return joined.withColumn("rmt", F.when(fix, tag).otherwise(F.col("rmt"))).withColumn("cell", F.when(fix, cell).otherwise(F.col("cell"))).select(*reads.columns)


def biased_cells(reads: DataFrame, least_tags: int = 10, share: float = 0.8) -> DataFrame:
    """Cells of at least so many distinct tags where one base (not N) dominates a place before the last: cell, n_tags, most."""
    tags = active(reads).select("cell", "rmt").distinct()
    size = tags.groupBy("cell").agg(F.count(F.lit(1)).alias("n_tags")).where(F.col("n_tags") >= least_tags)
    places = tags.select("cell", F.explode(F.transform(F.sequence(F.lit(0), dna.seq_len(F.col("rmt")) - 1), lambda i: F.struct(i.alias("place"), dna.base_at(F.col("rmt"), i).alias("base")))).alias("b"))
    share_of = places.where((F.col("b.place") >= 1) & (F.col("b.base") != dna.CODES["N"])).groupBy("cell", "b.place", "b.base").agg(F.count(F.lit(1)).alias("n"))
    most = share_of.groupBy("cell").agg(F.max("n").alias("most"))
    return size.join(most, "cell").where(F.col("most") > share * F.col("n_tags")).select("cell", "n_tags", "most")


def dropseq_correction(reads: DataFrame, least_tags: int = 10, base_share: float = 0.8, shift_share: float = 0.9) -> DataFrame:
    """Repairs shifted barcodes, then flags cells with a dominated tag place."""
    fixed = repair_shift(reads, least_tags, shift_share)
    bad = biased_cells(fixed, least_tags, base_share).select("cell", F.lit(True).alias("__bad"))
    return fixed.join(bad, "cell", "left").withColumn("status", S.with_flag(F.col("status"), "cell_error", F.coalesce("__bad", F.lit(False)) & (F.col("status") == 0))).select(*reads.columns)
