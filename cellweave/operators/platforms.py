"""Barcode layouts: where a platform keeps pool, cell, tag and poly-T in a read pair."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Expressions over the paired columns g_name, g_sequence, g_quality (genomic) and b_sequence (barcode).
Fields = dict[str, Column]


def _cut(c: Column, start: int, stop: int | None = None) -> Column:
    """Characters start to stop of a column; places as in a slice, negative ones from the end."""
    first = F.lit(start + 1) if start >= 0 else F.greatest(F.length(c) + start + 1, F.lit(1))
    last = F.length(c) if stop is None else F.lit(stop) if stop >= 0 else F.length(c) + stop
    return F.substr(c, first, F.greatest(last - first + 1, F.lit(0)))


def _barcode() -> Column:
    return F.trim("b_sequence")


def _fixed(pool: Column | None = None, cell: Column | None = None, rmt: Column | None = None, poly_t: Column | None = None) -> Fields:
    empty = F.lit("")
    return {"pool": pool if pool is not None else empty, "cell": cell if cell is not None else empty, "rmt": rmt if rmt is not None else empty, "poly_t": poly_t if poly_t is not None else empty}


# Four bases at 24 to 28 tell the first part's length; the spacers between the parts.
SPACER_IDS = {"CGCC": 8, "ACGC": 9, "GACG": 10, "TGAC": 11}
SPACERS = {6: "GAGTGATTGCTTGTGACGCCTT", 8: "GAGTGATTGCTTGTGACGCCAA"}


def _in_drop(tag: int) -> Fields:
    """Two cell parts around a spacer; where its end isn't at its place, the first place with two wrong bases at most."""
    s, spacer = F.col("b_sequence"), SPACERS[tag]
    wide = len(spacer)
    known = reduce(lambda w, kv: w.when(F.substr(s, F.lit(25), F.lit(4)) == kv[0], kv[1]), SPACER_IDS.items(), F.when(F.lit(False), 0))

    def wrong(k: Column) -> Column:
        return F.size(F.filter(F.sequence(F.lit(1), F.lit(wide)), lambda i: F.substr(s, k + i, F.lit(1)) != F.substr(F.lit(spacer), i, F.lit(1))))

    fits = F.filter(F.array(*[F.lit(k) for k in SPACER_IDS.values()]), lambda k: (F.length(s) >= k + wide + 8 + tag) & (wrong(k) <= 2))
    k = F.coalesce(known, F.get(fits, F.lit(0)))
    end = k + wide + 8
    none = lambda c: F.when(k.isNotNull(), c).otherwise("")
    return _fixed(
        cell=none(F.concat(F.substr(s, F.lit(1), k), F.substr(s, k + wide + 1, F.lit(8)))),
        rmt=none(F.substr(s, end + 1, F.lit(tag))),
        poly_t=F.when(known.isNotNull(), F.substr(s, end + tag + 1, F.greatest(F.length(s) - end - tag, F.lit(0)))).otherwise(""),
    )


def _name_fields() -> Column:
    return F.split(F.regexp_replace("g_name", "^@", ""), ":")


@dataclass(frozen=True)
class Platform:
    name: str
    layout: tuple[int, ...]
    fields: Callable[[], Fields]
    primer_length: int | None
    correction: str | None
    max_errors: int = 0
    tag_correction: bool = False
    tag_rate: float | None = None
    lonely_triplets: bool = False
    low_count: bool = True
    trim: int = 0


# The platforms' layouts, lengths and corrections.
PLATFORMS = {
    p.name: p
    for p in (
        Platform("in_drop", (-1, 8), lambda: _in_drop(6), 47, "in_drop", 1, True),
        Platform("in_drop_v2", (-1, 8), lambda: _in_drop(8), 49, "in_drop", 2, True),
        Platform("in_drop_v3", (-1, 8), lambda: _fixed(cell=F.concat(_cut(F.trim("g_name"), -17, -9), _cut(_barcode(), 0, 8)), rmt=_cut(_barcode(), 8, 16), poly_t=_cut(_barcode(), 16)), 16, None),
        Platform("in_drop_v4", (-1, 8), lambda: _fixed(cell=F.concat(_cut(_barcode(), 0, 8), _cut(_barcode(), 12, 20)), rmt=_cut(_barcode(), 20, 28), poly_t=_cut(_barcode(), 28)), 28, "in_drop", 2, True),
        Platform("drop_seq", (12,), lambda: _fixed(cell=_cut(_barcode(), 0, 12), rmt=_cut(_barcode(), 12, 20), poly_t=_cut(_barcode(), 20, -1)), 20, "drop_seq"),
        Platform("mars1_seq", (4, 8), lambda: _fixed(pool=F.element_at(_name_fields(), -3), cell=F.element_at(_name_fields(), -2), rmt=F.element_at(_name_fields(), -1)), None, "in_drop", 0, lonely_triplets=True, low_count=False),
        Platform("mars2_seq", (4, 8), lambda: _fixed(cell=F.concat(_cut(F.trim("g_sequence"), 5, 9), _cut(_barcode(), 0, 7)), rmt=_cut(_barcode(), 7, 15), poly_t=_cut(_barcode(), 15)), 15, "in_drop", 0, lonely_triplets=True, low_count=False),
        Platform("mars_germany", (10,), lambda: _fixed(cell=F.concat(_cut(F.trim("g_sequence"), 3, 7), _cut(_barcode(), 0, 6)), rmt=_cut(_barcode(), 6, 12)), 15, "in_drop", 0, lonely_triplets=True, low_count=False, trim=7),
        Platform("ten_x", (14,), lambda: _fixed(cell=_cut(F.trim("g_name"), -23, -9), rmt=_cut(_barcode(), 0, 10), poly_t=_cut(_barcode(), 10)), 10, "ten_x", tag_correction=True, tag_rate=0.02),
        Platform("ten_x_v2", (16,), lambda: _fixed(cell=_cut(_barcode(), 0, 16), rmt=_cut(_barcode(), 16, 26), poly_t=_cut(_barcode(), 26)), 26, "ten_x", tag_correction=True, tag_rate=0.02),
    )
}


def platform(name: str) -> Platform | None:
    return PLATFORMS.get(name)


def annotate(pairs: DataFrame, name: str) -> DataFrame:
    """pairs with pool, cell, rmt and poly_t as sequences."""
    p = PLATFORMS[name]
    out = pairs.withColumns(p.fields())
    return out.withColumns({c: F.substr(c, F.lit(p.trim + 1), F.greatest(F.length(c) - p.trim, F.lit(0))) for c in ("g_sequence", "g_quality") if p.trim and c in pairs.columns})


def merge_fastq(genomic: DataFrame, barcode: DataFrame, name: str) -> DataFrame:
    """Annotated genomic records: the nth genomic record with the nth barcode record, as far as both go."""
    g = genomic.select("ord", *[F.col(c).alias(f"g_{c}") for c in ("name", "sequence", "name2", "quality")])
    pairs = annotate(g.join(barcode.select("ord", F.col("sequence").alias("b_sequence")), "ord"), name)
    label = F.concat(F.lit("@"), F.concat_ws(":", "pool", "cell", "rmt", "poly_t"), F.lit(";"), F.regexp_replace("g_name", "^@", ""))
    return pairs.select("ord", label.alias("name"), F.col("g_sequence").alias("sequence"), F.col("g_name2").alias("name2"), F.col("g_quality").alias("quality"))


def min_poly_t(mean_lengths: list[float], name: str) -> int:
    """Poly-T bases to require, from the mean length of each barcode file."""
    primer = PLATFORMS[name].primer_length
    if primer is None:
        raise RuntimeError(f"{name} has no primer length")
    return min(int(min(0.8 * max(0.0, m - primer), 20)) for m in mean_lengths)
