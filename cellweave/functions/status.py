"""Read status: a bit for each failure; 0 is an active read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The failures' bits.
FLAGS = {"no_gene": 1, "rmt_error": 2, "cell_error": 4, "low_polyt": 8, "gene_not_unique": 16, "primer_missing": 32, "lonely_triplet": 64}


def mask(*ignore: str) -> int:
    """All bits but those of the named failures; an unknown name is a KeyError."""
    out = 255
    for name in ignore:
        out &= 255 ^ FLAGS[name]
    return out


def passes(status: Column, *ignore: str) -> Column:
    return status.bitwiseAND(F.lit(mask(*ignore))) == 0


def flagged(status: Column, name: str) -> Column:
    return status.bitwiseAND(F.lit(FLAGS[name])) != 0


def with_flag(status: Column, name: str, when: Column) -> Column:
    return F.when(when, status.bitwiseOR(F.lit(FLAGS[name]))).otherwise(status)
