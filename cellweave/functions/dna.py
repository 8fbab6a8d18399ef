"""Packed DNA: three bits a base, first base highest, no zero symbol, so that a value tells its length.

In octal a packed sequence has one digit for each base, so packing and unpacking are a translation
of symbols and a change of number base, and run inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of the bases, in octal digits.
BASES, DIGITS = "ACGTN", "46537"
CODES = {"A": 4, "C": 6, "G": 5, "T": 3, "N": 7}
BITS_PER_BASE = 3
#: The lowest bit of each of 21 bases.
LOW_BITS = 0o111111111111111111111


def octal(packed: Column) -> Column:
    """One digit for each base; the empty string for 0."""
    return F.when(packed == 0, F.lit("")).otherwise(F.conv(packed.cast("string"), 10, 8))


def encode(sequence: Column) -> Column:
    """A sequence of at most 21 bases as a packed long, in either letter case; other symbols raise an error."""
    digits = F.translate(F.upper(sequence), BASES, DIGITS)
    sound = digits.rlike("^[34567]*$") & (F.length(digits) <= 21) & ~F.upper(sequence).rlike("[0-9]")
    packed = F.coalesce(F.conv(F.when(digits != "", digits), 8, 10).cast("long"), F.lit(0).cast("long"))
    return F.when(sequence.isNull(), F.lit(None).cast("long")).when(sound, packed).otherwise(F.raise_error(F.concat(F.lit("not a DNA sequence: "), sequence)).cast("long"))


def decode(packed: Column) -> Column:
    """The sequence of a packed value; negative values raise an error."""
    return F.when(packed < 0, F.raise_error(F.lit("negative packed sequence")).cast("string")).otherwise(F.translate(octal(packed), DIGITS, BASES))


def seq_len(packed: Column) -> Column:
    return F.length(octal(packed))


def contains(packed: Column, base: str) -> Column:
    return F.instr(octal(packed), str(CODES[base.upper()])) > 0


def count_base(packed: Column, base: str) -> Column:
    digit = str(CODES[base.upper()])
    return F.length(octal(packed)) - F.length(F.replace(octal(packed), F.lit(digit), F.lit("")))


def concat(*parts: Column) -> Column:
    """Packed values joined to one; at most 21 bases together."""
    joined = F.concat(*[octal(p) for p in parts])
    return F.coalesce(F.conv(F.when(joined != "", joined), 8, 10).cast("long"), F.lit(0).cast("long"))


def hamming(a: Column, b: Column) -> Column:
    """Number of places that differ; null for unequal lengths."""
    x = a.bitwiseXOR(b)
    places = x.bitwiseOR(F.shiftright(x, 1)).bitwiseOR(F.shiftright(x, 2)).bitwiseAND(F.lit(LOW_BITS))
    return F.when(seq_len(a) == seq_len(b), F.bit_count(places).cast("int"))


def base_at(packed: Column, place: Column) -> Column:
    """Code of the base ``place`` bases from the end."""
    return F.call_function("shiftright", packed, (place * 3).cast("int")).bitwiseAND(F.lit(7).cast("long"))


def neighbours(packed: Column) -> Column:
    """All values at distance one: places from the last base on, and at each A, C, G, T, N without its own."""
    codes = F.array(*[F.lit(CODES[b]).cast("long") for b in BASES])

    def at(place: Column) -> Column:
        own = base_at(packed, place)
        return F.transform(F.filter(codes, lambda c: c != own), lambda c: packed.bitwiseXOR(F.call_function("shiftleft", own.bitwiseXOR(c), (place * 3).cast("int"))))

    return F.when(packed > 0, F.flatten(F.transform(F.sequence(F.lit(0), seq_len(packed) - 1), at))).otherwise(F.array().cast("array<bigint>"))


def errors(wrong: Column, right: Column) -> Column:
    """Differing places as struct(from_b, to_b) from the last base on: the right base's code and the wrong one's."""
    places = F.transform(F.sequence(F.lit(0), F.greatest(seq_len(right) - 1, F.lit(0))), lambda i: F.struct(base_at(right, i).cast("int").alias("from_b"), base_at(wrong, i).cast("int").alias("to_b")))
    return F.filter(places, lambda e: e["from_b"] != e["to_b"])


def conversion_probability(donor: Column, target: Column, rate: float | Column) -> Column:
    """Probability of reading target for donor at one rate for every error; 1 for unequal lengths."""
    return F.coalesce(F.pow(F.lit(rate) if isinstance(rate, float) else rate, hamming(donor, target)), F.lit(1.0))


def conversion_probability_table(donor: Column, target: Column, rates: Column, default: float = 0.02) -> Column:
    """As above with a map from 10 * from + to to a rate; missing rates are the default."""
    product = F.aggregate(errors(target, donor), F.lit(1.0), lambda a, e: a * F.coalesce(F.element_at(rates, e["from_b"] * 10 + e["to_b"]), F.lit(default)))
    return F.when(seq_len(donor) == seq_len(target), product).otherwise(1.0)
