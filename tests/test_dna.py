from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellweave.functions import dna, special, status


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_known_values(spark):
    row = one(spark, e=dna.encode(F.lit("ACGTN")), d=dna.decode(F.lit(19807).cast("long")), h=dna.hamming(F.lit(19807).cast("long"), F.lit(19805).cast("long")), u=dna.hamming(F.lit(38).cast("long"), F.lit(4).cast("long")), n=dna.neighbours(F.lit(38).cast("long")), z=dna.encode(F.lit("")), dz=dna.decode(F.lit(0).cast("long")), c=dna.concat(F.lit(38).cast("long"), F.lit(5).cast("long")))
    assert row.asDict() == {"e": 19807, "d": "ACGTN", "h": 1, "u": None, "n": [36, 37, 35, 39, 54, 46, 30, 62], "z": 0, "dz": "", "c": 38 * 8 + 5}


def test_errors_and_rates(spark):
    a, b = dna.encode(F.lit("ACGT")), dna.encode(F.lit("ACTA"))
    row = one(spark, e=dna.errors(b, a), p=dna.conversion_probability(a, b, 0.02), q=dna.conversion_probability(a, F.lit(4).cast("long"), 0.02), t=dna.conversion_probability_table(a, b, F.create_map(F.lit(34), F.lit(0.5))))
    assert [tuple(x) for x in row["e"]] == [(3, 4), (5, 3)]
    assert abs(row["p"] - 0.0004) < 1e-12 and row["q"] == 1.0 and abs(row["t"] - 0.5 * 0.02) < 1e-12


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ACGTN", min_size=1, max_size=21), min_size=1, max_size=20))
def test_round_trip(spark, seqs):
    rows = spark.createDataFrame([(s,) for s in seqs], "s string").select("s", dna.encode(F.col("s").alias("s")).alias("p")).select("s", dna.decode(F.col("p")).alias("d"), dna.seq_len(F.col("p")).alias("n"), dna.count_base(F.col("p"), "T").alias("t"), dna.contains(F.col("p"), "N").alias("c"))
    for r in rows.collect():
        assert r["d"] == r["s"] and r["n"] == len(r["s"]) and r["t"] == r["s"].count("T") and r["c"] == ("N" in r["s"])


def test_status_mask():
    assert status.mask() == 255 and status.mask("gene_not_unique") == 239


def test_special_functions():
    assert abs(float(special.gammainc(3, 2.5)) - 0.456187) < 1e-6
    assert abs(float(special.gammainc(1, 0.2)) - 0.181269) < 1e-6
    assert abs(float(special.chi2_tail(3.841459, 1)) - 0.05) < 1e-6
    assert abs(float(special.student_two_sided(2.228139, 10)) - 0.05) < 1e-6
    assert abs(float(special.normal_two_sided(1.959964)) - 0.05) < 1e-6
    assert abs(special.hypergeom_tail([1], [10], [4], [5])[0] - (1 - (6 * 1 + 4 * 15) / 252)) < 1e-9
