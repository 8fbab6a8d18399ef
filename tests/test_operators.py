import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.functions import dna
from cellweave.operators import annotation, barcodes, cellqc, counts, graph, platforms, reads, rmt, stats, testing

READ = "read_id long, status int, cell long, rmt long, n_poly_t int, alignments array<struct<gene:int,position:int>>"


def code(s):
    value = 0
    for b in s:
        value = value * 8 + dna.CODES[b]
    return value


def test_initial_status(spark):
    rows = spark.createDataFrame([(1, 0, 5, 0, 0, [(3, 1)]), (2, 0, 5, 5, 2, []), (3, 0, 5, 5, 2, [(3, 1), (3, 9)]), (4, 0, 5, 5, 2, [(3, 1)]), (5, 0, None, 5, None, None)], READ)
    got = {r["read_id"]: r["status"] for r in reads.initial_status(rows).collect()}
    assert got == {1: 40, 2: 1, 3: 16, 4: 0, 5: 1 | 32 | 8}


def test_multimapping(spark):
    rows = [(1, 16 * (len(g) > 1), c, 7, 5, [(x, x * 10) for x in g]) for c, g in [(1, [1]), (1, [2, 1]), (2, [1]), (2, [2]), (3, [1, 2]), (4, [1, 2]), (4, [2, 3]), (4, [1, 3])]]
    table, outcomes = reads.resolve_multimapping(spark.createDataFrame(rows, READ))
    assert {r["outcome"]: r["n"] for r in outcomes.collect()} == {"collisions": 3, "model": 1, "disjoint": 2, "unique": 1, "ambiguous": 1}
    assert sorted((r["status"], r["gene"], r["position"]) for r in table.where("cell = 1").collect()) == [(0, 1, 10), (0, 1, 10)]
    assert [r["status"] for r in table.where("cell = 3").collect()] == [16]


def test_count_matrix_and_tag_errors(spark):
    base, near = code("AAAA"), code("AAAC")
    live = spark.createDataFrame([(0, 1, 1, base, 1)] * 10 + [(0, 1, 1, near, 1), (1, 1, 1, near, 1)], "status int, cell long, gene int, rmt long, position int")
    got = rmt.tag_errors(live).where(F.col("rmt") == near).first()
    assert abs(got["p"] - 0.181269) < 1e-6 and got["is_error"] and got["donor"] == base
    twice = live.unionByName(spark.createDataFrame([(0, 1, 1, near, 1)], live.schema))
    again = rmt.tag_errors(twice).where(F.col("rmt") == near).first()
    assert abs(again["p"] - 0.017523) < 1e-6 and not again["is_error"]
    fixed = rmt.flag_tag_errors(live)
    assert counts.count_matrix(fixed).first().asDict() == {"cell": 1, "gene": 1, "n_reads": 10, "n_molecules": 1}


def test_tenx_ties_go_to_the_earlier_neighbour(spark):
    rows = spark.createDataFrame([(0, code(s)) for s in ["AC"] * 5 + ["AG"] * 5 + ["AT", "TT"]], "status int, cell long")
    white = spark.createDataFrame([(code(s),) for s in ("AC", "AG", "CC")], "barcode long")
    got = {r["cell"]: r["corrected"] for r in barcodes.tenx_corrections(rows, white).collect()}
    assert got == {code("AC"): code("AC"), code("AG"): code("AG"), code("AT"): code("AC"), code("TT"): None}
    flagged = barcodes.apply_corrections(rows, barcodes.tenx_corrections(rows, white))
    assert {r["status"] for r in flagged.where(F.col("cell") == code("TT")).collect()} == {4}


def test_dropseq_repair(spark):
    tags = [a + b + "T" for a in "ACGT" for b in "ACG"]
    rows = spark.createDataFrame([(0, code("AAA" + last), code(t)) for t in tags for last in "AC"], "status int, cell long, rmt long")
    fixed = barcodes.repair_shift(rows)
    assert {r["cell"] for r in fixed.select("cell").distinct().collect()} == {code("AAAN")}
    assert {dna_text(r["rmt"]) for r in fixed.collect()} == {last + t[:2] for t in tags for last in "AC"}
    biased = spark.createDataFrame([(0, 9, code("A" + a + b)) for a in "ACGT" for b in "ACG"], "status int, cell long, rmt long")
    assert [r["cell"] for r in barcodes.biased_cells(biased).collect()] == [9]


def dna_text(x):
    out = ""
    while x:
        out, x = "  |T|A|G|C|N".split("|")[{3: 1, 4: 2, 5: 3, 6: 4, 7: 5}[x & 7]] + out, x >> 3
    return out


def test_intervals_and_exons(spark):
    places = spark.createDataFrame([(i, "c", "+", p) for i, p in enumerate((12, 16, 30, 9))], "i int, chrom string, strand string, pos long")
    genes = spark.createDataFrame([("c", "+", 10, 20, 1), ("c", "+", 15, 30, 2)], "chrom string, strand string, start long, end long, gene int")
    assert [r["gene"] for r in annotation.genes_at(places, genes, ["i"], 8).orderBy("i").collect()] == [1, None, None, None]
    exons = spark.createDataFrame([(1, "+", 0, 100, 600), (1, "+", 1, 800, 1500), (2, "-", 0, 800, 1500), (2, "-", 1, 100, 600)], "transcript int, strand string, ord int, start long, end long")
    got = [(r["start"], r["end"]) for r in annotation.truncated_exons(exons).orderBy("transcript", "rank").collect()]
    assert got == [(800, 1500), (300, 600), (100, 600), (800, 1300)]
    row = spark.range(1).select(annotation.string_gene_id(F.lit(3)).alias("s"), annotation.integer_gene_id(F.lit("ENSG00000000003.14")).alias("i")).first()
    assert row["s"] == "ENSG00000000003" and row["i"] == 3


def test_layouts(spark):
    spacer = platforms.SPACERS[8]
    seq = "ACGTACGTA" + spacer + "CCCCGGGG" + "AAAACCCC" + "TTTTT"
    wrong = "ACGTACGTAC" + spacer[:3] + "AA" + spacer[5:14] + "AAA" + spacer[17:] + "CCCCGGGG" + "AAAACCCC" + "TTTTT"
    pairs = spark.createDataFrame([(0, "@x:P:C1:R1", "ACGTACGTACGT", "FFFFFFFFFFFF", seq), (1, "@x", "A", "F", wrong), (2, "@x", "A", "F", "ACGT")], "i int, g_name string, g_sequence string, g_quality string, b_sequence string")
    got = [(r["cell"], r["rmt"], r["poly_t"]) for r in platforms.annotate(pairs, "in_drop_v2").orderBy("i").collect()]
    assert got[0] == ("ACGTACGTACCCCGGGG", "AAAACCCC", "TTTTT") and got[2] == ("", "", "")
    v2 = platforms.annotate(pairs, "ten_x_v2").where("i = 0").first()
    assert (v2["cell"], v2["rmt"], v2["poly_t"]) == (seq[:16], seq[16:26], seq[26:])
    mars = platforms.annotate(pairs, "mars1_seq").where("i = 0").first()
    assert (mars["pool"], mars["cell"], mars["rmt"]) == ("P", "C1", "R1")
    german = platforms.annotate(pairs, "mars_germany").where("i = 0").first()
    assert german["cell"] == "TACG" + seq[:6] and german["g_sequence"] == "TACGT" and german["g_quality"] == "FFFFF"
    assert platforms.min_poly_t([50.0], "ten_x_v2") == 19 and platforms.platform("none") is None
    with pytest.raises(RuntimeError):
        platforms.min_poly_t([50.0], "mars1_seq")


def test_bh_and_distances(spark):
    rows = spark.createDataFrame([(p,) for p in (0.01, 0.02, 0.03, 0.5)], "p double")
    assert [round(r["q"], 6) for r in testing.bh_adjust(rows).orderBy("p").collect()] == [0.04, 0.04, 0.04, 0.5]
    pq = spark.createDataFrame([("a", 1, 1.0), ("b", 2, 1.0)], "key string, feature int, p double")
    assert stats.jensen_shannon(pq).first()["distance"] == 1.0
    x = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    assert [r[0] for r in x.select(stats.linear_scale(x, "v")).collect()] == [-1.0, 0.0, 1.0]


def test_cell_filters(spark):
    c = spark.createDataFrame([(1, 0, 60, 30), (1, 5, 140, 70), (2, 5, 200, 100), (3, 6, 100, 50)], "cell long, gene int, n_reads long, n_molecules long")
    sizes = cellqc.cell_sizes(c, F.col("gene") < 2)
    assert {r["cell"]: r["high_mt"] for r in cellqc.high_mitochondrial(sizes).collect()} == {1: True, 2: False, 3: False}
    assert cellqc.saturation(c).first()["saturation"] == 50.0
    with pytest.raises(cellqc.EmptyMatrixError):
        cellqc.filter_cells(c.where("cell > 9"))
    with pytest.raises(ValueError):
        cellqc.high_mitochondrial(sizes, 1.5)


def test_low_coverage_splits_two_groups(spark):
    rows = [(i, 100 + i % 7, 90 + i % 5, 10) for i in range(40)] + [(100 + i, 900 + 3 * i, 60, 10) for i in range(30)]
    sizes = spark.createDataFrame(rows, "cell long, n_reads long, n_molecules long, n_genes long")
    got = {r["cell"] for r in cellqc.low_coverage(sizes).where("low_coverage").collect()}
    assert got == set(range(100, 130))


def test_graph(spark):
    v = spark.createDataFrame([(i, [float(i // 3 * 10 + i % 3), 0.0]) for i in range(6)], "cell long, vector array<double>")
    edges = graph.neighbours(v, 3)
    assert {(r["src"], r["dst"]) for r in edges.collect()} == {(i, j) for i in range(6) for j in range(6) if i // 3 == j // 3}
    groups = graph.communities(graph.jaccard_edges(edges))
    assert {r["cell"]: r["cluster"] for r in groups.collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3}
    values, projected = graph.pca(v, 1)
    assert len(projected.collect()) == 6 and values[0] > 20
    tree = spark.createDataFrame([(4, 0), (4, 1), (5, 4), (5, 2)], "parent long, child long")
    assert {(r["node"], r["ancestor"]) for r in graph.tree_paths(tree).collect()} == {(0, 0), (1, 1), (2, 2), (4, 4), (5, 5), (0, 4), (1, 4), (4, 5), (2, 5), (0, 5), (1, 5)}
    w = graph.normalise(graph.affinity(edges), "smarkov")
    top, _ = graph.eigenpairs(w, k=2, rounds=30)
    assert abs(top[0] - 1) < 1e-6


def test_distances_of_wanted_pairs(spark):
    rng = np.random.default_rng(2)
    p = rng.random((5, 6)) * (rng.random((5, 6)) < 0.6) + 1e-3
    p /= p.sum(axis=1, keepdims=True)
    rows = spark.createDataFrame([(k, f, float(p[k, f])) for k in range(5) for f in range(6)], "key int, feature int, p double")
    every = {(r["a"], r["b"]): r["distance"] for r in stats.jensen_shannon(rows).collect()}
    assert len(every) == 10
    wanted = spark.createDataFrame([(0, 3), (3, 0), (0, 3), (2, 2), (1, 9)], "a int, b int")
    got = {(r["a"], r["b"]): r["distance"] for r in stats.jensen_shannon(rows, wanted).collect()}
    assert set(got) == {(0, 3), (3, 0), (2, 2)}
    assert abs(got[0, 3] - every[0, 3]) < 1e-9 and abs(got[3, 0] - every[0, 3]) < 1e-9 and got[2, 2] < 1e-6
