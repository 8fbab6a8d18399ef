"""Named queries of the engine over the driver's tables, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.functions import dna
from cellweave.functions import status as S
from cellweave.operators import annotation, barcodes, cellqc, embedding, graph, panels, platforms, rmt, stats, testing
from cellweave.operators import counts as C
from cellweave.operators import reads as R
from cellweave.sources import readers

from .views import DNA_READS, INTERVALS, READS, alignments, counts, dna_reads, intervals, labels, packed, packed_sql, reads, sequence, sequence_sql, table, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# ---- read table and counts


@query(f"WITH {READS} SELECT cell, gene, n_reads, n_molecules FROM counts")
def count_matrix(spark, d):
    return counts(spark, d)


@query(f"WITH {READS} SELECT cell, CAST(sum(n_molecules) AS BIGINT) AS total, count(*) AS nonzero FROM counts GROUP BY cell")
def molecule_count_by_cell(spark, d):
    return C.axis_sums(counts(spark, d), "cell")


@query(f"WITH {READS} SELECT status, count(*) AS n FROM reads GROUP BY status")
def status_initial_filter(spark, d):
    return reads(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {READS}, f(failure, bit) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in S.FLAGS.items())})
SELECT failure, count(*) FILTER (WHERE (status & bit) <> 0) AS n_reads, round(count(*) FILTER (WHERE (status & bit) <> 0) * 100.0 / greatest(count(*), 1), 6) AS percent FROM reads, f GROUP BY failure""")
def status_summary(spark, d):
    return R.status_counts(reads(spark, d))


@query(f"WITH {READS} SELECT cell, rmt, gene, position, count(*) AS n FROM reads WHERE (status & (255 ^ 16)) = 0 GROUP BY ALL".replace("255 ^ 16", "239"))
def active_reads(spark, d):
    return R.active(reads(spark, d), "gene_not_unique").groupBy("cell", "rmt", "gene", "position").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {READS}, a AS (SELECT DISTINCT cell, dense_rank() OVER (ORDER BY cell) AS r FROM counts), b AS (SELECT DISTINCT gene, dense_rank() OVER (ORDER BY gene) AS c FROM counts) SELECT r AS row, c AS col, n_molecules AS value FROM counts JOIN a USING (cell) JOIN b USING (gene)")
def matrix_market_coords(spark, d):
    return C.coordinates(counts(spark, d))


@query(f"WITH {READS} SELECT DISTINCT dense_rank() OVER (ORDER BY cell) - 1 AS idx, cell FROM counts")
def barcode_index(spark, d):
    return C.axis_index(counts(spark, d), "cell")


@query(f"WITH {READS} SELECT cell % 3 AS cluster, cell, " + ", ".join(f'CAST(coalesce(sum(n_molecules) FILTER (WHERE gene = {g}), 0) AS BIGINT) AS "{g}"' for g in range(1, 6)) + " FROM counts GROUP BY cell")
def dense_export(spark, d):
    c = counts(spark, d)
    return C.dense(c, list(range(1, 6)), labels=c.select("cell").distinct().withColumn("cluster", F.col("cell") % 3))


@query("""SELECT CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS sample_number, l_suppkey AS cell, l_partkey % 20 AS gene, count(*) AS n_reads
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'O', 'P') GROUP BY ALL""")
def merge_samples(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    each = [rows.where(F.col("o_orderstatus") == s).groupBy(F.col("l_suppkey").alias("cell"), (F.col("l_partkey") % 20).alias("gene")).agg(F.count(F.lit(1)).alias("n_reads")) for s in ("F", "O", "P")]
    return C.merge_samples(*each)


@query("""SELECT o_orderstatus AS sample, l_suppkey % 4 AS cluster, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 2) AS share
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderstatus, l_suppkey % 4""")
def cluster_composition(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return C.composition(rows.select(F.col("o_orderstatus").alias("sample"), (F.col("l_suppkey") % 4).alias("cluster")))


# ---- packed DNA


@query(f"SELECT DISTINCT {sequence_sql('l_orderkey % 1024', 5)} AS seq, {packed_sql('l_orderkey % 1024', 5)} AS packed FROM lineitem")
def dna_encode(spark, d):
    return table(spark, d, "lineitem").select(sequence((F.col("l_orderkey") % 1024).cast("long"), 5).alias("seq")).distinct().withColumn("packed", dna.encode(F.col("seq")))


@query(f"SELECT DISTINCT {packed_sql('l_orderkey % 1024', 5)} AS packed, {sequence_sql('l_orderkey % 1024', 5)} AS seq, 5 AS bases, length({sequence_sql('l_orderkey % 1024', 5)})::INTEGER - length(replace({sequence_sql('l_orderkey % 1024', 5)}, 'T', ''))::INTEGER AS n_t FROM lineitem")
def dna_decode(spark, d):
    p = table(spark, d, "lineitem").select(packed((F.col("l_orderkey") % 1024).cast("long"), 5).alias("packed")).distinct()
    return p.select("packed", dna.decode(F.col("packed")).alias("seq"), dna.seq_len(F.col("packed")).alias("bases"), dna.count_base(F.col("packed"), "T").alias("n_t"))


@query(f"""WITH p AS (SELECT {sequence_sql('l_orderkey % 256', 4)} AS a, {sequence_sql('l_partkey % 256', 4)} AS b FROM lineitem)
SELECT a, b, count(*) AS n, CAST(sum(0) + {" + ".join(f"max(CASE WHEN substr(a, {i}, 1) <> substr(b, {i}, 1) THEN 1 ELSE 0 END)" for i in range(1, 5))} AS INTEGER) AS distance FROM p GROUP BY a, b""")
def dna_hamming(spark, d):
    c = F.col
    rows = table(spark, d, "lineitem").groupBy(packed((c("l_orderkey") % 256).cast("long"), 4).alias("x"), packed((c("l_partkey") % 256).cast("long"), 4).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(dna.decode(c("x")).alias("a"), dna.decode(c("y")).alias("b"), "n", dna.hamming(c("x"), c("y")).alias("distance"))


@query(f"SELECT DISTINCT {packed_sql('l_suppkey', 4)} AS cell, {packed_sql('l_suppkey', 2)} AS first, {packed_sql('l_suppkey >> 4', 2)} AS second FROM lineitem")
def extract_barcodes(spark, d):
    first, second = barcodes.split_barcode(F.col("cell"), (-1, 2))
    return dna_reads(spark, d).select("cell").distinct().select("cell", first.alias("first"), second.alias("second"))


# ---- annotation


@query(f"""WITH {INTERVALS}, k AS (SELECT DISTINCT chrom, strand, pos FROM al), g AS (SELECT k.*, CASE WHEN count(DISTINCT gene) = 1 THEN min(gene) END AS gene FROM k LEFT JOIN iv ON iv.chrom = k.chrom AND iv.strand = k.strand AND pos >= s AND pos < e GROUP BY ALL)
SELECT al.chrom, al.strand, al.pos, CAST(g.gene AS INTEGER) AS gene, count(*) AS n FROM al JOIN g ON al.chrom = g.chrom AND al.strand = g.strand AND al.pos = g.pos GROUP BY ALL""".replace("iv.strand = k.strand AND pos >= s AND pos < e GROUP BY ALL)", "iv.strand = k.strand AND pos >= s AND pos < e GROUP BY k.chrom, k.strand, k.pos)"))
def interval_translate(spark, d):
    found = annotation.genes_at(alignments(spark, d), intervals(spark, d), ["l_orderkey"], bin_size=64)
    return found.groupBy("chrom", "strand", "pos", "gene").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH x AS (SELECT p_partkey // 5 AS transcript, CASE WHEN (p_partkey // 5) % 2 = 0 THEN '+' ELSE '-' END AS strand, p_partkey AS ord, p_partkey * 100 AS s, p_partkey * 100 + p_size * 10 AS e FROM part),
y AS (SELECT *, 1000 - (sum(e - s) OVER w - (e - s)) AS rest, row_number() OVER w AS rank FROM x WHERE e > s WINDOW w AS (PARTITION BY transcript ORDER BY ord DESC))
SELECT transcript, strand, CAST(rank AS INTEGER) AS rank, CAST(CASE WHEN e - s >= rest AND strand = '+' THEN e - rest ELSE s END AS BIGINT) AS start, CAST(CASE WHEN e - s >= rest AND strand = '-' THEN s + rest ELSE e END AS BIGINT) AS "end" FROM y WHERE rest > 0""")
def exon_truncation(spark, d):
    k = F.col("p_partkey")
    t = F.floor(k / 5)
    exons = table(spark, d, "part").select(t.alias("transcript"), F.when(t % 2 == 0, "+").otherwise("-").alias("strand"), k.alias("ord"), (k * 100).alias("start"), (k * 100 + F.col("p_size") * 10).cast("long").alias("end"))
    return annotation.truncated_exons(exons, 1000)


@query("""SELECT 'ENSG' || lpad(CAST(p_partkey % 50 AS VARCHAR), 11, '0') AS gene_id, array_to_string(list_sort(list(DISTINCT upper('g' || CAST(p_partkey % 7 AS VARCHAR)))), '-') AS symbol, p_partkey % 50 AS gene FROM part GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY p_partkey % 50"))
def symbol_map(spark, d):
    k = F.col("p_partkey")
    rows = table(spark, d, "part").select(F.lit("gene").alias("feature"), (k % 50).alias("gene"), F.concat(F.lit("g"), (k % 7).cast("string")).alias("name"))
    named = annotation.gene_symbols(rows).withColumn("gene_id", annotation.string_gene_id(F.col("gene")))
    return named.select("gene_id", "symbol", annotation.integer_gene_id(F.concat("gene_id", F.lit(".3"))).alias("gene"))


@query("""SELECT p_partkey, 'G' || CAST(p_partkey % 40 AS VARCHAR) AS gene_id FROM part WHERE p_size % 3 <> 0 AND p_partkey % 40 IN (SELECT s_suppkey % 40 FROM supplier WHERE s_suppkey % 2 = 0)""")
def gene_subset(spark, d):
    kind = F.when(F.col("p_size") % 3 == 1, "protein_coding").when(F.col("p_size") % 3 == 2, "lincRNA").otherwise("pseudogene")
    rows = table(spark, d, "part").select("p_partkey", F.concat(F.lit("G"), (F.col("p_partkey") % 40).cast("string")).alias("gene_id"), kind.alias("biotype"))
    k = F.col("s_suppkey")
    ids = table(spark, d, "supplier").select(F.concat(F.lit("G"), (k % 40).cast("string")).alias("gene_id"), F.when(k % 2 == 0, k).alias("entrez"))
    return annotation.gene_subset(rows, ids).select("p_partkey", "gene_id")


# ---- barcodes and tags

WHITE = f"white AS (SELECT DISTINCT {packed_sql('l_suppkey', 4)} AS barcode FROM lineitem WHERE l_suppkey % 2 = 0)"


def _white(spark, d):
    return table(spark, d, "lineitem").where("l_suppkey % 2 = 0").select(packed(F.col("l_suppkey").cast("long"), 4).alias("barcode")).distinct()


def _distance(a: str, b: str, n: int) -> str:
    return "(" + " + ".join(f"CASE WHEN (({a}) >> {3 * i}) & 7 <> (({b}) >> {3 * i}) & 7 THEN 1 ELSE 0 END" for i in range(n)) + ")"


@query(f"WITH {DNA_READS}, {WHITE} SELECT cell, count(*) AS n FROM dna_reads WHERE cell IN (SELECT barcode FROM white) GROUP BY cell")
def barcode_exact_whitelist(spark, d):
    near = barcodes.nearest_in_whitelist(dna_reads(spark, d).select(F.col("cell").alias("barcode")), _white(spark, d), 0)
    return dna_reads(spark, d).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).join(near.select(F.col("correct").alias("cell")), "cell")


@query(f"""WITH {DNA_READS}, {WHITE}, cells AS (SELECT DISTINCT cell FROM dna_reads), c AS (SELECT cell, barcode, {_distance('cell', 'barcode', 4)} AS distance FROM cells, white)
SELECT cell AS barcode, arg_min(barcode, distance * 100000 + barcode) AS correct, CAST(min(distance) AS INTEGER) AS distance FROM c WHERE distance <= 2 GROUP BY cell""")
def barcode_nearest_whitelist(spark, d):
    return barcodes.nearest_in_whitelist(dna_reads(spark, d).select(F.col("cell").alias("barcode")), _white(spark, d), 2)


@query(f"""WITH {DNA_READS}, {WHITE}, n AS (SELECT cell, count(*) AS n FROM dna_reads GROUP BY cell),
ok AS (SELECT n.* FROM n JOIN white ON cell = barcode), bad AS (SELECT * FROM n WHERE cell NOT IN (SELECT barcode FROM white)),
near AS (SELECT bad.cell, ok.cell AS near, ok.n, list_max([CASE WHEN (bad.cell >> (3 * i)) & 7 <> (ok.cell >> (3 * i)) & 7 THEN i * 10 + [9, 9, 9, 4, 1, 3, 2, 5][((ok.cell >> (3 * i)) & 7) + 1] ELSE -1 END FOR i IN range(4)]) AS ord FROM bad, ok WHERE {_distance('bad.cell', 'ok.cell', 4)} = 1)
SELECT cell, cell AS corrected FROM ok UNION ALL SELECT bad.cell, (SELECT arg_max(near, n * 1000 - ord) FROM near WHERE near.cell = bad.cell) FROM bad""")
def barcode_tenx_correction(spark, d):
    return barcodes.tenx_corrections(dna_reads(spark, d), _white(spark, d))


INDROP = f"""cells AS (SELECT DISTINCT cell, cell >> 6 AS p, cell & 63 AS q FROM dna_reads),
wp AS (SELECT DISTINCT {packed_sql('l_suppkey', 2)} AS w FROM lineitem WHERE l_suppkey % 4 <> 1), wq AS (SELECT DISTINCT {packed_sql('l_suppkey >> 4', 2)} AS w FROM lineitem WHERE (l_suppkey >> 4) % 2 = 0),
np AS (SELECT p, arg_min(w, d * 1000 + w) AS c, min(d) AS d FROM (SELECT DISTINCT p, w, {_distance('p', 'w', 2)} AS d FROM cells, wp) GROUP BY p),
nq AS (SELECT q, arg_min(w, d * 1000 + w) AS c, min(d) AS d FROM (SELECT DISTINCT q, w, {_distance('q', 'w', 2)} AS d FROM cells, wq) GROUP BY q),
fixed AS (SELECT cell, CASE WHEN np.d <= 1 AND nq.d <= 1 THEN np.c * 64 + nq.c END AS corrected, CASE WHEN np.d <= 1 AND nq.d <= 1 THEN CAST(np.d + nq.d AS INTEGER) END AS total FROM cells JOIN np USING (p) JOIN nq USING (q))"""


def _indrop(spark, d):
    c = F.col
    rows = table(spark, d, "lineitem")
    first = rows.where("l_suppkey % 4 <> 1").select(packed(c("l_suppkey").cast("long"), 2).alias("barcode")).distinct()
    second = rows.where("shiftright(l_suppkey, 4) % 2 = 0").select(packed(F.shiftright(c("l_suppkey").cast("long"), 4), 2).alias("barcode")).distinct()
    return barcodes.indrop_corrections(dna_reads(spark, d), [first, second], (-1, 2), 1)


@query(f"WITH {DNA_READS}, {INDROP} SELECT cell, corrected, total FROM fixed")
def barcode_indrop_correction(spark, d):
    return _indrop(spark, d)


@query(f"""WITH {DNA_READS}, {INDROP}, b(code) AS (VALUES (4), (6), (5), (3), (7)),
e AS (SELECT (corrected >> (3 * i)) & 7 AS from_b, (cell >> (3 * i)) & 7 AS to_b, total FROM fixed, range(4) t(i) WHERE corrected IS NOT NULL),
n AS (SELECT from_b, to_b, sum(CASE WHEN from_b = to_b OR total = 1 THEN 1 ELSE 0 END) AS n FROM e GROUP BY ALL),
f AS (SELECT x.code AS from_b, y.code AS to_b, coalesce(n, 0) AS n FROM b x CROSS JOIN b y LEFT JOIN n ON from_b = x.code AND to_b = y.code), g AS (SELECT *, sum(n) OVER (PARTITION BY from_b) AS a FROM f)
SELECT CAST(from_b AS INTEGER) AS from_b, CAST(to_b AS INTEGER) AS to_b, CAST(CASE WHEN from_b = 7 THEN 0 WHEN a = 0 THEN 0.02 ELSE n / a END AS DOUBLE) AS rate FROM g WHERE from_b <> to_b""")
def barcode_error_rates(spark, d):
    return barcodes.error_rates(_indrop(spark, d))


@query(f"""WITH {DNA_READS}, t AS (SELECT DISTINCT cell >> 3 AS header, rmt FROM dna_reads), n AS (SELECT header, count(*) AS n_tags, count(*) FILTER (WHERE rmt & 7 = 3) AS n_t FROM t GROUP BY header)
SELECT * FROM n WHERE n_tags >= 10 AND n_t > 0.2 * n_tags""")
def dropseq_base_shift(spark, d):
    return barcodes.shifted_headers(dna_reads(spark, d), share=0.2)


@query(f"""WITH {DNA_READS}, t AS (SELECT DISTINCT cell, rmt FROM dna_reads), n AS (SELECT cell, count(*) AS n_tags FROM t GROUP BY cell HAVING count(*) >= 10),
p AS (SELECT cell, i, (rmt >> (3 * i)) & 7 AS b, count(*) AS k FROM t, range(1, 3) r(i) GROUP BY ALL), m AS (SELECT cell, max(k) AS most FROM p WHERE b <> 7 GROUP BY cell)
SELECT cell, n_tags, most FROM n JOIN m USING (cell) WHERE most > 0.24 * n_tags""".replace("GROUP BY ALL)", "GROUP BY cell, i, (rmt >> (3 * i)) & 7)"))
def dropseq_rmt_bias(spark, d):
    return barcodes.biased_cells(dna_reads(spark, d), share=0.24)



@query(f"""WITH RECURSIVE {READS}, sets AS (SELECT DISTINCT cell, rmt, list_sort(list_distinct(CASE WHEN g <> 0 AND two THEN [g, g2] WHEN g <> 0 THEN [g] WHEN two THEN [g2] ELSE [] END)) AS genes FROM reads WHERE status & 239 = 0),
own AS (SELECT *, row_number() OVER (PARTITION BY cell, rmt ORDER BY genes) AS k, count(*) OVER (PARTITION BY cell, rmt) AS n_sets FROM sets),
reach(cell, rmt, a, b) AS (SELECT cell, rmt, k, k FROM own UNION SELECT r.cell, r.rmt, r.a, y.k FROM reach r JOIN own x ON x.cell = r.cell AND x.rmt = r.rmt AND x.k = r.b JOIN own y ON y.cell = r.cell AND y.rmt = r.rmt AND list_has_any(x.genes, y.genes)),
lab AS (SELECT cell, rmt, a AS k, min(b) AS label FROM reach GROUP BY cell, rmt, a),
g AS (SELECT cell, rmt, label, max(n_sets) AS n_sets, count(*) AS size FROM own JOIN lab USING (cell, rmt, k) GROUP BY cell, rmt, label),
c AS (SELECT cell, rmt, label, gene, count(*) AS n FROM (SELECT cell, rmt, label, unnest(genes) AS gene FROM own JOIN lab USING (cell, rmt, k)) GROUP BY cell, rmt, label, gene),
h AS (SELECT g.*, (SELECT count(*) FROM c WHERE c.cell = g.cell AND c.rmt = g.rmt AND c.label = g.label AND c.n = g.size) AS common FROM g)
SELECT CASE WHEN n_sets = 1 THEN 'unique' WHEN size = 1 THEN 'disjoint' WHEN common = 1 THEN 'model' ELSE 'ambiguous' END AS outcome, count(*) AS n FROM h GROUP BY 1
UNION ALL SELECT 'collisions', count(*) FROM (SELECT cell, rmt FROM sets GROUP BY cell, rmt HAVING count(*) > 1)""")
def multimap_resolution(spark, d):
    return R.resolve_multimapping(reads(spark, d))[1]


TAGS = f"""{DNA_READS}, g AS (SELECT cell, gene, rmt, count(*) AS n, list_distinct(list(position)) AS ps FROM dna_reads GROUP BY cell, gene, rmt),
pr AS (SELECT a.cell, a.gene, a.rmt, a.n, b.rmt AS donor, b.n AS dn, {_distance('a.rmt', 'b.rmt', 3)} AS dist, list_has_all(b.ps, a.ps) AS covers FROM g a JOIN g b ON a.cell = b.cell AND a.gene = b.gene AND a.rmt <> b.rmt),
ex AS (SELECT cell, gene, rmt, max(n) AS n, sum(dn * power(0.02, dist)) AS expected, arg_max(donor, dn * 1000 - donor) FILTER (WHERE covers) AS donor FROM pr WHERE dist <= 2 GROUP BY cell, gene, rmt),
er AS (SELECT *, greatest(0, 1 - list_sum([exp(k * ln(expected) - expected - lgamma(k + 1)) FOR k IN range(n)])) AS p FROM ex)"""


@query(f"WITH {TAGS} SELECT cell, gene, rmt, n, expected, p FROM er")
def rmt_expected_errors(spark, d):
    return rmt.tag_errors(dna_reads(spark, d)).select("cell", "gene", "rmt", "n", "expected", "p")


@query(f"WITH {TAGS} SELECT cell, gene, rmt, donor, donor IS NOT NULL AND p > 0.05 AS is_error FROM er")
def rmt_jaitin_correction(spark, d):
    return rmt.tag_errors(dna_reads(spark, d)).select("cell", "gene", "rmt", "donor", "is_error")


LONELY = f"""{READS}, live AS (SELECT * FROM reads WHERE status = 0), np AS (SELECT gene, position, count(*) FILTER (WHERE position <> 0) AS n_position FROM live GROUP BY gene, position),
ng AS (SELECT *, CAST(sum(n_position) OVER (PARTITION BY gene) AS BIGINT) AS n_gene FROM np),
lo AS (SELECT gene, cell, rmt, min(position) AS position FROM live GROUP BY gene, cell, rmt HAVING min(position) = max(position)),
la AS (SELECT gene, position, count(*) AS lonely_position, CAST(sum(count(*)) OVER (PARTITION BY gene) AS BIGINT) AS lonely_gene FROM lo GROUP BY gene, position),
hg AS (SELECT *, coalesce(list_sum([exp(lgamma(lonely_gene + 1) - lgamma(x + 1) - lgamma(lonely_gene - x + 1) + lgamma(n_gene - lonely_gene + 1) - lgamma(n_position - x + 1) - lgamma(n_gene - lonely_gene - n_position + x + 1) - lgamma(n_gene + 1) + lgamma(n_position + 1) + lgamma(n_gene - n_position + 1))
  FOR x IN range(greatest(lonely_position + 1, lonely_gene + n_position - n_gene), least(lonely_gene, n_position) + 1)]), 0) AS p FROM la JOIN ng USING (gene, position))"""


@query(f"WITH {LONELY} SELECT gene, position, lonely_position, lonely_gene, n_position, n_gene, CAST(p AS DOUBLE) AS p FROM hg")
def lonely_triplets(spark, d):
    return R.lonely_positions(reads(spark, d))


# ---- statistics over tests


@query("""WITH t AS (SELECT p_partkey, (p_partkey * 37 % 1000 + 1) / 1000.0 AS p FROM part), r AS (SELECT *, p * count(*) OVER () / count(*) OVER (ORDER BY p RANGE UNBOUNDED PRECEDING) AS raw FROM t)
SELECT p_partkey, CAST(p AS DOUBLE) AS p, CAST(least(1, min(raw) OVER (ORDER BY p DESC RANGE UNBOUNDED PRECEDING)) AS DOUBLE) AS q FROM r""")
def bh_fdr(spark, d):
    rows = table(spark, d, "part").select("p_partkey", ((F.col("p_partkey") * 37 % 1000 + 1) / 1000.0).cast("double").alias("p"))
    return testing.bh_adjust(rows, "p")


@query("SELECT l_suppkey, l_quantity, CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_suppkey, l_quantity) - 1) / 2.0 AS DOUBLE) AS rank, count(*) OVER (PARTITION BY l_suppkey, l_quantity) AS n FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_quantity) = 1")
def rank_avg_ties(spark, d):
    return testing.value_ranks(table(spark, d, "lineitem"), ["l_suppkey"], "l_quantity")


# ---- cell quality

SIZES = f"{READS}, sizes AS (SELECT cell, CAST(sum(n_reads) AS BIGINT) AS n_reads, CAST(sum(n_molecules) AS BIGINT) AS n_molecules, count(*) AS n_genes, coalesce(sum(n_molecules) FILTER (WHERE gene < 2), 0) / sum(n_molecules) AS mt_fraction FROM counts GROUP BY cell)"


def _sizes(spark, d):
    return cellqc.cell_sizes(counts(spark, d), F.col("gene") < 2)


@query(f"WITH {SIZES} SELECT count(*) AS n, avg(n_molecules) AS mean, stddev_samp(n_molecules) AS std, CAST(min(n_molecules) AS DOUBLE) AS min, quantile_cont(n_molecules, 0.25) AS q25, quantile_cont(n_molecules, 0.5) AS q50, quantile_cont(n_molecules, 0.75) AS q75, CAST(max(n_molecules) AS DOUBLE) AS max FROM sizes")
def cell_size_quantiles(spark, d):
    return cellqc.size_quantiles(_sizes(spark, d))


@query(f"WITH {SIZES} SELECT cell, n_molecules, CAST(mt_fraction AS DOUBLE) AS mt_fraction, mt_fraction > 0.06 AS high_mt FROM sizes")
def high_mt_filter(spark, d):
    return cellqc.high_mitochondrial(_sizes(spark, d), 0.06).select("cell", "n_molecules", "mt_fraction", "high_mt")


@query(f"WITH {SIZES}, l AS (SELECT regr_slope(log10(n_genes), log10(n_molecules)) AS m, regr_intercept(log10(n_genes), log10(n_molecules)) AS c FROM sizes) SELECT cell, m * log10(n_molecules) + c - log10(n_genes) AS residual, coalesce(m * log10(n_molecules) + c - log10(n_genes) > 0.02, false) AS low_genes FROM sizes, l")
def low_gene_abundance(spark, d):
    return cellqc.low_gene_abundance(_sizes(spark, d), 0.02).select("cell", "residual", "low_genes")


@query(f"""WITH {SIZES}, a AS (SELECT *, mt_fraction > 0.06 AS bad FROM sizes), l AS (SELECT regr_slope(log10(n_genes), log10(n_molecules)) AS m, regr_intercept(log10(n_genes), log10(n_molecules)) AS c FROM a WHERE NOT bad),
f AS (SELECT n_molecules, CASE WHEN bad THEN 'high_mt' WHEN m * log10(n_molecules) + c - log10(n_genes) > 0.15 THEN 'low_gene_abundance' END AS failed_filter FROM a, l)
SELECT failed_filter, count(*) AS cells, CAST(sum(n_molecules) AS BIGINT) AS molecules FROM f WHERE failed_filter IS NOT NULL GROUP BY failed_filter""")
def filter_losses(spark, d):
    _, cells = cellqc.filter_cells(counts(spark, d), F.col("gene") < 2, most_mt=0.06, coverage=False, low_count=False)
    return cellqc.filter_losses(cells)


@query(f"WITH {READS} SELECT sum(n_reads) / sum(n_molecules) AS reads_per_molecule, sum(n_reads) / count(DISTINCT cell) AS reads_per_cell, (sum(n_reads) / sum(n_molecules) - 1) * 100 / (sum(n_reads) / sum(n_molecules)) AS saturation FROM counts")
def saturation_rate(spark, d):
    return cellqc.saturation(counts(spark, d))


@query(f"WITH {READS} SELECT gene, count(*) AS n_cells FROM counts WHERE n_molecules > 0 GROUP BY gene HAVING count(*) >= (SELECT least(30, CAST(floor(0.2 * count(DISTINCT cell)) AS BIGINT)) FROM counts)")
def gene_detection_filter(spark, d):
    return cellqc.common_genes(counts(spark, d))


@query(f"WITH {READS} SELECT cell, gene, n_molecules FROM counts WHERE cell IN (SELECT cell FROM counts GROUP BY cell HAVING log10(sum(n_molecules)) > 2.4)")
def library_threshold(spark, d):
    return cellqc.library_threshold(counts(spark, d), 2.4).select("cell", "gene", "n_molecules")


@query(f"WITH {SIZES}, e AS (SELECT min(log10(n_molecules)) AS lo, max(log10(n_molecules)) AS hi FROM sizes) SELECT CAST(coalesce(least(floor((log10(n_molecules) - lo) / nullif(hi - lo, 0) * 25), 24), 0) AS BIGINT) AS bin, count(*) AS n FROM sizes, e GROUP BY 1")
def cell_size_histogram(spark, d):
    return cellqc.size_bins(_sizes(spark, d))


@query(f"WITH {SIZES}, h AS (SELECT n_molecules AS size, count(*) AS n FROM sizes GROUP BY 1) SELECT size, n, CAST(sum(size * n) OVER (ORDER BY size DESC) / sum(size * n) OVER () AS DOUBLE) AS share FROM h")
def cumulative_share(spark, d):
    return cellqc.cumulative_sizes(_sizes(spark, d))


@query()
def low_count_inflection(spark, d):
    cut = cellqc.low_count_cutoff(_sizes(spark, d))
    return spark.createDataFrame([(cut,)], "cutoff double")


@query()
def low_coverage_gmm(spark, d):
    return cellqc.low_coverage(_sizes(spark, d)).select("cell", "low_coverage")


@query(f"WITH {SIZES} SELECT cell, mt_fraction * 1000 AS mt_percent, CAST(cell % 12 AS DOUBLE) AS pc1_percent, CAST(cell % 9 AS DOUBLE) AS saturation, mt_fraction * 1000 >= 30 AS warn_cell_death, cell % 12 <= 5 AS warn_library_size, cell % 9 <= 5 AS warn_saturation FROM sizes")
def run_warnings(spark, d):
    rows = _sizes(spark, d).select("cell", (F.col("mt_fraction") * 1000).alias("mt_percent"), (F.col("cell") % 12).cast("double").alias("pc1_percent"), (F.col("cell") % 9).cast("double").alias("saturation"))
    return cellqc.run_warnings(rows)


# ---- matrix statistics

NORMAL = f"{READS}, lib AS (SELECT cell, sum(n_molecules) AS s FROM counts GROUP BY cell), nm AS (SELECT cell, gene, n_molecules / s * (SELECT quantile_cont(s, 0.5) FROM lib) AS value FROM counts JOIN lib USING (cell))"


def _matrix(spark, d):
    return counts(spark, d).select("cell", "gene", F.col("n_molecules").alias("value"))


@query(f"WITH {NORMAL} SELECT cell, gene, CAST(value AS DOUBLE) AS value FROM nm")
def median_normalise(spark, d):
    return stats.median_normalise(counts(spark, d))


@query(f"WITH {NORMAL} SELECT cell, gene, CAST(log2(value + 0.1) AS DOUBLE) AS value FROM nm")
def log2_transform(spark, d):
    return stats.log2_transform(stats.median_normalise(counts(spark, d)))


DENSE = f"{READS}, cs AS (SELECT DISTINCT cell, CAST(cell % {{k}} AS INTEGER) AS label FROM counts), gs AS (SELECT DISTINCT gene FROM counts), mx AS (SELECT cs.cell, label, gs.gene, coalesce(n_molecules, 0) AS value FROM cs CROSS JOIN gs LEFT JOIN counts c ON c.cell = cs.cell AND c.gene = gs.gene), rk AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY value) + (count(*) OVER (PARTITION BY gene, value) - 1) / 2.0 AS rank FROM mx), ti AS (SELECT gene, sum(power(n, 3) - n) AS t FROM (SELECT gene, value, count(*) AS n FROM mx GROUP BY gene, value) GROUP BY gene)"


@query(f"""WITH {DENSE.format(k=2)}, s AS (SELECT gene, sum(rank) FILTER (WHERE label = 0) AS r1, CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS a, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS b FROM rk GROUP BY gene),
v AS (SELECT gene, a, b, r1 - a * (a + 1) / 2 AS u, ((power(a + b, 3) - (a + b)) / 12 - t / 12) * a * b / ((a + b) * (a + b - 1)) AS var FROM s JOIN ti USING (gene)) SELECT gene, least(u, a * b - u) AS u, CASE WHEN var > 0 THEN (u - 0.5 - a * b / 2) / sqrt(var) END AS z FROM v""")
def mannwhitney_u(spark, d):
    m = _matrix(spark, d)
    return stats.mann_whitney(m, labels(m, 2), 0, 1)


@query(f"""WITH {DENSE.format(k=3)}, e AS (SELECT gene, label, sum(rank) AS r, count(*) AS n FROM rk GROUP BY gene, label), x AS (SELECT gene, CAST(sum(n) AS DOUBLE) AS nt, sum(r * r / n) AS s, count(*) - 1 AS df FROM e GROUP BY gene)
SELECT gene, CASE WHEN 1 - t / (power(nt, 3) - nt) > 0 THEN (12 / (nt * (nt + 1)) * s - 3 * (nt + 1)) / (1 - t / (power(nt, 3) - nt)) END AS h, df FROM x JOIN ti USING (gene)""")
def kruskal_h(spark, d):
    m = _matrix(spark, d)
    return stats.kruskal(m, labels(m, 3))


@query(f"""WITH {DENSE.format(k=3)}, e AS (SELECT gene, label, CAST(count(*) AS DOUBLE) AS n, avg(rank) AS m, var_samp(rank) / count(*) AS v FROM rk GROUP BY gene, label)
SELECT x.gene, x.label AS a, y.label AS b, CASE WHEN x.v + y.v > 0 THEN (x.m - y.m) / sqrt(x.v + y.v) END AS t, CASE WHEN x.v + y.v > 0 THEN power(x.v + y.v, 2) / (x.v * x.v / (x.n - 1) + y.v * y.v / (y.n - 1)) END AS df FROM e x JOIN e y ON x.gene = y.gene AND x.label < y.label""")
def post_hoc_welch(spark, d):
    m = _matrix(spark, d)
    return stats.post_hoc(m, labels(m, 3))


@query()
def population_markers(spark, d):
    m = _matrix(spark, d)
    return stats.population_markers(m, labels(m, 3))


@query(f"""WITH {READS}, f AS (SELECT cell % 3 AS label, gene, n_molecules / sum(n_molecules) OVER (PARTITION BY cell) AS f FROM counts), o AS (SELECT label, gene, sum(f) AS o FROM f GROUP BY label, gene),
p AS (SELECT cell % 3 AS label, count(DISTINCT cell) AS n FROM counts GROUP BY 1), e AS (SELECT gene, o, sum(o) OVER (PARTITION BY gene) * n / (SELECT sum(n) FROM p) AS e FROM o JOIN p USING (label)) SELECT gene, 2 * sum(CASE WHEN o > 0 THEN o * ln(o / e) ELSE 0 END) AS g FROM e GROUP BY gene""")
def g_test(spark, d):
    m = _matrix(spark, d)
    return stats.g_test(m, labels(m, 3))


@query(f"WITH {DENSE.format(k=2)}, x AS (SELECT cell, CAST(sum(value) AS DOUBLE) AS x FROM mx GROUP BY cell) SELECT gene, corr(x, value) AS r FROM mx JOIN x USING (cell) GROUP BY gene HAVING sum(value) <> 0")
def pearson_by_gene(spark, d):
    m = _matrix(spark, d)
    return stats.pearson(m.groupBy("cell").agg(F.sum("value").cast("double").alias("x")), m)


@query("""WITH e AS (SELECT vec_id, c, embedding[c + 1]::DOUBLE AS x FROM embeddings, range(1, 4) t(c)), v AS (SELECT vec_id, g, embedding[g + 1]::DOUBLE AS y FROM embeddings, range(10, 15) t(g)),
s AS (SELECT c, g, row_number() OVER w AS k, avg(x) OVER f AS sx, avg(y) OVER f AS sy FROM e JOIN v USING (vec_id) WINDOW w AS (PARTITION BY c, g ORDER BY x, vec_id), f AS (PARTITION BY c, g ORDER BY x, vec_id ROWS 9 PRECEDING))
SELECT CAST(c AS INTEGER) AS component, CAST(g AS INTEGER) AS gene, corr(sx, sy) AS r FROM s WHERE k > 10 GROUP BY c, g""")
def eigv_smoothed_corr(spark, d):
    rows = vectors(spark, d).select("cell", F.posexplode("vector").alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    return stats.smoothed_correlation(rows.where("i < 4").withColumnRenamed("i", "component"), rows.where("i >= 10 and i < 15").select("cell", F.col("i").alias("gene"), F.col("x").alias("value")))


@query(f"""WITH {READS}, t AS (SELECT gene, cell % 8 AS key, sum(n_molecules) AS v FROM counts GROUP BY 1, 2), p AS (SELECT key, gene, v / sum(v) OVER (PARTITION BY key) AS p FROM t), k AS (SELECT DISTINCT key FROM p), f AS (SELECT DISTINCT gene FROM p),
j AS (SELECT a.key AS a, b.key AS b, coalesce(x.p, 0) AS p, coalesce(y.p, 0) AS q FROM k a JOIN k b ON a.key < b.key CROSS JOIN f LEFT JOIN p x ON x.key = a.key AND x.gene = f.gene LEFT JOIN p y ON y.key = b.key AND y.gene = f.gene)
SELECT a, b, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN 0.5 * p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN 0.5 * q * log2(q / ((p + q) / 2)) ELSE 0 END))) AS distance FROM j GROUP BY a, b""")
def jsd_pairs(spark, d):
    t = counts(spark, d).groupBy("gene", (F.col("cell") % 8).alias("key")).agg(F.sum("n_molecules").alias("v"))
    return stats.jensen_shannon(t.select("key", F.col("gene").alias("feature"), (F.col("v") / F.sum("v").over(Window.partitionBy("key"))).alias("p")))


@query(f"WITH {READS}, t AS (SELECT gene, CAST(sum(n_molecules) AS DOUBLE) AS v FROM counts GROUP BY gene), s AS (SELECT gene, (v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()) * 2 - 1 AS linear FROM t) SELECT gene, linear, 2 / (1 + exp(-linear)) - 1 AS logistic FROM s")
def scaled_ranks(spark, d):
    t = counts(spark, d).groupBy("gene").agg(F.sum("n_molecules").cast("double").alias("v")).cache()
    return t.select("gene", stats.linear_scale(t, "v").alias("linear")).withColumn("logistic", stats.logistic_scale(F.col("linear")))


GSEA = """r AS (SELECT p_partkey AS gene, (p_partkey * 37 % 1999) / 1000.0 - 1 AS score FROM part), s AS (SELECT p_partkey AS gene, 'set' || CAST(p_size % 6 AS VARCHAR) AS gene_set FROM part),
o AS (SELECT *, row_number() OVER (ORDER BY score DESC, gene) AS place FROM r)"""


def _ranks(spark, d):
    rows = table(spark, d, "part")
    return rows.select(F.col("p_partkey").alias("gene"), ((F.col("p_partkey") * 37 % 1999) / 1000.0 - 1).cast("double").alias("score")), rows.select(F.concat(F.lit("set"), (F.col("p_size") % 6).cast("string")).alias("gene_set"), F.col("p_partkey").alias("gene"))


@query(f"""WITH {GSEA}, k AS (SELECT gene_set, count(*) AS n, sum(abs(score)) AS total FROM s JOIN o USING (gene) GROUP BY gene_set),
w AS (SELECT k.gene_set, o.place, k.n, sum(CASE WHEN s.gene IS NOT NULL THEN abs(score) / total ELSE -1.0 / ((SELECT count(*) FROM r) - k.n) END) OVER (PARTITION BY k.gene_set ORDER BY place) AS run FROM o CROSS JOIN k LEFT JOIN s ON s.gene = o.gene AND s.gene_set = k.gene_set)
SELECT gene_set, CASE WHEN max(run) >= -least(min(run), 0) THEN max(run) ELSE min(run) END AS es, max(n) AS n_hits FROM w GROUP BY gene_set""")
def gsea_es(spark, d):
    return stats.enrichment_scores(*_ranks(spark, d))


@query()
def gsea_permuted(spark, d):
    return stats.gsea(*_ranks(spark, d))


@query()
def resampled_rank_test(spark, d):
    m = _matrix(spark, d)
    return stats.resampled_tests(m, labels(m, 2)).select("gene", "statistic", "lo", "hi", "p", "q")


@query()
def bootstrap_welch(spark, d):
    m = _matrix(spark, d)
    return stats.bootstrap_t(m, labels(m, 2), 0, 1)


@query()
def de_hurdle(spark, d):
    m = _matrix(spark, d)
    return stats.hurdle_tests(m, labels(m, 3), least_fold=1.0, alpha=1.0)


@query()
def enriched_genes(spark, d):
    m = _matrix(spark, d)
    return stats.enriched_labels(stats.scaled_differences(m, labels(m, 3)))


# ---- graphs and projections

KNN = """v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), dd AS (SELECT a.vec_id AS src, b.vec_id AS dst, sqrt(list_sum([power(a.e[i] - b.e[i], 2) FOR i IN range(1, 65)])) AS distance FROM v a, v b),
kn AS (SELECT * FROM dd QUALIFY row_number() OVER (PARTITION BY src ORDER BY distance, dst) <= 8)"""


def _near(spark, d):
    return graph.neighbours(vectors(spark, d), 8)


@query(f"WITH {KNN} SELECT src, dst, distance FROM kn")
def knn_join(spark, d):
    return _near(spark, d).select("src", "dst", "distance")


@query(f"WITH {KNN} SELECT src AS cell, g AS gene, avg(v.e[g + 1]) AS value FROM kn JOIN v ON v.vec_id = dst, range(64) t(g) GROUP BY src, g")
def knn_smooth(spark, d):
    rows = vectors(spark, d).select("cell", F.posexplode("vector").alias("gene", "value")).select("cell", F.col("gene").cast("long").alias("gene"), F.col("value").cast("double").alias("value"))
    return graph.smooth(rows, _near(spark, d))


MARKOV = f"{KNN}, w AS (SELECT src, dst, exp(-distance) AS w FROM kn), sy AS (SELECT src, dst, sum(w) / 2 AS w FROM (SELECT * FROM w UNION ALL SELECT dst, src, w FROM w) GROUP BY src, dst)"


@query(f"WITH {MARKOV} SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS w FROM sy")
def knn_affinity_markov(spark, d):
    return graph.normalise(graph.affinity(_near(spark, d)), "markov")


@query(f"WITH {MARKOV}, s AS (SELECT src, sum(w) AS d FROM sy GROUP BY src) SELECT sy.src, sy.dst, w / sqrt(a.d * b.d) AS w FROM sy JOIN s a ON a.src = sy.src JOIN s b ON b.src = sy.dst")
def knn_affinity_smarkov(spark, d):
    return graph.normalise(graph.affinity(_near(spark, d)), "smarkov")


@query(f"""WITH {MARKOV}, m AS (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS w FROM sy), x0 AS (SELECT vec_id AS cell, e[1] AS x FROM v), x1 AS (SELECT src AS cell, sum(w * x) AS x FROM m JOIN x0 ON cell = dst GROUP BY src),
x2 AS (SELECT src AS cell, sum(w * x) AS x FROM m JOIN x1 ON cell = dst GROUP BY src) SELECT src AS cell, 0 AS gene, sum(w * x) AS value FROM m JOIN x2 ON cell = dst GROUP BY src""")
def markov_imputation(spark, d):
    rows = vectors(spark, d).select("cell", F.lit(0).alias("gene"), F.get("vector", F.lit(0)).cast("double").alias("value"))
    return graph.power(graph.normalise(graph.affinity(_near(spark, d)), "markov"), rows, 3)


@query()
def diffusion_eigs(spark, d):
    _, pairs = graph.eigenpairs(graph.normalise(graph.affinity(_near(spark, d)), "smarkov"), k=3)
    return pairs


@query()
def pca_project(spark, d):
    return graph.pca(vectors(spark, d), 5)[1]


@query()
def phenograph_like(spark, d):
    return graph.communities(graph.jaccard_edges(_near(spark, d)))


@query()
def tsne(spark, d):
    return spark.createDataFrame(embedding.tsne(vectors(spark, d)))


# ---- sources as queries


@query("""SELECT l_suppkey AS cell_key, '@' || ':' || seq[1:12] || ':' || seq[13:20] || ':' || seq[21:] || ';read' || CAST(l_suppkey AS VARCHAR) AS name
FROM (SELECT DISTINCT l_suppkey, """ + sequence_sql("l_suppkey * 7919 + 13", 24) + """ AS seq FROM lineitem)""")
def fastq_merge(spark, d):
    keys = table(spark, d, "lineitem").select("l_suppkey").distinct()
    k = F.col("l_suppkey")
    barcode = keys.select(k.alias("ord"), sequence((k * 7919 + 13).cast("long"), 24).alias("sequence")).withColumn("sequence", F.concat("sequence", F.lit("A")))
    genomic = keys.select(k.alias("ord"), F.concat(F.lit("@read"), k.cast("string")).alias("name"), F.lit("ACGT").alias("sequence"), F.lit("+").alias("name2"), F.lit("FFFF").alias("quality"))
    return platforms.merge_fastq(genomic, barcode, "drop_seq").select(F.col("ord").alias("cell_key"), "name")


@query("SELECT CAST(l_orderkey AS VARCHAR) AS qname, count(*) AS n, min(l_partkey) FILTER (WHERE l_linenumber % 4 <> 0) AS first_pos, count(*) FILTER (WHERE l_linenumber % 4 <> 0) AS n_places FROM lineitem GROUP BY l_orderkey")
def sam_multialign(spark, d):
    c = F.col
    flag = F.when(c("l_linenumber") % 4 == 0, 4).otherwise(F.when(c("l_linestatus") == "O", 0).otherwise(16))
    rows = table(spark, d, "lineitem").select(c("l_orderkey").cast("string").alias("qname"), flag.alias("flag"), F.lit("chr").alias("rname"), c("l_partkey").alias("pos"))
    places = readers.multi_alignments(rows)
    n = rows.groupBy("qname").agg(F.count(F.lit(1)).alias("n"))
    return places.join(n, "qname").select("qname", "n", F.array_min(F.transform("places", lambda p: p["pos"])).alias("first_pos"), F.size("places").cast("long").alias("n_places"))


@query("""SELECT l_orderkey % 5 AS run, CAST(length(l_comment) AS INTEGER) AS length, count(*) AS n FROM (SELECT l_orderkey, repeat('A', CAST(l_quantity AS INTEGER)) AS l_comment FROM lineitem) GROUP BY 1, 2""")
def sequence_lengths(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_orderkey") % 5).alias("run"), F.repeat(F.lit("A"), F.col("l_quantity").cast("int")).alias("sequence"))
    return rows.groupBy("run", F.length("sequence").alias("length")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_suppkey, CAST(floor((33 + l_suppkey % 40 + 33 + l_suppkey % 17 + 33 + 2 * (l_suppkey % 10)) / 3) - 33 AS INTEGER) AS quality FROM (SELECT DISTINCT l_suppkey FROM lineitem)""")
def average_quality(spark, d):
    k = F.col("l_suppkey")
    keys = table(spark, d, "lineitem").select("l_suppkey").distinct()
    text = F.concat(F.char(33 + k % 40), F.char(33 + k % 17), F.char(33 + 2 * (k % 10)))
    return keys.select("l_suppkey", readers.average_quality(text).alias("quality"))


@query("""SELECT l_suppkey, ['p' || CAST(l_suppkey % 3 AS VARCHAR), 'AC' || CAST(l_suppkey AS VARCHAR), 'GG', 'TT'][2] AS cell, 'AC' || CAST(l_suppkey AS VARCHAR) || 'x' AS name, CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_suppkey AS VARCHAR) END AS value FROM (SELECT DISTINCT l_suppkey FROM lineitem)""")
def name_annotations(spark, d):
    k = F.col("l_suppkey").cast("string")
    raw = F.concat(F.lit("p"), (F.col("l_suppkey") % 3).cast("string"), F.lit(":AC"), k, F.lit(":GG:TT;AC"), k, F.lit("x"))
    meta = F.when(F.col("l_suppkey") % 2 == 0, F.concat(raw, F.lit("|key="), k)).otherwise(raw)
    rows = table(spark, d, "lineitem").select("l_suppkey").distinct()
    field = readers.name_fields(raw)
    return rows.select("l_suppkey", field["cell"].alias("cell"), field["name"].alias("name"), F.try_element_at(readers.metadata(meta), F.lit("key")).alias("value"))


@query("""WITH r AS (SELECT DISTINCT l_linenumber * 16 + CASE WHEN l_linestatus = 'O' THEN 4 ELSE 0 END AS flag, l_linenumber % 3 AS hits FROM lineitem)
SELECT CAST(flag AS INTEGER) AS flag, CAST(hits AS INTEGER) AS hits, flag & 4 <> 0 AS is_unmapped, hits > 1 AS is_multimapped, hits = 1 AS is_unique, CASE WHEN flag & 16 <> 0 THEN '-' ELSE '+' END AS strand FROM r""")
def sam_flags(spark, d):
    c = F.col
    rows = table(spark, d, "lineitem").select((c("l_linenumber") * 16 + F.when(c("l_linestatus") == "O", 4).otherwise(0)).cast("int").alias("flag"), (c("l_linenumber") % 3).cast("int").alias("hits")).distinct()
    found = readers.flag_columns(rows.withColumn("tags", F.create_map(F.lit("NH"), F.col("hits"))))
    return found.select("flag", "hits", "is_unmapped", "is_multimapped", "is_unique", "strand")


@query("SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS gene_id, 'n' || CAST(p_size AS VARCHAR) AS gene_name FROM part")
def gtf_attributes(spark, d):
    text = F.format_string('gene_id "%d"; gene_name "n%d"; gene_id "other";', "p_partkey", F.col("p_size").cast("long"))
    found = readers.attributes(text)
    return table(spark, d, "part").select("p_partkey", F.element_at(found, "gene_id").alias("gene_id"), F.element_at(found, "gene_name").alias("gene_name"))


@query(f"""WITH c AS (SELECT DISTINCT {packed_sql('l_orderkey % 64', 3)} AS packed FROM lineitem)
SELECT packed, CAST((i * 5 + row_number() OVER (PARTITION BY packed, i ORDER BY pos) - 1) - i AS INTEGER) AS ord, (packed ^ (((packed >> (3 * i)) & 7) << (3 * i))) + (b << (3 * i)) AS near
FROM c, range(3) r(i), (VALUES (1, 4), (2, 6), (3, 5), (4, 3), (5, 7)) t(pos, b) WHERE b <> (packed >> (3 * i)) & 7""".replace("packed ^ (((packed >> (3 * i)) & 7) << (3 * i))", "packed - (((packed >> (3 * i)) & 7) << (3 * i))"))
def dna_neighbours(spark, d):
    p = dna_reads(spark, d).select(F.col("rmt").alias("packed")).distinct()
    return p.select("packed", F.posexplode(dna.neighbours(F.col("packed"))).alias("ord", "near"))


@query(f"""WITH c AS (SELECT DISTINCT {packed_sql('l_orderkey % 64', 3)} AS donor, {packed_sql('l_partkey % 64', 3)} AS target FROM lineitem) SELECT donor, target, power(0.02, {_distance('donor', 'target', 3)}) AS p FROM c""")
def conversion_probability(spark, d):
    c = F.col
    pairs = table(spark, d, "lineitem").select(packed((c("l_orderkey") % 64).cast("long"), 3).alias("donor"), packed((c("l_partkey") % 64).cast("long"), 3).alias("target")).distinct()
    return pairs.select("donor", "target", dna.conversion_probability(c("donor"), c("target"), 0.02).alias("p"))


@query("SELECT l_suppkey, length(t) - length(replace(replace(t, 'T', ''), 'N', '')) AS n FROM (SELECT DISTINCT l_suppkey, " + sequence_sql("l_suppkey * 31", 8) + " || 'N' AS t FROM lineitem)")
def poly_t_count(spark, d):
    tail = F.concat(sequence((F.col("l_suppkey") * 31).cast("long"), 8), F.lit("N"))
    return table(spark, d, "lineitem").select("l_suppkey").distinct().select("l_suppkey", R.n_poly_t(tail).cast("long").alias("n"))


@query("""WITH t AS (SELECT l_suppkey AS run, count(*) * 10 AS n_input, count(*) * 8 AS n_aligned, count(*) AS genomic, count(*) // 7 AS phix, count(*) // 3 AS no_cell, 5 AS rmt_n, 3 AS cell_n, count(*) // 2 AS poly_t, 0 AS dust, 2 AS wrong_cell FROM lineitem GROUP BY l_suppkey),
b AS (SELECT *, genomic + phix + no_cell + rmt_n + cell_n + poly_t + dust + wrong_cell AS n_rejected FROM t)
SELECT run, n_rejected, n_aligned - n_rejected AS n_good, round_even(n_aligned / n_input * 100, 1) AS pct_aligned, round_even(n_rejected / n_input * 100, 1) AS pct_rejected, round_even(poly_t / n_rejected * 100, 1) AS pct_bad_poly_t FROM b""")
def yield_summary(spark, d):
    n = F.count(F.lit(1))
    t = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("run")).agg(
        (n * 10).alias("n_input"), (n * 8).alias("n_aligned"), n.alias("genomic"), F.floor(n / 7).alias("phix"), F.floor(n / 3).alias("no_cell"), F.lit(5).alias("rmt_n"), F.lit(3).alias("cell_n"), F.floor(n / 2).alias("poly_t"), F.lit(0).alias("dust"), F.lit(2).alias("wrong_cell")
    )
    return cellqc.yield_summary(t).select("run", "n_rejected", "n_good", "pct_aligned", "pct_rejected", "pct_bad_poly_t")


@query("""WITH p AS (SELECT l_quantity::DOUBLE AS x, l_discount::DOUBLE AS y FROM lineitem), e AS (SELECT min(x) AS a, max(x) AS b, min(y) AS c, max(y) AS d FROM p),
g AS (SELECT CAST(least(floor((x - a) / (b - a) * 20), 19) AS BIGINT) AS x_bin, CAST(least(floor((y - c) / (d - c) * 20), 19) AS BIGINT) AS y_bin, count(*) AS n FROM p, e GROUP BY 1, 2) SELECT *, asinh(n) AS density FROM g""")
def density_grid(spark, d):
    points = table(spark, d, "lineitem").select(F.col("l_quantity").cast("double").alias("x"), F.col("l_discount").cast("double").alias("y"))
    return cellqc.density_grid(points, 20)


@query(f"""WITH {KNN}, s AS (SELECT src, list(dst) AS s FROM kn GROUP BY src), p AS (SELECT DISTINCT least(src, dst) AS src, greatest(src, dst) AS dst FROM kn WHERE src <> dst)
SELECT p.src, p.dst, len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) AS w FROM p JOIN s a ON a.src = p.src JOIN s b ON b.src = p.dst WHERE len(list_intersect(a.s, b.s)) > 0""")
def jaccard_edges(spark, d):
    return graph.jaccard_edges(_near(spark, d))


@query("""WITH e AS (SELECT vec_id AS cell, c AS component, embedding[c + 1]::DOUBLE AS x, vec_id % 37 AS size FROM embeddings, range(3) t(c)), l AS (SELECT component, regr_slope(x, size) AS m, regr_intercept(x, size) AS k FROM e GROUP BY component)
SELECT cell, CAST(e.component AS INTEGER) AS component, x - (m * size + k) AS x FROM e JOIN l ON l.component = e.component""")
def regress_library_size(spark, d):
    rows = vectors(spark, d).select("cell", F.posexplode("vector").alias("component", "x")).where("component < 3").withColumn("x", F.col("x").cast("double"))
    return graph.regress_out(rows, vectors(spark, d).select("cell", (F.col("cell") % 37).alias("size")))


# ---- checks, orders and rows for figures


@query("WITH c AS (SELECT o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1) SELECT p AS priority, row_number() OVER (ORDER BY p) - 1 AS code, n FROM c")
def category_codes(spark, d):
    rows = panels.category_codes(table(spark, d, "orders").select(F.col("o_orderpriority").alias("priority")), "priority")
    return rows.groupBy("priority", "code").agg(F.count(F.lit(1)).alias("n"))


_STOPS = [[c[i] for c in panels.SCALE] for i in range(3)]


@query(f"""WITH v AS (SELECT DISTINCT o_orderpriority AS value FROM orders), p AS (SELECT value, (row_number() OVER (ORDER BY value) - 1) / greatest(count(*) OVER () - 1, 1) AS position FROM v), a AS (SELECT *, CAST(least(floor(position * 4), 3) AS INTEGER) AS k FROM p)
SELECT value, position, """ + ", ".join(f"CAST({s} AS DOUBLE[])[k + 1] + (CAST({s} AS DOUBLE[])[k + 2] - CAST({s} AS DOUBLE[])[k + 1]) * (position * 4 - k) AS {n}" for s, n in zip(_STOPS, ("red", "green", "blue"))) + " FROM a")
def category_colours(spark, d):
    return panels.category_colours(table(spark, d, "orders"), "o_orderpriority")


@query("SELECT vec_id AS cell, a || '-' || b AS panel, embedding[a + 1]::DOUBLE AS x, embedding[b + 1]::DOUBLE AS y FROM embeddings, (VALUES (0, 1), (0, 2), (1, 2)) t(a, b)")
def component_panels(spark, d):
    rows = vectors(spark, d).select("cell", F.posexplode("vector").alias("component", "x")).withColumn("x", F.col("x").cast("double"))
    return panels.component_panels(rows, [(0, 1), (0, 2), (1, 2)])


@query("SELECT label, count(*) AS n, avg(embedding[1]::DOUBLE) AS x, avg(embedding[2]::DOUBLE) AS y FROM embeddings GROUP BY label")
def label_panel(spark, d):
    rows = vectors(spark, d)
    return panels.label_panel(rows.select("cell", F.get("vector", F.lit(0)).cast("double").alias("x"), F.get("vector", F.lit(1)).cast("double").alias("y")), rows.select("cell", "label"))


@query(f"WITH {READS}, c AS (SELECT DISTINCT cell FROM counts) SELECT c.cell, CAST(c.cell % 7 AS DOUBLE) AS x, CAST(c.cell % 11 AS DOUBLE) AS y, g.gene, CAST(coalesce(n_molecules, 0) AS DOUBLE) AS value FROM c CROSS JOIN (VALUES (1), (2), (30)) g(gene) LEFT JOIN counts ON counts.cell = c.cell AND counts.gene = g.gene")
def expression_overlay(spark, d):
    m = _matrix(spark, d)
    places = m.select("cell").distinct().select("cell", (F.col("cell") % 7).cast("double").alias("x"), (F.col("cell") % 11).cast("double").alias("y"))
    return panels.expression_overlay(places, m, [1, 2, 30])


@query("SELECT range AS panel, range // 4 AS row, range % 4 AS col FROM range(11)")
def grid_places(spark, d):
    return panels.grid_places(spark, 11)


_SPREAD = "s AS (SELECT c AS component, var_pop(embedding[c + 1]::DOUBLE) AS value FROM embeddings, range(64) t(c) GROUP BY c)"


def _spread(spark, d):
    return vectors(spark, d).select(F.posexplode("vector").alias("component", "x")).groupBy("component").agg(F.var_pop(F.col("x").cast("double")).alias("value"))


@query(f"WITH {_SPREAD}, f AS (SELECT row_number() OVER o AS n_components, value - lead(value) OVER o AS gap FROM s WINDOW o AS (ORDER BY value DESC, component)) SELECT * FROM f WHERE gap IS NOT NULL ORDER BY gap DESC, n_components LIMIT 1")
def eigengap(spark, d):
    return panels.eigengap(_spread(spark, d))


@query(f"WITH {_SPREAD}, f AS (SELECT row_number() OVER o AS k, sum(value) OVER o / sum(value) OVER () AS part FROM s WINDOW o AS (ORDER BY value DESC, component)) SELECT min(k) AS n_components FROM f WHERE part >= 0.75")
def components_for_share(spark, d):
    return panels.components_for(_spread(spark, d))


@query(f"SELECT p_partkey AS gene, round_even(p_partkey * 37 % 1000 / 7.0, 2)::DOUBLE AS z, q FROM ({SQL['bh_fdr']})")
def tests_by_q(spark, d):
    tests = bh_fdr(spark, d).select(F.col("p_partkey").alias("gene"), (F.col("p_partkey") * 37 % 1000 / F.lit(7.0)).alias("z"), "q")
    return stats.by_q(tests, ["z"])


@query(f"WITH {READS} SELECT gene, CAST(sum(n_molecules) AS BIGINT) AS total FROM counts GROUP BY gene")
def non_negative_totals(spark, d):
    return stats.non_negative(_matrix(spark, d)).groupBy("gene").agg(F.sum("value").cast("long").alias("total"))


@query(f"WITH {READS} SELECT DISTINCT cell, CAST(cell % 3 AS INTEGER) AS label FROM counts")
def aligned_labels(spark, d):
    m = _matrix(spark, d)
    return stats.aligned(m, labels(m, 3))


@query("""WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings), c AS (SELECT id, list_transform(e, lambda x: x - list_avg(e)) AS e FROM v), u AS (SELECT id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM c)
SELECT a.id AS a, b.id AS b, list_dot_product(a.e, b.e) AS r FROM u a, u b""")
def pearson_map(spark, d):
    rows = vectors(spark, d).select(F.col("cell").alias("id"), "vector")
    return stats.correlation_map(rows, rows)


@query(f"""WITH {KNN.replace("<= 8)", "<= 31)")}, o AS (SELECT src, distance AS s FROM kn QUALIFY row_number() OVER (PARTITION BY src ORDER BY distance, dst) = 11), w AS (SELECT src, dst, exp(-distance / s) AS w FROM kn JOIN o USING (src)),
sy AS (SELECT src, dst, sum(w) AS w FROM (SELECT * FROM w UNION ALL SELECT dst, src, w FROM w) GROUP BY src, dst) SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS w FROM sy""")
def adaptive_markov(spark, d):
    return graph.normalise(graph.adaptive_affinity(graph.neighbours(vectors(spark, d), 31), 10), "markov")


@query("""WITH n AS (SELECT count(*) - 1 AS steps FROM nation), s AS (SELECT range AS i, steps FROM n, range(1000) WHERE range < steps)
SELECT steps + 1 + i AS node, steps - 1 - i AS depth, 2 * (steps - 1 - i) AS dfs, greatest(2 * (steps - 1 - i) - 1, 0) AS bfs FROM s UNION ALL
SELECT i + 1, steps - i, 2 * (steps - 1 - i) + 1, 2 * (steps - i) FROM s UNION ALL SELECT 0, steps, 2 * steps, 2 * steps - 1 FROM n""")
def tree_order(spark, d):
    steps = table(spark, d, "nation").agg((F.count(F.lit(1)) - 1).alias("steps"))
    rows = steps.select("steps", F.explode(F.sequence(F.lit(0).cast("long"), F.col("steps") - 1)).alias("step"))
    left = F.when(F.col("step") == 0, F.lit(0)).otherwise(F.col("steps") + F.col("step"))
    return graph.tree_order(graph.linkage_edges(rows.select("step", left.alias("left"), (F.col("step") + 1).alias("right"), F.col("step").cast("double").alias("distance"))))


@query("""WITH r AS (SELECT o_orderkey AS line, o_orderstatus AS seqname, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, o_custkey % 50 AS s, o_custkey % 50 + 1 + o_orderkey % 5 AS e FROM orders)
SELECT min(line) AS line, seqname, strand, s AS start, e AS "end", e - s AS size FROM r GROUP BY seqname, strand, s, e""")
def gtf_distinct(spark, d):
    c = F.col
    start = c("o_custkey") % 50
    rows = table(spark, d, "orders").select(c("o_orderkey").alias("line"), c("o_orderstatus").alias("seqname"), F.when(c("o_orderkey") % 2 == 0, "+").otherwise("-").alias("strand"), start.alias("start"), (start + 1 + c("o_orderkey") % 5).alias("end"))
    return annotation.distinct_records(rows)
