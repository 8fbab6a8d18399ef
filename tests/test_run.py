import random

import pytest

from cellweave.__main__ import main
from cellweave.operators.platforms import PLATFORMS, merge_fastq
from cellweave.operators.rmt import flag_tag_errors
from cellweave.plans.run import correct_barcodes, mitochondrial_genes
from cellweave.sources import readers


def test_alignments_to_counts(spark, tmp_path):
    random.seed(2)
    white = ["".join(random.choice("ACGT") for _ in range(16)) for _ in range(6)]
    (tmp_path / "w.txt").write_text("\n".join(white) + "\n")
    gtf = []
    for g, (a, b) in enumerate(((100, 900), (2000, 3500), (2400, 2600)), 1):
        for kind in ("transcript", "exon"):
            gtf.append(f'chr1\ts\t{kind}\t{a}\t{b}\t.\t+\t.\tgene_id "ENSG{g:011d}.1";')
    (tmp_path / "a.gtf").write_text("\n".join(gtf) + "\n")
    sam, want = ["@HD\tVN:1"], {}
    for i in range(400):
        cell, tag = random.choice(white), "".join(random.choice("ACGT") for _ in range(10))
        place = random.choice([500, 3000])  # genes 1 and 2
        want.setdefault((cell, 1 if place == 500 else 2), set()).add(tag)
        sam.append(f":{cell}:{tag}:TTTT;r{i}\t0\tchr1\t{place}\t255\t4M\t*\t0\t0\tACGT\tIIII\tNH:i:1")
    sam.append(f":{white[0]}:ACGTACGTAC:TTTT;gap\t0\tchr1\t5000\t255\t4M\t*\t0\t0\tACGT\tIIII\tNH:i:1")
    (tmp_path / "a.sam").write_text("\n".join(sam) + "\n")
    out = str(tmp_path / "out")
    main(["run", "ten_x_v2", out, "--alignments", str(tmp_path / "a.sam"), "--annotation", str(tmp_path / "a.gtf"), "--whitelist", str(tmp_path / "w.txt"), "--min-poly-t", "1"], spark)
    from cellweave.functions import dna
    from pyspark.sql import functions as F

    got = {(r["c"], r["gene"]): r["n_molecules"] for r in spark.read.parquet(f"{out}/counts").withColumn("c", dna.decode(F.col("cell"))).collect()}
    assert got == {k: len(v) for k, v in want.items()}
    assert spark.read.parquet(f"{out}/reads").where("gene = 0").count() == 1
    main(["merge", str(tmp_path / "m"), f"{out}/counts", f"{out}/counts"], spark)
    assert spark.read.parquet(str(tmp_path / "m")).select("sample_number").distinct().count() == 2
    with pytest.raises(SystemExit):
        main(["run", "ten_x", out], spark)


@pytest.mark.parametrize("name", sorted(PLATFORMS))
def test_every_layout_annotates(spark, tmp_path, name):
    (tmp_path / "g.fastq").write_text("".join(f"@read{i}:PPPP:CCCCCCCCCCCCCC:TTTTTTTT\nACGTACGTACGTACGT\n+\nFFFFFFFFFFFFFFFF\n" for i in range(3)))
    (tmp_path / "b.fastq").write_text("".join(f"@read{i}\n{'ACGT' * 15}\n+\n{'F' * 60}\n" for i in range(2)))
    rows = merge_fastq(readers.fastq(spark, str(tmp_path / "g.fastq")), readers.fastq(spark, str(tmp_path / "b.fastq")), name).collect()
    assert len(rows) == 2 and all(r["name"].count(":") >= 3 and ";" in r["name"] for r in rows)


def test_every_whitelist_counts(spark):
    white = [spark.createDataFrame([(v,)], "barcode long") for v in (0o4444, 0o6666)]
    rows = spark.createDataFrame([(0, 0o4444, 1), (0, 0o6666, 2), (0, 0o3333, 3)], "status int, cell long, rmt long")
    done, rates = correct_barcodes(rows, "ten_x_v2", white)
    assert rates is None and {r["rmt"]: r["status"] != 0 for r in done.collect()} == {1: False, 2: False, 3: True}


def test_estimated_rates_decide_tag_errors(spark):
    rows = [(0, 1, 1, 0o444, 7)] * 50 + [(0, 1, 1, 0o446, 7)] * 3
    reads = spark.createDataFrame(rows, "status int, cell long, gene int, rmt long, position int")
    flagged = lambda rate: flag_tag_errors(reads, rates=spark.createDataFrame([(4, 6, rate)], "from_b int, to_b int, rate double")).where("status <> 0").count()
    assert flagged(0.2) == 3 and flagged(0.0001) == 0


def test_mitochondrial_genes_by_symbol(spark):
    rows = [("gene", {"gene_id": "ENSG00000000007", "gene_name": "mt-Nd1"}), ("gene", {"gene_id": "ENSG00000000008", "gene_name": "MTOR"}), ("exon", {"gene_id": "ENSG00000000009", "gene_name": "MT-CO1"}), ("gene", {"gene_id": "ENSG00000000010"})]
    got = mitochondrial_genes(spark.createDataFrame(rows, "feature string, attributes map<string,string>"))
    assert [r["gene"] for r in got.collect()] == [7]
