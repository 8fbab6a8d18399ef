import gzip
import struct

import pytest
from pyspark.sql import functions as F

from cellweave.functions import dna
from cellweave.sources import readers, writers
from cellweave.streaming.counts import count_stream, counts_so_far


def test_fastq(spark, tmp_path):
    text = "".join(f"@r{i}:x;o{i}|k=v:a=b\nACGT{'A' * i}\n+\nIIII{'!' * i}\n" for i in range(5)) + "@cut\nAC\n"
    (tmp_path / "a.fastq").write_text(text)
    with gzip.open(tmp_path / "b.fastq.gz", "wt") as f:
        f.write(text)
    for name in ("a.fastq", "b.fastq.gz"):
        rows = readers.fastq(spark, str(tmp_path / name)).orderBy("ord").collect()
        assert [(r["ord"], r["sequence"]) for r in rows] == [(i, "ACGT" + "A" * i) for i in range(5)]
    rec = readers.fastq(spark, str(tmp_path / "a.fastq"))
    assert readers.mean_length(rec)[0] == 6.0
    one = rec.where("ord = 1").select(readers.annotations(F.col("name")).alias("a"), readers.metadata(F.col("name")).alias("m"), readers.average_quality(F.col("quality")).alias("q")).first()
    assert one["a"] == ["r1", "x"] and one["m"] == {"k": "v", "a": "b"} and one["q"] == (73 * 4 + 33) // 5 - 33
    writers.write_fastq(rec, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 20
    writers.write_truncated_fastq(rec, str(tmp_path / "cut"), [3, 50])
    assert {len(r["sequence"]) for r in readers.fastq(spark, str(tmp_path / "cut" / "len=3")).collect()} == {3}
    assert readers.size_in_bytes(spark, str(tmp_path / "a.fastq")) == len(text)
    with pytest.raises(TypeError):
        readers.lines(spark, 5)


SAM_TEXT = "@HD\tVN:1\n:ACGT:ACC:TTNA;r1\t0\tchr1\t12\t255\t4M\t*\t0\t0\tACGT\tIIII\tNH:i:2\tXX:Z:y\n:ACGT:ACC:TTNA;r1\t16\tchr1\t40\t255\t4M\t*\t0\t0\tACGT\tIIII\tNH:i:2\n;r2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n"


def test_sam(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM_TEXT)
    rows = readers.flag_columns(readers.sam(spark, str(tmp_path / "a.sam")))
    assert [(r["pos"], r["strand"], r["is_multimapped"], r["is_unmapped"], r["tags"]) for r in rows.collect()] == [(12, "+", True, False, {"NH": 2}), (40, "-", True, False, {"NH": 2}), (0, "+", False, True, {})]
    genes = spark.createDataFrame([("chr1", "+", 10, 20, 7)], "chrom string, strand string, start long, end long, gene int")
    table = {r["n_poly_t"]: r for r in readers.read_table(rows, genes).collect()}
    assert [tuple(a) for a in table[3]["alignments"]] == [(7, 12)] and table[3]["cell"] == 0o4653 and table[0]["alignments"] == []


def test_bam(spark, tmp_path):
    def record(name, ref, pos, flag, seq, tags):
        packed = bytes("=ACMGRSVTWYHKDBN".index(a) << 4 | "=ACMGRSVTWYHKDBN".index(b) for a, b in zip(seq[::2], (seq + "=")[1::2]))
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 60, 0, 1, flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + struct.pack("<I", len(seq) << 4) + packed + bytes([40] * len(seq)) + tags
        return struct.pack("<i", len(body)) + body

    raw = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000)
    raw += record("r1", 0, 11, 0, "ACGTN", b"NHC\x02" + b"XXZhi\0") + record("r2", -1, -1, 4, "AC", b"")
    (tmp_path / "a.bam").write_bytes(gzip.compress(raw))
    rows = readers.bam(spark, str(tmp_path / "a.bam")).collect()
    assert [(r["qname"], r["rname"], r["pos"], r["cigar"], r["seq"], r["tags"]) for r in rows] == [("r1", "chr1", 12, "5M", "ACGTN", {"NH": 2}), ("r2", "*", 0, "2M", "AC", {})]


def test_gtf_and_logs(spark, tmp_path):
    lines = ["#c", 'c\ts\tgene\t1\t9\t.\t+\t.\tgene_id "ENSG00000000007.2"; gene_name "abc";'] + [f'c\ts\t{k}\t{a}\t{b}\t.\t+\t.\tgene_id "G";' for k, a, b in (("transcript", 1, 9), ("exon", 1, 3), ("exon", 5, 9))]
    (tmp_path / "a.gtf").write_text("\n".join(lines) + "\n")
    rows = readers.gtf(spark, str(tmp_path / "a.gtf")).orderBy("line").collect()
    assert rows[0]["attributes"] == {"gene_id": "ENSG00000000007.2", "gene_name": "abc"} and [r["feature"] for r in rows] == ["gene", "transcript", "exon", "exon"]
    from cellweave.operators.annotation import tiles, transcripts

    assert [r["transcript"] for r in transcripts(readers.gtf(spark, str(tmp_path / "a.gtf"))).collect()] == [1, 1]
    assert tiles("phi", 2500).count() == 6
    (tmp_path / "w.txt").write_text("ACGT\nTTTT\n")
    assert {r[0] for r in readers.whitelist(spark, str(tmp_path / "w.txt")).collect()} == {0o4653, 0o3333}
    (tmp_path / "s.txt").write_text("  Number of input reads |\t100\n Uniquely mapped reads % |\t80.5%\n % of reads mapped to multiple loci |\t5.00%\n% of reads unmapped: too short |\t4%\n% of reads unmapped: other |\t1.5%\n")
    got = readers.alignment_metrics(readers.alignment_summary(spark, str(tmp_path / "s.txt"))).first()
    assert (got["n_reads"], got["unique_percent"], got["multi_percent"], got["unmapped_percent"]) == (100, 80.5, 5.0, 5.5)
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "x.log").write_text("total reads: 12\n")
    assert readers.run_logs(spark, str(tmp_path / "logs"), {"reads": r"reads: (\d+)", "none": r"zz(\d+)"}).collect()[0]["value"] == 12.0


def test_writers_and_archive(spark, tmp_path):
    c = spark.createDataFrame([(5, 2, 3, 2), (9, 1, 4, 4)], "cell long, gene int, n_reads long, n_molecules long")
    writers.write_matrix_market(c, str(tmp_path / "m"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "m")).collect()][-2:] == ["1 2 2", "2 1 4"]
    box = writers.Archive(spark, str(tmp_path / "box"))
    box.save(c, "counts")
    assert box.ls() == ["counts"] and box.load("counts").count() == 2
    box.remove("counts")
    assert box.ls() == []
    assert "<td>5</td>" in writers.summary_html({"a": {"cells": 5}}) and writers.summary_json(c.limit(1)).startswith("{")


def test_streamed_counts(spark, tmp_path):
    rows = spark.createDataFrame([(0, 1, 1, 5), (0, 1, 1, 5), (4, 1, 1, 6), (0, 2, 1, 6)], "status int, cell long, gene int, rmt long")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    count_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert {tuple(r) for r in counts_so_far(spark, str(tmp_path / "out")).collect()} == {(1, 1, 2, 1), (2, 1, 1, 1)}


def test_encode_rejects_other_symbols(spark):
    with pytest.raises(Exception, match="not a DNA"):
        spark.range(1).select(dna.encode(F.lit("ACX"))).collect()


def test_log_templates_repeat_and_choose(spark, tmp_path):
    new, old = "run {n} of {name}\n{divide}\nagain {name}: {share}%", "reads: {n}"
    (tmp_path / "a.log").write_text("run 12 of x\n-------\nagain x: 40.5%")
    (tmp_path / "b.log").write_text("run 12 of x\n---\nagain y: 40.5%")
    (tmp_path / "c.log").write_text("reads: 7")
    (tmp_path / "d.skip").write_text("reads: 8")
    rows = readers.log_fields(spark, str(tmp_path), [new, old], exclude=r"\.skip$").collect()
    assert {(r["source"].rsplit("/", 1)[1], r["field"], r["text"]) for r in rows} == {("a.log", "n", "12"), ("a.log", "name", "x"), ("a.log", "share", "40.5"), ("c.log", "n", "7")}


def test_csv_index_and_gtf_text(spark, tmp_path):
    (tmp_path / "m.csv").write_text(",g1,g2\nc1,3,0\nc2,1,5\n")
    rows = readers.csv_table(spark, str(tmp_path / "m.csv"), "cell")
    assert [tuple(r) for r in rows.orderBy("cell").collect()] == [("c1", 3, 0), ("c2", 1, 5)]
    text = 'chr1\thavana\tgene\t10\t20\t.\t+\t.\tgene_id "ENSG1"; gene_name "a";'
    (tmp_path / "a.gtf").write_text("#!head\n" + text + "\n")
    writers.write_gtf(readers.gtf(spark, str(tmp_path / "a.gtf")), str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()] == [text]


def test_run_logs_match_over_lines_and_once(spark, tmp_path):
    (tmp_path / "a.log").write_text("reads\n  12\nreads\n  13\n")
    rows = readers.run_logs(spark, str(tmp_path), {"n": r"reads\s+([0-9]+)"}).collect()
    assert [(r["field"], r["value"]) for r in rows] == [("n", 12.0)]
