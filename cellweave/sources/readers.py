"""Text sources: FASTQ, SAM, BAM, GTF, whitelists, aligner summaries, run logs."""

from __future__ import annotations

import gzip
import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.functions import dna
from cellweave.schemas import SAM


def lines(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """Lines of one or several files, compressed or not by suffix."""
    if not isinstance(files, str) and not (isinstance(files, (list, tuple)) and all(isinstance(f, str) for f in files)):
        raise TypeError("files is a path or a list of paths")
    return spark.read.text([files] if isinstance(files, str) else list(files))


def numbered_lines(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """Lines with file and number within the file, from 0.

    A line's number is its partition's offset plus its place in it; a job over the partitions'
    counts gives the offsets, and no partition is sorted.
    """
    raw = lines(spark, files).withColumn("file", F.col("_metadata.file_path")).withColumn("__at", F.monotonically_increasing_id())
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    cells = raw.groupBy(part.alias("part"), "file").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    start = cells.withColumn("offset", F.sum("n").over(Window.partitionBy("file").orderBy("part")) - F.col("n"))
    return raw.withColumn("part", part).join(start.select("part", "file", "first", "offset"), ["part", "file"]).select("file", (place - F.col("first") + F.col("offset")).alias("line"), "value")


def size_in_bytes(spark: SparkSession, files: str | list[str]) -> int:
    rows = spark.read.format("binaryFile").load([files] if isinstance(files, str) else list(files)).agg(F.sum("length")).first()
    return rows[0] or 0


def fastq(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """file, ord, name, sequence, name2, quality: four lines a record; an incomplete last one is left out."""
    at = F.col("line") % 4
    cells = [F.max(F.when(at == k, F.col("value"))).alias(n) for k, n in enumerate(("name", "sequence", "name2", "quality"))]
    rows = numbered_lines(spark, files).groupBy("file", F.floor(F.col("line") / 4).alias("ord")).agg(*cells, F.count(F.lit(1)).alias("__n"))
    return rows.where("__n = 4").drop("__n")


def annotations(name: Column) -> Column:
    """Fields before the first ';' of a record name, without the leading '@'; none where there is no ';'."""
    return F.when(F.instr(name, ";") > 0, F.split(F.regexp_replace(F.substring_index(name, ";", 1), "^@", ""), ":")).otherwise(F.array().cast("array<string>"))


def metadata(name: Column) -> Column:
    """Map of k=v pairs after the last '|' of a record name; empty where there is none."""
    return F.when(F.instr(name, "|") > 0, F.str_to_map(F.substring_index(name, "|", -1), F.lit(":"), F.lit("="))).otherwise(F.create_map().cast("map<string,string>"))


def average_quality(quality: Column) -> Column:
    """Mean Phred score: the mean code, truncated, less 33."""
    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(F.length(quality), F.lit(1))), lambda i: F.ascii(F.substr(quality, i, F.lit(1)))), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(quality) > 0, F.floor(total / F.length(quality)).cast("int") - 33)


def sequence_lengths(records: DataFrame, first: int = 10_000) -> DataFrame:
    """length and n of the first records."""
    return records.orderBy("ord").limit(first).groupBy(F.length("sequence").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def mean_length(records: DataFrame, first: int = 10_000) -> tuple[float, float]:
    """Mean and population standard deviation of the first records' lengths."""
    row = records.orderBy("ord").limit(first).agg(F.avg(F.length("sequence")).alias("m"), F.stddev_pop(F.length("sequence")).alias("s")).first()
    return float(row["m"] or 0.0), float(row["s"] or 0.0)


def _sam_columns(f: Column) -> list[Column]:
    names = [x.name for x in SAM][:-1]
    whole = {"flag", "pos", "mapq", "pnext", "tlen"}
    tags = F.transform(F.filter(F.slice(f, 12, F.greatest(F.size(f) - 11, F.lit(1))), lambda t: F.split(t, ":")[1] == "i"), lambda t: F.struct(F.substring_index(t, ":", 1), F.substring_index(t, ":", -1).try_cast("int")))
    return [(F.get(f, F.lit(i)).cast("int") if n in whole else F.get(f, F.lit(i))).alias(n) for i, n in enumerate(names)] + [F.map_from_entries(tags).alias("tags")]


def sam(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """SAM records without headers; optional integer tags as a map."""
    f = F.split("value", "\t")
    return lines(spark, files).where(~F.col("value").startswith("@") & (F.size(f) >= 11)).select(*_sam_columns(f))


def _bam_records(raw: bytes) -> Iterator[dict]:
    data = gzip.decompress(raw)
    if data[:4] != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + struct.unpack_from("<i", data, 4)[0]
    n, at, refs = struct.unpack_from("<i", data, at)[0], at + 4, []
    for _ in range(n):
        size = struct.unpack_from("<i", data, at)[0]
        refs.append(data[at + 4 : at + 3 + size].decode())
        at += 8 + size
    name_of = lambda i: refs[i] if 0 <= i < len(refs) else "*"
    wide = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}
    while at < len(data):
        size = struct.unpack_from("<i", data, at)[0]
        ref, pos, l_name, mapq, _, n_cigar, flag, l_seq, next_ref, next_pos, tlen = struct.unpack_from("<iiBBHHHiiii", data, at + 4)
        o, end = at + 36, at + 4 + size
        qname, o = data[o : o + l_name - 1].decode(), o + l_name
        cigar = "".join(f"{c >> 4}{'MIDNSHP=X'[c & 15]}" for c in struct.unpack_from(f"<{n_cigar}I", data, o)) or "*"
        o += 4 * n_cigar
        packed, o = data[o : o + (l_seq + 1) // 2], o + (l_seq + 1) // 2
        seq = "".join("=ACMGRSVTWYHKDBN"[b >> 4] + "=ACMGRSVTWYHKDBN"[b & 15] for b in packed)[:l_seq] or "*"
        q, o = data[o : o + l_seq], o + l_seq
        qual = "".join(chr(x + 33) for x in q) if q and q[0] != 255 else "*"
        tags = {}
        while o < end:
            key, kind, o = data[o : o + 2].decode(), chr(data[o + 2]), o + 3
            if kind in wide:
                value = struct.unpack_from(wide[kind], data, o)[0]
                o += struct.calcsize(wide[kind])
                if kind != "f":
                    tags[key] = value
            elif kind == "A":
                o += 1
            elif kind in "ZH":
                o = data.index(b"\0", o) + 1
            elif kind == "B":
                sub, count = chr(data[o]), struct.unpack_from("<i", data, o + 1)[0]
                o += 5 + count * struct.calcsize(wide[sub])
        yield {"qname": qname, "flag": flag, "rname": name_of(ref), "pos": pos + 1, "mapq": mapq, "cigar": cigar, "rnext": "=" if next_ref == ref and ref >= 0 else name_of(next_ref), "pnext": next_pos + 1, "tlen": tlen, "seq": seq, "qual": qual, "tags": tags}
        at = end


def bam(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """Records of BAM files, one task a file: a file is read whole, so large ones are split by an aligner's shards."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for raw in b["content"]:
                rows: list[dict] = []
                for r in _bam_records(bytes(raw)):
                    rows.append(r)
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows)

    return spark.read.format("binaryFile").load([files] if isinstance(files, str) else list(files)).select("content").mapInPandas(each, SAM)


def name_fields(qname: Column) -> Column:
    """struct(pool, cell, rmt, poly_t, name) of an annotated read name."""
    f = F.split(F.substring_index(qname, ";", 1), ":")
    parts = [F.get(f, F.lit(i)).alias(n) for i, n in enumerate(("pool", "cell", "rmt", "poly_t"))]
    return F.struct(*parts, F.substr(qname, F.instr(qname, ";") + 1).alias("name"))


def flag_columns(records: DataFrame) -> DataFrame:
    """Adds is_unmapped, is_multimapped, is_unique and strand."""
    unmapped = F.col("flag").bitwiseAND(F.lit(4)) != 0
    hits = F.try_element_at("tags", F.lit("NH"))
    return records.withColumns({"is_unmapped": unmapped, "is_multimapped": F.coalesce(hits > 1, F.lit(False)), "is_unique": F.coalesce(hits == 1, F.lit(False)), "strand": F.when(F.col("flag").bitwiseAND(F.lit(16)) != 0, "-").otherwise("+")})


def multi_alignments(records: DataFrame) -> DataFrame:
    """One row for each read name with its mapped places, in order of place."""
    mapped = F.col("flag").bitwiseAND(F.lit(4)) == 0
    strand = F.when(F.col("flag").bitwiseAND(F.lit(16)) != 0, "-").otherwise("+")
    place = F.when(mapped, F.struct(F.col("rname").alias("chrom"), strand.alias("strand"), F.col("pos").alias("pos")))
    return records.groupBy("qname").agg(F.array_sort(F.collect_list(place)).alias("places"))


def read_table(records: DataFrame, intervals: DataFrame) -> DataFrame:
    """The read table of annotated alignments: read_id, status 0, cell, rmt, n_poly_t, alignments with a gene."""
    from cellweave.operators.annotation import genes_at
    from cellweave.operators.reads import n_poly_t

    reads = multi_alignments(records)
    places = reads.select("qname", F.explode("places").alias("p")).select("qname", "p.*")
    found = genes_at(places, intervals, ["qname"]).where("gene is not null")
    lists = found.groupBy("qname").agg(F.array_sort(F.collect_list(F.struct("gene", F.col("pos").alias("position")))).alias("alignments"))
    field = name_fields(F.col("qname"))
    packed = lambda s: F.when(F.length(s) > 0, dna.encode(s)).otherwise(F.lit(0).cast("long"))
    return reads.select("qname").join(lists, "qname", "left").select(
        F.xxhash64("qname").alias("read_id"), F.lit(0).alias("status"), packed(field["cell"]).alias("cell"), packed(field["rmt"]).alias("rmt"),
        n_poly_t(F.coalesce(field["poly_t"], F.lit(""))).alias("n_poly_t"), F.coalesce("alignments", F.array().cast("array<struct<gene:int,position:int>>")).alias("alignments"),
    )


def gtf(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """line, the nine GTF columns, and attributes as a map; comment lines are left out."""
    f = F.split("value", "\t")
    rows = numbered_lines(spark, files).where(~F.col("value").startswith("#") & (F.size(f) >= 9))
    names = ("seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attribute")
    cols = [(F.get(f, F.lit(i)).cast("long") if n in ("start", "end") else F.get(f, F.lit(i))).alias(n) for i, n in enumerate(names)]
    return rows.select("line", *cols).withColumn("attributes", attributes(F.col("attribute")))


def attributes(text: Column) -> Column:
    """Map of a GTF attribute column: key "value"; pairs, the first of equal keys."""
    pairs = F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: F.instr(x, " ") > 0)
    entries = F.transform(pairs, lambda x: F.struct(F.substring_index(x, " ", 1).alias("k"), F.translate(F.substr(x, F.instr(x, " ") + 1), '"', "").alias("v")))
    first = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, 1, F.greatest(i, F.lit(1))), lambda b: (b["k"] == e["k"]) & (i > 0)))
    return F.map_from_entries(first)


def whitelist(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """Packed barcodes of files with one sequence a line."""
    return lines(spark, files).where(F.trim("value") != "").select(dna.encode(F.trim("value")).alias("barcode")).distinct()


def alignment_summary(spark: SparkSession, path: str) -> DataFrame:
    """key and value of an aligner's summary."""
    return lines(spark, path).where(F.instr("value", "|") > 0).select(F.trim(F.substring_index("value", "|", 1)).alias("key"), F.trim(F.substring_index("value", "|", -1)).alias("value"))


def alignment_metrics(summary: DataFrame) -> DataFrame:
    """n_reads, uniquely mapped, multi-mapped and unmapped percentages of a summary."""
    percent = F.regexp_replace("value", "%", "").try_cast("double")
    pick = lambda test: F.sum(F.when(test, percent))
    key = F.col("key")
    return summary.agg(
        F.max(F.when(key == "Number of input reads", F.col("value").try_cast("long"))).alias("n_reads"),
        pick(key == "Uniquely mapped reads %").alias("unique_percent"),
        pick(key.isin("% of reads mapped to multiple loci", "% of reads mapped to too many loci")).alias("multi_percent"),
        pick(key.startswith("% of reads unmapped")).alias("unmapped_percent"),
    )


def run_logs(spark: SparkSession, path: str, patterns: dict[str, str], exclude: str | None = None) -> DataFrame:
    """source, field and value (double) of the first match of each pattern's group in every log under a folder."""
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).withColumn("source", F.col("_metadata.file_path"))
    if exclude:
        raw = raw.where(~F.col("source").rlike(exclude))
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.regexp_extract("value", p, 1).try_cast("double").alias("value")) for k, p in patterns.items()]))
    return raw.select("source", cells.alias("c")).select("source", "c.field", "c.value").where("value is not null")


def log_pattern(template: str, rule: str = "divide") -> tuple[str, list[str]]:
    """(regular expression, names of its groups) of a log template with {name} fields.

    A field that comes again must repeat its first text; {divide} is a rule of dashes of any length.
    """
    names: list[str] = []

    def group(name: str) -> str:
        if name == rule:
            return "-*"
        if name in names:
            return rf"\{names.index(name) + 1}(?![0-9])"
        names.append(name)
        return "(.*?)"

    parts = re.split(r"\{([A-Za-z_][A-Za-z0-9_]*)\}", template)
    text = "".join(group(p) if i % 2 else re.escape(p) for i, p in enumerate(parts))
    return f"(?s){text}$" if len(parts) > 1 and not parts[-1] else f"(?s){text}", names


def log_fields(spark: SparkSession, path: str, templates: list[str], exclude: str | None = None) -> DataFrame:
    """source, field, text of every log under a folder by the first template that matches it; other logs give no row."""
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).withColumn("source", F.col("_metadata.file_path"))
    if exclude:
        raw = raw.where(~F.col("source").rlike(exclude))
    found = F.lit(None).cast("array<struct<field:string,text:string>>")
    for template in reversed(templates):
        pattern, names = log_pattern(template)
        fields = F.array(*[F.struct(F.lit(n).alias("field"), F.regexp_extract("value", pattern, i + 1).alias("text")) for i, n in enumerate(names)])
        found = F.when(F.col("value").rlike(pattern), fields).otherwise(found)
    return raw.select("source", F.inline(found))


def csv_table(spark: SparkSession, path: str, index: str = "index", sep: str = ",") -> DataFrame:
    """A CSV file with a header whose first column is the index, under a given name; types are found from the values."""
    rows = spark.read.option("header", True).option("inferSchema", True).option("sep", sep).csv(path)
    return rows.withColumnRenamed(rows.columns[0], index)
