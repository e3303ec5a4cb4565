"""Text formats: regions, mutations, count tables, sample sheets, SAM, FASTA, VCF."""

from __future__ import annotations

import csv
import fnmatch
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.functions.expr import ALLELES
from molcount.operators import counts, variants
from molcount.sources import lines

CONS = "sample string, contig string, position long, name string, reference string, " + ", ".join(f"{a} long" for a in ALLELES) + ", coverage long, fsize int, alt_count long, alt_frequency double, alt_allele string"
#: The header of the call format.
VCF_HEADER = ("##fileformat=VCFv4.2", '##INFO=<ID=DP,Number=1,Type=Integer,Description="Molecules at the position">', '##INFO=<ID=AD,Number=1,Type=Integer,Description="Molecules with the allele">', '##INFO=<ID=AF,Number=1,Type=Float,Description="Frequency of the allele">', '##FILTER=<ID=a5,Description="Less than 5 supporting molecules">', '##FILTER=<ID=q10,Description="Quality below 10">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")


def bed(spark: SparkSession, path: str) -> DataFrame:
    """Regions by white space; lines of fewer than four fields are skipped, further fields ignored."""
    f = F.split(F.trim("value"), r"\s+")
    x = spark.read.text(path).withColumn("f", f).where(F.size("f") >= 4)
    return x.select(F.col("f")[0].alias("contig"), F.col("f")[1].cast("long").alias("start"), F.col("f")[2].cast("long").alias("end"), F.col("f")[3].alias("name"), F.monotonically_increasing_id().alias("ord"))


def mutations(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated mutations; comments and blank lines are skipped, a line of fewer than six fields is an error that names file and line."""
    x = lines.numbered(spark, path).where((F.trim("value") != "") & ~F.col("value").startswith("#")).withColumn("f", F.split("value", "\t"))
    x = x.withColumn("f", F.when(F.size("f") >= 6, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("a mutation needs six fields: "), "file", F.lit(", line "), (F.col("line") + 1).cast("string"), F.lit(": "), "value"))))
    return x.select(F.col("f")[3].alias("name"), F.col("f")[0].alias("contig"), F.col("f")[1].cast("long").alias("position"), F.col("f")[4].alias("ref"), F.col("f")[5].alias("alt"), F.monotonically_increasing_id().alias("ord"))


def count_table(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=header, schema=CONS, encoding="ISO-8859-1").fillna("", ["name", "alt_allele"])


def write_count_table(table: DataFrame, path: str) -> None:
    """Tab-separated parts, each with the header, in order of position and threshold."""
    t = table.orderBy("contig", "position", "fsize").select(*[F.col(c).alias(h) for c, h in zip(counts.COLUMNS, counts.HEADER, strict=True)])
    t.write.mode("overwrite").csv(path, sep="\t", header=True, encoding="ISO-8859-1")


def write_vcf(calls: DataFrame, path: str) -> None:
    """Lines of calls in order of place after the header; parts joined in order of their names are the file."""
    head = calls.sparkSession.createDataFrame([(i, "", 0, h) for i, h in enumerate(VCF_HEADER)], "a int, b string, c long, value string")
    f = F.split("value", "\t")
    body = calls.select(F.lit(len(VCF_HEADER)).alias("a"), f[0].alias("b"), f[1].cast("long").alias("c"), "value")
    head.unionByName(body).orderBy("a", "b", "c", "value").select("value").write.mode("overwrite").text(path)


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Aligned reads of a SAM text file; positions from 0, tags as a map."""
    x = spark.read.text(path).where(~F.col("value").startswith("@")).withColumn("f", F.split("value", "\t"))
    tags = F.map_from_entries(F.transform(F.slice("f", F.lit(12), F.greatest(F.size("f") - 11, F.lit(0))), lambda t: F.struct(F.split_part(t, F.lit(":"), F.lit(1)), F.regexp_replace(t, "^[^:]*:[^:]*:", ""))))
    q = F.transform(F.split(F.col("f")[10], ""), lambda c: F.ascii(c) - 33)
    return x.select(F.col("f")[0].alias("qname"), F.col("f")[1].cast("int").alias("flag"), F.col("f")[2].alias("contig"), (F.col("f")[3].cast("long") - 1).alias("pos"), F.col("f")[4].cast("int").alias("mapq"), F.col("f")[5].alias("cigar"), F.col("f")[9].alias("seq"), q.alias("quals"), tags.alias("tags"), F.monotonically_increasing_id().alias("ordinal"))


def mapped_share(reads: DataFrame, total: int) -> DataFrame:
    """Mapped reads, and their share of the reads of the raw files."""
    n = F.count_if(F.col("flag").bitwiseAND(F.lit(4)) == 0)
    return reads.agg(n.alias("mapped"), F.try_divide(n, F.lit(total)).alias("share"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(contig, ref_pos, reference): a row for each base, of small references; ``lines.fasta_chunks`` is for large ones."""
    c = lines.fasta_chunks(spark, path).select("contig", "start", F.posexplode(F.split("bases", "")).alias("o", "reference"))
    return c.where("reference <> ''").select("contig", (F.col("start") + F.col("o")).alias("ref_pos"), "reference")


def preprocessing_report(spark: SparkSession, path: str) -> DataFrame:
    """Reads after filtering, their share of high quality and the duplication rate, from the filter's JSON report."""
    v = F.col("value")
    at = lambda p, t: F.get_json_object(v, p).cast(t)
    return spark.read.text(path, wholetext=True).select(at("$.summary.after_filtering.total_reads", "long").alias("total_reads"), at("$.summary.after_filtering.q20_rate", "double").alias("q20_rate"), at("$.duplication.rate", "double").alias("duplication"))


#: Names of files of first mates, with their mark, the second mates' mark and where the sample's name ends, by preference.
PATTERNS = (("*_R1*.fastq.gz", "_R1", "_R2", "_R1"), ("*_R1*.fastq", "_R1", "_R2", "_R1"), ("*_1.fastq.gz", "_1.", "_2.", "_1"), ("*_1.fastq", "_1.", "_2.", "_1"), ("*R1*.fastq.gz", "R1", "R2", "R1"), ("*R1*.fastq", "R1", "R2", "R1"))


def sample_of(files: list[str]) -> list[tuple[str, str, str | None]]:
    """(sample, first mates, second mates or none) of file paths, by name; the first pattern that fits a file names it."""
    have, found = set(files), []
    for path in sorted(files):
        folder, _, name = path.rpartition("/")
        for pattern, one, two, end in PATTERNS:
            if fnmatch.fnmatchcase(name, pattern):
                mate = (f"{folder}/" if folder else "") + name.replace(one, two)
                stem = re.sub(r"\.fastq(\.gz)?$", "", name).split(end)[0].rstrip("_")
                found.append((stem, path, mate if mate in have and mate != path else None))
                break
    return sorted(found)


def samples(folder: str) -> list[tuple[str, str, str | None]]:
    """``sample_of`` the files of a folder and all below it, of a driver's file system."""
    return sample_of([str(p) for p in Path(folder).rglob("*") if p.is_file()])


def samples_in_store(spark: SparkSession, folder: str) -> list[tuple[str, str, str | None]]:
    """``sample_of`` the files of a folder in any store that Spark reads; a row for each file reaches the driver."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.fastq*").load(folder).select("path").collect()
    return sample_of([r["path"] for r in rows])


def _sheet(path: str, names: dict[str, str], required: set[str], lower: bool) -> list[dict[str, str]]:
    text = Path(path).read_text()
    first = text.split("\n", 1)[0]
    mark = "\t" if first.count("\t") > first.count(",") else ","
    rows = [r for r in csv.reader(text.splitlines(), delimiter=mark) if any(c.strip() for c in r)]
    if not rows:
        raise ValueError("the sample sheet is empty")
    head = [h.strip().lower() if lower else h.strip() for h in rows[0]]
    head = [names.get(h, h) for h in head]
    if missing := required - set(head):
        raise ValueError(f"the sample sheet needs {', '.join(sorted(missing))}")
    return [dict(zip(head, [c.strip() for c in r], strict=False)) for r in rows[1:]]


def sample_sheet(path: str) -> list[dict[str, str]]:
    """Rows of a comma- or tab-separated sheet with quoting; header names go by lower case, sample, r1 and r2 are other names."""
    return _sheet(path, {"sample": "sample_name", "r1": "read1", "r2": "read2"}, {"sample_name", "read1"}, True)


#: Further columns of the sheet for analysis that are paths, and those that are numbers.
SHEET_PATHS, SHEET_NUMBERS = ("read1", "read2", "mutation_bed", "region_bed"), ("ml_plasma", "ng_input")
SHEET_TEXTS = ("patient_id", "sample_type", "collection_date")


def analysis_sheet(path: str, base: str | None = None) -> list[dict]:
    """Rows of a sheet for analysis: paths are taken from ``base`` where they are not absolute, empty fields are none."""
    out = []
    for row in _sheet(path, {}, {"sample_name", "read1", "mutation_bed"}, False):
        got: dict = {"sample_name": row["sample_name"]}
        for c in SHEET_PATHS:
            v = row.get(c)
            got[c] = None if not v else v if base is None or v.startswith("/") or "://" in v else f"{base.rstrip('/')}/{v}"
        got |= {c: float(row[c]) if row.get(c) else None for c in SHEET_NUMBERS} | {c: row.get(c) or None for c in SHEET_TEXTS}
        out.append(got)
    return out


def count_tables(spark: SparkSession, pattern: str) -> DataFrame:
    """The count tables of many samples, as ``results/*/*_cons.tsv``; folder: the name of the folder that holds each."""
    x = spark.read.csv(pattern, sep="\t", header=True, schema=CONS, encoding="ISO-8859-1").withColumn("folder", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))
    return x.fillna("", ["name", "alt_allele"])


def summary_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Rows of summary statistics in seven columns without a header; rows whose threshold is no number (a header) go."""
    x = spark.read.csv(path, sep="\t", schema="region string, place string, name string, f string, fraction string, reads string, umis string")
    number = lambda c, t: F.col(c).try_cast(t).alias(c)
    return x.withColumn("path", F.col("_metadata.file_path")).select("path", "region", "place", F.coalesce("name", F.lit("")).alias("name"), number("f", "int"), number("fraction", "double"), number("reads", "long"), number("umis", "long")).where("f is not null")


def background(path: str | None = None) -> tuple[float, float]:
    """alpha and beta of the background: two lines of a file, or the defaults."""
    if path is None:
        return variants.ALPHA, variants.BETA
    a, b = Path(path).read_text().split()[:2]
    return float(a), float(b)


def one_bam(folder: str) -> str:
    """The only BAM file of a folder; none or several are an error."""
    found = sorted(str(p) for p in Path(folder).glob("*.bam"))
    if len(found) != 1:
        raise ValueError(f"{folder} holds {len(found)} BAM files, not one")
    return found[0]


def write_fastq(reads: DataFrame, path: str) -> None:
    """Reads (name, seq, qual) as gzipped text, a part for each partition."""
    record = F.concat(F.regexp_replace("name", "^@?", "@"), F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    reads.select(record.alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def write_sam(reads: DataFrame, lengths: DataFrame, path: str) -> None:
    """Consensus reads as SAM text in order of place: header lines of the contigs (contig, length) and a read group.

    Parts joined in order of their names are the file; the first begins with the header.

    reads: name, contig, start, seq, qual, cigar. Mapping quality is 60.
    """
    spark = reads.sparkSession
    head = lengths.select(F.struct(F.lit(1).alias("a"), F.col("contig").alias("b"), F.lit(0).cast("long").alias("c"), F.lit("").alias("d")).alias("k"), F.format_string("@SQ\tSN:%s\tLN:%d", "contig", F.col("length").cast("long")).alias("value"))
    top = spark.createDataFrame([(0, "", 0, "", "@HD\tVN:1.6\tSO:coordinate"), (2, "", 0, "", "@RG\tID:L1\tSM:L1")], "a int, b string, c long, d string, value string").select(F.struct("a", "b", "c", "d").alias("k"), "value")
    line = F.concat_ws("\t", "name", F.lit("0"), "contig", (F.col("start") + 1).cast("string"), F.lit("60"), "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual", F.lit("RG:Z:L1"))
    body = reads.select(F.struct(F.lit(3).alias("a"), F.col("contig").alias("b"), F.col("start").cast("long").alias("c"), F.col("name").alias("d")).alias("k"), line.alias("value"))
    top.unionByName(head).unionByName(body).orderBy("k").select("value").write.mode("overwrite").text(path)


def write_rows(rows: DataFrame, path: str, order: list[str]) -> None:
    """A result over samples as one tab-separated file with a header."""
    rows.orderBy(*order).coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True)
