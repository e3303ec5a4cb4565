"""Column functions: barcodes, qualities, CIGAR strings, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The order in which equal posteriors are decided.
POSTERIOR_ORDER = ("A", "T", "C", "G")
#: Alleles of the count table, in column order, which also decides ties.
ALLELES = ("A", "C", "G", "T", "I", "D", "N")
#: Family-size thresholds, and those at which single reads count.
FAMILY_SIZES = (0, 1, 2, 3, 4, 5, 7, 10, 20, 30)
SINGLE_SIZES = (0, 1)
MAX_PHRED, HIGH_COVERAGE = 60, 50


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two strings, over the shorter length."""
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.isNull() | y.isNull(), 0).otherwise((x != y).cast("int")))
    return F.aggregate(same, F.lit(0), lambda s, x: s + x)


def error_of(phred: Column) -> Column:
    return F.pow(F.lit(10.0), -phred / 10.0)


def phreds(quality: Column, offset: int = 33) -> Column:
    """Quality string to an array of phreds."""
    return F.transform(F.split(quality, ""), lambda c: F.ascii(c) - offset)


def quality_string(values: Column, offset: int = 33) -> Column:
    return F.array_join(F.transform(values, lambda q: F.chr(q + offset)), "")


def barcode_of(qname: Column) -> Column:
    """The last field of a read name."""
    return F.substring_index(qname, ":", -1)


def cigar_ops(cigar: Column) -> Column:
    """array<struct<n, op>> of a CIGAR string."""
    n, op = F.regexp_extract_all(cigar, F.lit("(\\d+)([MIDNSHP=X])"), F.lit(1)), F.regexp_extract_all(cigar, F.lit("(\\d+)([MIDNSHP=X])"), F.lit(2))
    return F.zip_with(n, op, lambda a, b: F.struct(a.cast("int").alias("n"), b.alias("op")))


def run_lengths(letters: Column) -> Column:
    """A string of operation letters, run-length encoded as a CIGAR string."""
    runs = F.regexp_extract_all(letters, F.lit("((.)\\2*)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.length(r).cast("string"), F.left(r, F.lit(1)))), "")


def consensus_name(kind: str, region: Column, barcode: Column, count: Column) -> Column:
    return F.concat(F.lit(f"{kind}_read_"), region.cast("string"), F.lit("_"), barcode, F.lit("_Count="), count.cast("string"))


def name_kind(name: Column) -> Column:
    return F.split_part(name, F.lit("_"), F.lit(1))


def name_count(name: Column) -> Column:
    return F.substring_index(name, "=", -1).cast("int")


def sample_name(path: Column, mode: str = "single") -> Column:
    """Sample name from a file path: base name without archive and format endings; paired names lose the read mark."""
    base = F.regexp_replace(F.substring_index(path, "/", -1), r"\.(gz|bz2)$", "")
    base = F.regexp_replace(base, r"\.(fastq|fq|bam|sam)$", "")
    return F.regexp_replace(base, r"(_R?1(_001)?)$", "") if mode == "paired" else base
