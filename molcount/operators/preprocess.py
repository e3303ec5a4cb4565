"""Row-wise preparation of raw reads (name, seq, qual)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molcount.operators import alignment


def named(name: Column, barcode: Column) -> Column:
    """First word of the name, the barcode after a colon, and the last word (a single word counts as both)."""
    words = F.split(name, " ")
    return F.concat(words[0], F.lit(":"), barcode, F.lit(" "), F.element_at(words, -1))


def extract(reads: DataFrame, length: int, spacer: int = 0) -> DataFrame:
    """The barcode from the read's first bases; it and the spacer are cut off."""
    cut = length + spacer + 1
    x = reads.withColumn("barcode", F.substring("seq", 1, length))
    return x.select(named(F.col("name"), F.col("barcode")).alias("name"), "barcode", F.substring(F.col("seq"), F.lit(cut), F.length("seq")).alias("seq"), F.substring(F.col("qual"), F.lit(cut), F.length("qual")).alias("qual"))


def extract_pairs(pairs: DataFrame, length: int, spacer: int = 0, dual: bool = False, reverse: bool = False) -> DataFrame:
    """pairs: name1, seq1, qual1, name2, seq2, qual2. The barcode is that of the first mate, or of both joined; the
    second is cut only then. reverse swaps the mates first."""
    if reverse:
        pairs = pairs.selectExpr("name2 as name1", "seq2 as seq1", "qual2 as qual1", "name1 as name2", "seq1 as seq2", "qual1 as qual2")
    cut = F.lit(length + spacer + 1)
    code = F.concat(F.substring("seq1", 1, length), F.substring("seq2", 1, length)) if dual else F.substring("seq1", 1, length)
    x = pairs.withColumn("barcode", code)
    tail = lambda c: F.substring(F.col(c), cut, F.length(c))
    second = [tail(c).alias(c) for c in ("seq2", "qual2")] if dual else [F.col("seq2"), F.col("qual2")]
    return x.select(named(F.col("name1"), F.col("barcode")).alias("name1"), tail("seq1").alias("seq1"), tail("qual1").alias("qual1"), named(F.col("name2"), F.col("barcode")).alias("name2"), *second, "barcode")


def paired(first: DataFrame, second: DataFrame) -> DataFrame:
    """Mates by their order in the files (ordinal), up to the shorter one."""
    a = first.select("ordinal", *[F.col(c).alias(f"{c}1") for c in ("name", "seq", "qual")])
    b = second.select("ordinal", *[F.col(c).alias(f"{c}2") for c in ("name", "seq", "qual")])
    return a.join(b, "ordinal")


def quality_filter(reads: DataFrame, mean: float = 0.0, qualified: int = 15, share: float = 0.4, least: int = 0) -> DataFrame:
    """Reads of enough mean phred, with at most a share of bases below the qualified phred, and long enough."""
    return reads.where(_passes("seq", "qual", mean, qualified, share, least))


def _passes(seq: str, qual: str, mean: float, qualified: int, share: float, least: int) -> Column:
    q = F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33)
    low = F.size(F.filter(q, lambda v: v < qualified))
    total = F.aggregate(q, F.lit(0), lambda s, v: s + v)
    n = F.greatest(F.length(qual), F.lit(1))
    return (total / n >= mean) & (low / n <= share) & (F.length(seq) >= least)


#: Adapters by name.
ADAPTERS = {"illumina": "AGATCGGAAGAGC", "nextera": "CTGTCTCTTATA", "small-rna": "ATGGAATTCTCG"}


def _cut(reads: DataFrame, adapter: str, overlap: int, rate: float, seq: str, qual: str) -> DataFrame:
    adapter = ADAPTERS.get(adapter.lower(), adapter.upper())

    @F.pandas_udf("int")
    def start(texts: pd.Series) -> pd.Series:
        return pd.Series(alignment.adapter_starts(texts.fillna("").tolist(), adapter, rate, overlap).astype("int32"))

    x = reads.withColumn("at_", start(F.col(seq)))
    return x.withColumns({seq: F.left(F.col(seq), F.col("at_")), qual: F.left(F.col(qual), F.col("at_"))}).drop("at_")


def trim_adapter(reads: DataFrame, adapter: str, overlap: int = 3, least: int = 20, rate: float = 0.1) -> DataFrame:
    """An adapter (by name or letters), or a start of it of at least ``overlap`` bases at the read's end, is cut off with what
    follows, with up to ``rate`` errors a base; reads shorter than ``least`` go."""
    return _cut(reads, adapter, overlap, rate, "seq", "qual").where(F.length("seq") >= least)


def trim_adapter_pairs(pairs: DataFrame, adapter: str, overlap: int = 3, least: int = 20, rate: float = 0.1) -> DataFrame:
    """Both mates are cut alike; a pair goes if one of them is shorter than ``least``."""
    x = _cut(_cut(pairs, adapter, overlap, rate, "seq1", "qual1"), adapter, overlap, rate, "seq2", "qual2")
    return x.where((F.length("seq1") >= least) & (F.length("seq2") >= least))


def quality_filter_pairs(pairs: DataFrame, mean: float = 0.0, qualified: int = 15, share: float = 0.4, least: int = 0) -> DataFrame:
    """Pairs both of whose mates pass ``quality_filter``."""
    return pairs.where(_passes("seq1", "qual1", mean, qualified, share, least) & _passes("seq2", "qual2", mean, qualified, share, least))


def merge_pairs(pairs: DataFrame, least: int = 30, most: int = 5, share: float = 0.2) -> DataFrame:
    """pairs with merged_seq, merged_qual, offset and mismatches of mates that overlap (none of them: null).

    The best offset of the second mate's reversed complement is the one with the smallest share of unlike bases; a merged base is that
    of higher quality.
    """

    @F.pandas_udf("merged_seq string, merged_qual string, offset int, mismatches int")
    def merge(s1: pd.Series, q1: pd.Series, s2: pd.Series, q2: pd.Series) -> pd.DataFrame:
        a, b, c, d = (x.fillna("").tolist() for x in (s1, q1, s2, q2))
        found = alignment.overlaps(a, c, least, most, share)
        rows = [(None, None, None, None) if f is None else (*alignment.merged(a[i], b[i], c[i], d[i], f[0]), *f) for i, f in enumerate(found)]
        return pd.DataFrame(rows, columns=["merged_seq", "merged_qual", "offset", "mismatches"]).astype({"offset": "Int32", "mismatches": "Int32"})

    return pairs.withColumn("m_", merge("seq1", "qual1", "seq2", "qual2")).select("*", "m_.*").drop("m_")


def prepared(one: DataFrame, two: DataFrame | None, length: int, spacer: int = 0, dual: bool = False, reverse: bool = False, mean: float = 0.0, adapter: str | None = None, merge: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(reads, pairs): raw reads filtered, mates merged, adapters cut and barcodes taken out, in this order.

    With ``merge`` mates that overlap go on as single reads, the others as pairs; a single input has no pairs. The barcode of a
    merged read is that of its first mate, and with ``dual`` also the second's, which stands reversed at its end.
    """
    if two is None:
        x = quality_filter(one, mean=mean) if mean else one
        x = trim_adapter(x, adapter) if adapter else x
        return extract(x, length, spacer), None
    pairs = paired(one, two)
    if reverse:
        pairs = pairs.selectExpr("ordinal", "name2 as name1", "seq2 as seq1", "qual2 as qual1", "name1 as name2", "seq1 as seq2", "qual1 as qual2")
    pairs = quality_filter_pairs(pairs, mean=mean) if mean else pairs
    if not merge:
        x = trim_adapter_pairs(pairs, adapter) if adapter else pairs
        return None, extract_pairs(x, length, spacer, dual)
    x = merge_pairs(pairs)
    apart = x.where("merged_seq is null").drop("merged_seq", "merged_qual", "offset", "mismatches")
    apart = extract_pairs(trim_adapter_pairs(apart, adapter) if adapter else apart, length, spacer, dual)
    cut = F.lit(length + spacer)
    both = x.where("merged_seq is not null")
    keep = F.length("merged_seq") - cut * (2 if dual else 1)
    code = F.concat(F.left("seq1", F.lit(length)), F.left("seq2", F.lit(length))) if dual else F.left("seq1", F.lit(length))
    inner = lambda c: F.substring(F.col(c), cut + 1, F.greatest(keep, F.lit(0)))
    single = both.select(named(F.col("name1"), code).alias("name"), code.alias("barcode"), inner("merged_seq").alias("seq"), inner("merged_qual").alias("qual"))
    return single, apart


def quality_profile(reads: DataFrame) -> DataFrame:
    """Mean phred and number of reads by place in the read."""
    x = reads.select(F.posexplode(F.transform(F.split("qual", ""), lambda c: F.ascii(c) - 33)).alias("place", "phred"))
    return x.groupBy("place").agg(F.count(F.lit(1)).alias("reads"), F.avg("phred").alias("mean")).orderBy("place")
