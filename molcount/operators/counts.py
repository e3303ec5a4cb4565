"""The count table: alleles by position and family-size threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from molcount.functions.expr import ALLELES, FAMILY_SIZES, SINGLE_SIZES
from molcount.operators import consensus, indels
from molcount.sources.lines import with_reference

#: The table's columns in order, and the header of its text form.
COLUMNS = ("sample", "contig", "position", "name", "reference", *ALLELES, "coverage", "fsize", "alt_count", "alt_frequency", "alt_allele")
HEADER = ("Sample Name", "Contig", "Position", "Name", "Reference", *ALLELES, "Coverage", "Consensus group size", "Max Non-ref Allele Count", "Max Non-ref Allele Frequency", "Max Non-ref Allele")


def observations(bases: DataFrame, singles: DataFrame) -> DataFrame:
    """(contig, ref_pos, fsize, allele, n): threshold 0 counts a family's reads, f > 0 one for each family of f or more;
    single reads count at the first two thresholds. N of a consensus is no allele, N of a single read is.

    An insertion is one I at the next reference base and a deletion one D at its first base, whatever their length.
    """
    sizes = F.array(*map(F.lit, FAMILY_SIZES))
    alleles = F.array(F.col("base"))
    if "inserted" in bases.columns:
        alleles = F.array(F.col("base"), F.when(F.col("inserted").isNotNull(), "I"), F.when(F.col("deleted").isNotNull(), "D"))
    f = bases.withColumn("allele", F.explode(alleles)).where("allele <> 'N'").withColumn("fsize", F.explode(F.filter(sizes, lambda s: (s == 0) | (F.col("cluster_count") >= s))))
    f = f.groupBy("contig", "ref_pos", "fsize", "allele").agg(F.sum(F.when(F.col("fsize") == 0, F.col("cluster_count")).otherwise(1)).alias("n"))
    one = singles.withColumn("ordinal", F.lit(0))
    if "cigar" in singles.columns:
        seen = indels.pileup(one, ["contig"]).select("contig", "ref_pos", F.col("base").alias("allele")).unionByName(indels.events(one, ["contig"]).select("contig", "ref_pos", F.col("kind").alias("allele")))
    else:
        seen = consensus.pileup(one, ["contig"]).select("contig", "ref_pos", F.col("base").alias("allele"))
    s = seen.groupBy("contig", "ref_pos", "allele").agg(F.count(F.lit(1)).alias("n"))
    s = s.select("contig", "ref_pos", F.explode(F.array(*map(F.lit, SINGLE_SIZES))).alias("fsize"), "allele", "n")
    return f.unionByName(s)


def table(obs: DataFrame, reference: DataFrame | Column, sample: str = "sample") -> DataFrame:
    """One row for each position and threshold; duplicated positions of several regions fall together here.

    reference: chunks of sequences (contig, chunk, start, bases), (contig, ref_pos, reference), or the base as a column. Ties for the largest other allele go by column order.
    """
    wide = obs.groupBy("contig", "ref_pos", "fsize").agg(*[F.coalesce(F.sum(F.when(F.col("allele") == a, F.col("n"))), F.lit(0)).alias(a) for a in ALLELES])
    if isinstance(reference, Column):
        x = wide.withColumn("reference", reference)
    elif "bases" in reference.columns:
        x = with_reference(wide, reference)
    else:
        x = wide.join(reference, ["contig", "ref_pos"])
    coverage = sum((F.col(a) for a in ALLELES if a != "I"), F.lit(0))
    best = F.array_max(F.array(*[F.struct(F.when(F.col("reference") != a, F.col(a)).otherwise(F.lit(-1)).alias("n"), F.lit(-i).alias("i"), F.lit(a).alias("a")) for i, a in enumerate(ALLELES)]))
    x = x.withColumns({"coverage": coverage, "best": best})
    some = (F.col("best.n") > 0) & (F.col("coverage") > 0)
    return x.select(
        F.lit(sample).alias("sample"), "contig", (F.col("ref_pos") + 1).alias("position"), "reference", *ALLELES, "coverage", "fsize",
        F.when(some, F.col("best.n")).otherwise(0).alias("alt_count"), F.when(some, F.col("best.n") / F.col("coverage")).otherwise(0.0).alias("alt_frequency"), F.when(some, F.col("best.a")).otherwise("").alias("alt_allele"),
    )


def duplicate_positions(obs_by_region: DataFrame) -> DataFrame:
    """Positions that several regions have."""
    return obs_by_region.select("contig", "region_start", "ref_pos").distinct().groupBy("contig", "ref_pos").agg(F.count(F.lit(1)).alias("regions")).where("regions > 1")
