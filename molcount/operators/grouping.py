"""Grouping of reads (qname, contig, pos, barcode, seq, ...) into regions, and fragments by barcode."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from molcount.operators import intervals
from molcount.plans.store import kept

REGION = ["contig", "region_start"]


#: Positions are cut into bins of so many for finding islands.
BIN = 1 << 16


def islands_of(positions: DataFrame, threshold: int = 20, width: int = BIN) -> DataFrame:
    """positions (contig, pos, distinct) with region_start and region_end: a new island where one lies over threshold after the last.

    Each bin of a contig is cut alone. Only its first and last island can go on beyond its borders: a row for each bin,
    in order along the contig, says which do, and gives their ends. So tasks do not depend on the number of contigs.
    """
    p = positions.select("contig", "pos").withColumn("bin", F.floor(F.col("pos") / width))
    w = Window.partitionBy("contig", "bin").orderBy("pos")
    new = F.coalesce((F.col("pos") > F.lag("pos").over(w) + threshold).cast("int"), F.lit(0))
    p = p.withColumn("new", new).withColumn("island", F.sum("new").over(w))
    whole = Window.partitionBy("contig", "bin", "island")
    p = p.select("contig", "pos", "bin", "island", F.min("pos").over(whole).alias("low"), F.max("pos").over(whole).alias("high"))
    # a row for each bin: its first island (0) and its last
    b = p.groupBy("contig", "bin").agg(F.min("low").alias("first"), F.max("high").alias("last"), F.max("island").alias("cuts"), F.min(F.when(F.col("island") == 0, F.col("high"))).alias("first_high"), F.max("low").alias("last_low"))
    along = Window.partitionBy("contig").orderBy("bin")
    b = b.withColumns({"joins": F.coalesce(F.col("first") <= F.lag("last").over(along) + threshold, F.lit(False)), "goes_on": F.coalesce(F.lead("first").over(along) <= F.col("last") + threshold, F.lit(False))})
    # a bin that is one island joined to the one before begins nothing, one that goes on ends nothing
    begins = F.when((F.col("cuts") > 0) | ~F.col("joins"), F.col("last_low"))
    ends = F.when((F.col("cuts") > 0) | ~F.col("goes_on"), F.col("first_high"))
    before, after = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    b = b.withColumns({"from": F.when(F.col("joins"), F.last(begins, ignorenulls=True).over(before)), "to": F.when(F.col("goes_on"), F.first(ends, ignorenulls=True).over(after))})
    x = p.join(b.select("contig", "bin", "cuts", "from", "to"), ["contig", "bin"])
    start = F.when((F.col("island") == 0) & F.col("from").isNotNull(), F.col("from")).otherwise(F.col("low"))
    end = F.when((F.col("island") == F.col("cuts")) & F.col("to").isNotNull(), F.col("to")).otherwise(F.col("high"))
    return x.select("contig", "pos", start.alias("region_start"), (end + 1).alias("region_end"))


def islands(reads: DataFrame, threshold: int = 20, width: int = BIN) -> DataFrame:
    """reads with region_start and region_end: a new region where a start lies over threshold after the last one.

    Positions are reduced to distinct ones first, so the windows see one row for each position, not one for each read;
    they are written, as the islands read them twice and all reads would be made twice for them.
    The islands' table is written once, so its size is known: where it is small the reads need not move to meet it.
    """
    positions = kept(reads.select("contig", "pos").distinct(), "positions")
    places = kept(islands_of(positions, threshold, width), "islands")
    return reads.join(places, ["contig", "pos"])


def families(placed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct fragments (read names, so mates count once) by region and barcode.

    Names hardly repeat, so reads are dealt first and told apart where they meet: a table of all names before that saves no rows.
    """
    keys = [*(keys or [*REGION, "region_end"]), "barcode"]
    named = placed.select(*keys, "qname").repartition(*keys, "qname").dropDuplicates([*keys, "qname"])
    return named.groupBy(*keys).agg(F.count("qname").alias("cnt"))


def without_singleton_regions(fam: DataFrame, cutoff: int = 2, keys: list[str] | None = None) -> DataFrame:
    """Regions whose largest barcode has more than cutoff fragments."""
    return fam.withColumn("most", F.max("cnt").over(Window.partitionBy(*(keys or REGION)))).where(F.col("most") > cutoff).drop("most")


def region_summary(fam: DataFrame) -> DataFrame:
    return fam.groupBy(*REGION, "region_end").agg(F.count(F.lit(1)).alias("barcodes"), F.sum("cnt").alias("fragments"), F.max("cnt").alias("most"))


def families_in_bed(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """Families by region of a list: a read counts where it overlaps. The list is broadcast or joined by bins of positions."""
    return families(placed_in_bed(reads, regions))


def placed_in_bed(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """Reads with each region (contig, start, end, ord) that they overlap; a region's end is not part of it."""
    b = regions.select("contig", "start", (F.col("end") - 1).alias("end"), "name", F.col("ord") if "ord" in regions.columns else F.xxhash64("contig", "start", "end").alias("ord"))
    r = reads.withColumn("stop_", F.col("pos") + F.length("seq") - 1)
    hits = intervals._joined(r, b, F.col("pos"), F.col("stop_"), "inner")
    return hits.select(*reads.columns, F.col("b_start").alias("region_start"), (F.col("b_end") + 1).alias("region_end"))


def placed_in_regions(reads: DataFrame, bed: DataFrame, threshold: int = 20) -> DataFrame:
    """BED mode: regions are merged, widened to the reads that meet them, and take the reads that overlap."""
    merged = intervals.merge_regions(intervals.sort_regions(bed), threshold)
    merged = merged.withColumn("ord", F.xxhash64("contig", "start", "end"))
    return placed_in_bed(reads, intervals.expand_regions(merged, reads))


def placed_by_tag(reads: DataFrame, tag: str = "tag") -> DataFrame:
    """Tag mode: a region is (contig, tag or ''); no region is dropped for its size."""
    r = reads.withColumn("tag_", F.coalesce(F.col(tag), F.lit("")))
    ends = r.groupBy("contig", "tag_").agg(F.min("pos").alias("region_start"), F.max(F.col("pos") + F.length("seq")).alias("region_end"))
    return r.join(ends, ["contig", "tag_"])


#: How reads are dealt to regions.
MODES = ("automatic", "bed", "tag")


def placed(reads: DataFrame, mode: str = "automatic", bed: DataFrame | None = None, threshold: int = 20, tag: str = "tag") -> DataFrame:
    """Reads with region_start and region_end by the mode; a mode that lacks its input is an error."""
    if mode not in MODES:
        raise ValueError(f"the mode is one of {', '.join(MODES)}")
    if mode == "bed":
        if bed is None:
            raise ValueError("the mode bed needs regions")
        return placed_in_regions(reads, bed, threshold)
    if mode == "tag":
        if tag not in reads.columns:
            raise ValueError(f"the mode tag needs a column {tag}")
        return placed_by_tag(reads, tag)
    return islands(reads, threshold)


def families_by_tag(reads: DataFrame, tag: str = "tag") -> DataFrame:
    """Families by (contig, tag or ''), with the range of positions; no region is dropped."""
    r = reads.withColumn("tag", F.coalesce(F.col(tag), F.lit("")))
    ends = r.groupBy("contig", "tag").agg(F.min("pos").alias("region_start"), F.max(F.col("pos") + F.length("seq")).alias("region_end"))
    return families(r, ["contig", "tag"]).join(ends, ["contig", "tag"])


def contigs(reads: DataFrame) -> DataFrame:
    return reads.select("contig").distinct()
