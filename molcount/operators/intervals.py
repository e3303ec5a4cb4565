"""Interval operators on regions (contig, start, end, name, ord); both ends belong to an interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Regions up to so many rows are broadcast; larger sets are joined by bins.
BROADCAST_ROWS = 100_000
BIN = 4096


def sort_regions(bed: DataFrame) -> DataFrame:
    return bed.orderBy("contig", "start", "ord")


def merge_regions(bed: DataFrame, threshold: int = 0) -> DataFrame:
    """Regions whose gap to the previous one (by its end, not the largest end so far) is at most the threshold,
    widened by it, with their different names in order."""
    w = Window.partitionBy("contig").orderBy("start", "ord")
    new = F.coalesce((F.lag("end").over(w) + threshold < F.col("start")).cast("int"), F.lit(1))
    island = bed.withColumn("new", new).withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    names = F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("start", "ord", "name"))), lambda x: x["name"])), ",")
    g = island.groupBy("contig", "island").agg(F.min("start").alias("start"), F.max_by("end", F.struct("start", "ord")).alias("end"), names.alias("name"))
    return g.select("contig", (F.col("start") - threshold).alias("start"), (F.col("end") + threshold).alias("end"), "name")


_few: dict[int, tuple[DataFrame, bool]] = {}


def few(bed: DataFrame) -> bool:
    """Whether the list has at most BROADCAST_ROWS rows; counted once for each frame, and not for local rows of a known number."""
    known = _few.get(id(bed))
    if known is None or known[0] is not bed:
        plan = bed._jdf.queryExecution().optimizedPlan()
        rows = plan.maxRows()
        is_few = bool(rows.isDefined() and rows.get() <= BROADCAST_ROWS) or bed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        if len(_few) > 100:
            _few.clear()
        known = _few[id(bed)] = (bed, is_few)
    return known[1]


def _joined(points: DataFrame, bed: DataFrame, lo: Column, hi: Column, how: str = "left") -> DataFrame:
    """points with each region that meets [lo, hi]; a checked broadcast, or bins of positions beyond it."""
    b = bed.select(F.col("contig").alias("b_contig"), F.col("start").alias("b_start"), F.col("end").alias("b_end"), F.col("name").alias("b_name"), F.col("ord").alias("b_ord"))
    meets = (F.col("contig") == F.col("b_contig")) & (lo <= F.col("b_end")) & (hi >= F.col("b_start"))
    if few(bed):
        return points.join(F.broadcast(b), meets, how)
    p = points.withColumn("p_id", F.monotonically_increasing_id()).withColumn("bin", F.explode(F.sequence(F.floor(lo / BIN), F.floor(hi / BIN))))
    c = b.withColumn("b_bin", F.explode(F.sequence(F.floor(F.col("b_start") / BIN), F.floor(F.col("b_end") / BIN))))
    x = p.join(c, meets & (F.col("bin") == F.col("b_bin")), how)
    return x.dropDuplicates(["p_id", "b_ord"]).drop("p_id", "bin", "b_bin")


def annotate_all(points: DataFrame, bed: DataFrame, pos: Column, keys: list[str]) -> DataFrame:
    """keys and all names of regions that hold pos, joined by commas in list order ('' if none)."""
    hits = _joined(points.withColumn("at_", pos), bed, F.col("at_"), F.col("at_"))
    names = F.transform(F.array_sort(F.collect_list(F.when(F.col("b_ord").isNotNull(), F.struct("b_ord", "b_name")))), lambda x: x["b_name"])
    return hits.groupBy(*keys).agg(F.array_join(names, ",").alias("name"))


def first_annotation(points: DataFrame, bed: DataFrame, pos: Column, keys: list[str]) -> DataFrame:
    hits = _joined(points.withColumn("at_", pos), bed, F.col("at_"), F.col("at_"))
    return hits.groupBy(*keys).agg(F.coalesce(F.min_by("b_name", "b_ord"), F.lit("")).alias("name"))


def first_overlap(spans: DataFrame, bed: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the first region that meets [start, end]."""
    hits = _joined(spans, bed, F.col("start"), F.col("end"))
    return hits.groupBy(*keys).agg(F.coalesce(F.min_by("b_name", "b_ord"), F.lit("")).alias("name"))


def end_inside(spans: DataFrame, bed: DataFrame, keys: list[str]) -> DataFrame:
    """keys and the first region that holds the start or the end of a span; one that the span holds whole is no match."""
    hits = _joined(spans, bed, F.col("start"), F.col("end"))
    inside = F.col("start").between(F.col("b_start"), F.col("b_end")) | F.col("end").between(F.col("b_start"), F.col("b_end"))
    return hits.groupBy(*keys).agg(F.coalesce(F.min_by(F.when(inside, F.col("b_name")), F.when(inside, F.col("b_ord"))), F.lit("")).alias("name"))


def expand_regions(bed: DataFrame, reads: DataFrame) -> DataFrame:
    """Regions widened to the starts of the reads that meet them."""
    r = reads.select(F.col("contig"), F.col("pos"), (F.col("pos") + F.length("seq")).alias("stop"))
    hits = _joined(r, bed, F.col("pos"), F.col("stop") - 1, "inner").groupBy("b_ord").agg(F.min("pos").alias("low"), F.max("pos").alias("high"))
    x = bed.join(hits, F.col("ord") == F.col("b_ord"), "left")
    return x.select("contig", F.least(F.col("start"), F.coalesce("low", "start")).alias("start"), F.greatest(F.col("end"), F.coalesce("high", "end")).alias("end"), "name", "ord")


def reannotate(rows: DataFrame, bed: DataFrame, keys: list[str]) -> DataFrame:
    """Empty names filled by the position counted from 0."""
    a = annotate_all(rows.select(*keys, "contig", "position").distinct(), bed, F.col("position") - 1, keys).withColumnRenamed("name", "found")
    return rows.join(a, keys, "left").withColumn("name", F.when(F.coalesce(F.col("name"), F.lit("")) == "", F.coalesce("found", F.lit(""))).otherwise(F.col("name"))).drop("found")
