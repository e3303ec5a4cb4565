"""Filters of the count table and results over samples. Mutations: (name, contig, position, ref, alt)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from molcount.functions.expr import ALLELES


def filter_table(cons: DataFrame, sizes: tuple[int, ...] = (3,), cutoff: int = 150, raw: bool = False) -> DataFrame:
    """Named positions whose coverage at threshold 0 reaches the cutoff, at the listed thresholds."""
    deep = F.max(F.when(F.col("fsize") == 0, F.col("coverage"))).over(Window.partitionBy("sample", "contig", "position"))
    keep = [s for s in sizes if s or raw] + ([0] if raw and 0 not in sizes else [])
    return cons.where("name <> ''").withColumn("deep", deep).where(F.col("deep") >= cutoff).where(F.col("fsize").isin(*keep)).drop("deep")


def filter_reads(reads: DataFrame, least: int) -> DataFrame:
    """Consensus reads of at least so many fragments, by their names."""
    return reads.where(F.substring_index("name", "=", -1).cast("int") >= least)


def alt_count(alt: Column) -> Column:
    return F.coalesce(*[F.when(alt == a, F.col(a)) for a in ALLELES], F.lit(0))


def track(cons: DataFrame, mutations: DataFrame, fsize: int = 3, offset: int = 1, per_ml: float | None = None) -> DataFrame:
    """Each mutation's reads at one threshold; none where the position is missing or has no other allele.

    Positions of mutations are counted from 0 here (offset 1). Of several mutations of one place only
    the last by name order of the list is followed, the others have no reads; N is no allele to follow. per_ml: volume of the sample, for
    a column mm_per_ml of reads by volume.
    """
    c = cons.where((F.col("fsize") == fsize) & (F.col("alt_allele") != ""))
    last = F.row_number().over(Window.partitionBy("contig", "position").orderBy(F.desc("ord"))) == 1
    m = mutations.withColumn("last", last).withColumn("at", F.col("position") + offset)
    x = m.alias("m").join(c.alias("c"), (F.col("m.contig") == F.col("c.contig")) & (F.col("m.at") == F.col("c.position")) & F.col("m.last"), "left")
    n = F.when(F.col("m.alt") == "N", 0).otherwise(F.coalesce(alt_count(F.col("m.alt")), F.lit(0)))
    depth = F.coalesce(F.col("c.coverage"), F.lit(0))
    out = x.select(F.col("m.name").alias("name"), F.col("m.contig").alias("contig"), F.col("m.position").alias("position"), F.col("m.ref").alias("ref"), F.col("m.alt").alias("alt"), depth.alias("coverage"), n.alias("alt_reads"), F.coalesce(F.try_divide(100.0 * n, depth), F.lit(0.0)).alias("vaf"))
    return out.withColumn("mm_per_ml", F.col("alt_reads") / F.lit(float(per_ml))) if per_ml else out


def at_mutations(cons: DataFrame, mutations: DataFrame, offset: int = 1) -> DataFrame:
    """Rows of the table at mutation places."""
    m = mutations.select("contig", (F.col("position") + offset).alias("position")).distinct()
    return cons.join(m, ["contig", "position"], "left_semi")


def metrics(cons: DataFrame, mutations: DataFrame, fsize: int = 3) -> DataFrame:
    """Rows of one threshold with every mutation of their place: count of its allele, percentage and parts per million."""
    c = cons.where(F.col("fsize") == fsize)
    x = c.alias("c").join(mutations.alias("m"), (F.col("c.contig") == F.col("m.contig")) & (F.col("c.position") == F.col("m.position")), "left")
    n = F.when(F.col("m.alt").isNull(), 0).otherwise(alt_count(F.col("m.alt")))
    share = F.coalesce(F.try_divide(n, F.col("c.coverage")), F.lit(0.0))
    return x.select("c.sample", F.col("c.contig").alias("contig"), F.col("c.position").alias("position"), F.col("m.name").alias("mutation"), F.col("m.alt").alias("alt"), "c.coverage", F.col("m.name").isNotNull().alias("is_mutation"), n.alias("alt_reads"), (F.col("m.name").isNotNull() & (n > 0)).alias("alt_matches"), (100 * share).alias("vaf"), (1e6 * share).alias("ppm"))


def by_volume(rows: DataFrame, volumes: DataFrame) -> DataFrame:
    """rows (sample, alt_reads, ...) with mm_per_ml; none where the sample (sample, ml_plasma) has no volume above 0."""
    v = volumes.where("ml_plasma > 0").groupBy("sample").agg(F.max("ml_plasma").alias("ml_plasma"))
    return rows.join(v, "sample", "left").withColumn("mm_per_ml", F.col("alt_reads") / F.col("ml_plasma")).drop("ml_plasma")


def on_target(cons: DataFrame, mutations: DataFrame, totals: DataFrame) -> DataFrame:
    """By sample: coverage at threshold 0 on mutation places over all reads. totals: (sample, total)."""
    m = mutations.select("contig", "position").distinct()
    s = cons.where("fsize = 0").join(m, ["contig", "position"]).groupBy("sample").agg(F.sum("coverage").alias("on_target"))
    return totals.join(s, "sample", "left").select("sample", "total", F.coalesce("on_target", F.lit(0)).alias("on_target"), F.coalesce(F.try_divide(F.coalesce("on_target", F.lit(0)), "total"), F.lit(0.0)).alias("fraction"))


#: Names of the row of all regions together in summary statistics.
ALL_ROWS = ("all_regions", "All", "all")


def on_target_of_regions(statistics: DataFrame) -> DataFrame:
    """By sample: reads at threshold 0 of regions with a name, without the row of all. statistics: (sample, region, name, f, reads)."""
    named = (F.col("f") == 0) & (F.coalesce("name", F.lit("")) != "") & ~F.col("region").isin(*ALL_ROWS)
    return statistics.groupBy("sample").agg(F.coalesce(F.sum(F.when(named, F.col("reads"))), F.lit(0)).alias("on_target"))


def on_target_fractions(totals: DataFrame, statistics: DataFrame | None = None, cons: DataFrame | None = None, mutations: DataFrame | None = None) -> DataFrame:
    """(sample, total, on_target, method, fraction): by regions where statistics are given, else by mutation places, else unmeasured.

    totals: (sample, total), total may be null. A sample without statistics is summary_stats_missing.
    """
    if statistics is not None:
        x = totals.join(on_target_of_regions(statistics), "sample", "left")
        x = x.withColumn("method", F.when(F.col("on_target").isNull(), "summary_stats_missing").otherwise("region_bed"))
    elif cons is not None and mutations is not None:
        x = totals.join(on_target(cons, mutations, totals).select("sample", "on_target"), "sample", "left").withColumn("method", F.lit("mutation_bed"))
    else:
        x = totals.withColumns({"on_target": F.lit(None).cast("long"), "method": F.lit("unmeasured")})
    return x.select("sample", "total", "on_target", "method", F.try_divide("on_target", "total").alias("fraction"))


def aggregate_samples(tables: list[DataFrame], fsize: int) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.where(F.col("fsize") == fsize)


def batch(samples: list[str], run, workers: int = 4) -> list[tuple[str, str, float, str]]:
    """(sample, status, seconds, error) of run(sample) for each, several at a time; an error of one ends no other.

    Spark shares its executors between the jobs; the driver holds a thread for each of ``workers``.
    """
    import time
    from concurrent.futures import ThreadPoolExecutor

    def one(sample: str):
        began = time.time()
        try:
            run(sample)
            return sample, "ok", time.time() - began, ""
        except Exception as e:  # noqa: BLE001  captured for the summary
            return sample, "failed", time.time() - began, f"{type(e).__name__}: {str(e)[:500]}"

    with ThreadPoolExecutor(max(1, workers)) as pool:
        return list(pool.map(one, samples))


def batch_summary(samples: DataFrame) -> DataFrame:
    """(sample, status, seconds, ...) in order, with the totals of the batch."""
    totals = samples.agg(F.count(F.lit(1)).alias("all"), F.count_if(F.col("status") == "ok").alias("done"))
    return samples.crossJoin(F.broadcast(totals)).orderBy("sample")
