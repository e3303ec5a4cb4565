"""Command line: the steps from raw and aligned reads to results, on Parquet, SAM, BAM and FASTQ input."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.functions.expr import barcode_of
from molcount.operators import analysis, cluster, consensus, counts, grouping, indels, intervals, preprocess, report, stats, variants
from molcount.plans.store import kept
from molcount.sources import bam, lines
from molcount.sources import reads as read_sources
from molcount.sources import text

#: Up to so many contigs of a list go to a BAM file's reader as a filter.
CONTIGS = 1000
#: Ways to make a consensus, by the start of their names.
METHODS = ("position", "most", "msa", "multiple")


def load(spark: SparkSession, path: str, tag: str | None = None, bed: DataFrame | None = None) -> DataFrame:
    """Aligned reads with the barcode from the read name; a tag becomes a column of its name.

    bed: of a BAM file only the contigs of these regions are read, if they are few.
    """
    if path.endswith(".sam"):
        r = text.sam(spark, path)
    elif path.rstrip("/").endswith(("bam", ".bam/*")):
        read_sources.register(spark)
        r = spark.read.format("bam").load(path)
        if bed is not None:
            named = [x["contig"] for x in bed.select("contig").distinct().limit(CONTIGS + 1).collect()]
            r = r.where(F.col("contig").isin(named)) if len(named) <= CONTIGS else r
    else:
        r = spark.read.parquet(path)
    r = r if "barcode" in r.columns else r.withColumn("barcode", barcode_of(F.col("qname")))
    if tag and tag not in r.columns and "tags" in r.columns:
        r = r.withColumn(tag, F.try_element_at("tags", F.lit(tag)))
    return r.where("contig is not null and contig <> '*'")


def fastq(spark: SparkSession, path: str) -> DataFrame:
    return lines.fastq(spark, path)


def method_of(name: str) -> str:
    """The method whose name starts so; none is an error."""
    found = [m for m in METHODS if name and m.startswith(name[:3].lower())]
    if not found:
        raise ValueError(f"the method is one of {', '.join(METHODS)}")
    return found[0]


def tables(spark: SparkSession, reads: DataFrame, reference: DataFrame, bed: DataFrame | None = None, threshold: int = 20, distance: int = 1, mode: str = "automatic", method: str = "position", share: float = 60.0, indel_share: float = 60.0, tag: str = "tag", members: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(consensus and single reads, count table).

    members: where the different sequences of each consensus read are written, as lines of JSON.

    Reads with a cigar column keep their insertions, deletions and clips; without one, bases stand side by side.
    """
    placed = kept(grouping.placed(reads, mode, bed, threshold, tag), "placed")
    fam = grouping.families(placed)
    if mode != "tag":
        fam = grouping.without_singleton_regions(fam)
    assigned = kept(consensus.assign(placed, cluster.clusters(fam, distance)), "assigned")
    singles = consensus.singletons(assigned)
    if method_of(method) != "position":
        m = consensus.modal_consensus(assigned, share) if method_of(method) == "most" else consensus.aligned_consensus(assigned, share)
        rows = m.select(*consensus.FAMILY, "cluster_count", F.col("start").alias("pos"), "seq", F.array_repeat(F.lit(60), F.length("seq")).alias("quals"), F.lit(0).cast("long").alias("ordinal"))
        cols = consensus.pileup(rows, [*consensus.FAMILY, "cluster_count"]).withColumnRenamed("phred", "quality")
    elif "cigar" in assigned.columns:
        cols = indels.position_consensus(assigned, share, indel_share)
    else:
        cols = consensus.position_consensus(assigned, share)
    for c, kind in (("inserted", "string"), ("deleted", "int")):
        cols = cols if c in cols.columns else cols.withColumn(c, F.lit(None).cast(kind))
    cols = kept(cols.select(*consensus.FAMILY, "ref_pos", "cluster_count", "base", "quality", "inserted", "deleted"), "columns")
    table = counts.table(counts.observations(cols, singles), reference)
    if bed is None:
        table = table.withColumn("name", F.lit(""))
    else:
        table = kept(table, "table")
        table = table.join(intervals.annotate_all(table.select("contig", "position").distinct(), bed, F.col("position"), ["contig", "position"]), ["contig", "position"])
    made = indels.assembled(cols)
    if members:
        made = kept(made, "made")
        consensus.member_lines(made, assigned).write.mode("overwrite").json(members)
    return made.unionByName(consensus.singleton_reads(singles)), table.select(*counts.COLUMNS)


def statistics(spark: SparkSession, reads: DataFrame, bed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(regions, rows by threshold) of consensus and single reads; regions have the names of a list."""
    reg = kept(stats.regions(stats.of_reads(reads)), "regions")
    if bed is None:
        reg = reg.withColumn("name", F.lit(""))
    else:
        reg = reg.join(intervals.end_inside(reg.select("contig", "start", "end"), bed, ["contig", "start", "end"]), ["contig", "start", "end"])
    return reg, stats.thresholds(reg)


def write_statistics(reg: DataFrame, t: DataFrame, out: str, named: bool) -> None:
    """Summary statistics in seven columns, one line for each region, and the coverage of named regions."""
    rows = stats.report(t).withColumn("place", F.col("region")).select("region", "place", "name", "f", "fraction", "reads", "umis")
    rows.orderBy("region", "f").write.mode("overwrite").csv(f"{out}/summary_statistics", sep="\t")
    stats.lines(reg).write.mode("overwrite").text(f"{out}/hist")
    if named:
        text.write_rows(stats.target_coverage(t), f"{out}/target_coverage", ["f"])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="molcount", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, about: str, *options: tuple) -> None:
        s = sub.add_parser(name, help=about)
        for flag, kw in options:
            s.add_argument(flag, **kw)
        s.add_argument("--out", required=True)

    need, whole, real = {"required": True}, lambda d: {"type": int, "default": d}, lambda d: {"type": float, "default": d}
    calling = (("--fsize", whole(3)), ("--method", {"default": "count", "choices": ("count", "bbmodel")}), ("--cutoff", whole(3)), ("--params", {}))
    making = (("--reference", need), ("--bed", {}), ("--threshold", whole(20)), ("--distance", whole(1)), ("--mode", {"default": "automatic", "choices": grouping.MODES}), ("--tag", {"default": "tag"}), ("--method", {"default": "position"}), ("--share", real(60.0)), ("--indel-share", real(60.0)), ("--json", {"action": "store_true"}), ("--only-targets", {"action": "store_true"}))
    add("preprocess", "barcodes out of raw reads", ("--read1", need), ("--read2", {}), ("--length", {"type": int, "required": True}), ("--spacer", whole(0)), ("--dual", {"action": "store_true"}), ("--reverse", {"action": "store_true"}), ("--mean", real(0.0)), ("--adapter", {}), ("--merge", {"action": "store_true"}))
    add("samples", "the samples of a folder of raw reads", ("--folder", need))
    add("consensus", "consensus reads and the count table; without reads those of the only BAM file of the output folder", ("--reads", {}), *making)
    add("run", "consensus, statistics and calls of many samples, of paths or of a sheet", ("--reads", {"nargs": "+"}), ("--sheet", {}), *making, ("--fsize", whole(3)), ("--workers", whole(2)))
    add("stats", "family statistics of consensus reads", ("--reads", need), ("--bed", {}))
    add("downsample", "molecules by share of the reads: a curve, a table by threshold and a picture", ("--reads", need), ("--seed", whole(1)))
    add("variants", "calls from a count table", ("--table", need), *calling)
    add("filter-cons", "deep and named places of a count table", ("--table", need), ("--cutoff", whole(150)), ("--fsize", whole(3)))
    add("filter-reads", "consensus reads of large families", ("--reads", need), ("--least", whole(3)))
    add("fit-model", "background parameters", ("--table", need), ("--fsize", whole(3)), ("--known", {}))
    add("track", "mutations in one count table", ("--table", need), ("--mutations", need), ("--fsize", whole(3)), ("--ml", {"type": float}))
    add("aggregate", "count tables of all samples in one", ("--tables", need), ("--mutations", {}), ("--fsize", whole(3)))
    add("summarize", "on-target fractions and mutation metrics", ("--tables", need), ("--mutations", need), ("--totals", need), ("--statistics", {}), ("--fsize", whole(3)))
    add("analysis", "results and reports of a sample sheet", ("--sheet", need), ("--tables", need), ("--base", {}), ("--fsize", whole(3)))
    return p


def analyse(spark: SparkSession, sample: dict, table: DataFrame, fsize: int, out: str) -> None:
    """One sample's mutations as JSON and as a page."""
    tracked = analysis.track(table, text.mutations(spark, sample["mutation_bed"]), fsize, per_ml=sample["ml_plasma"])
    tracked = kept(tracked, "tracked")
    tracked.write.mode("overwrite").json(f"{out}/{sample['sample_name']}")
    page = report.page(sample["sample_name"], tracked)
    spark.createDataFrame([(page,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/{sample['sample_name']}_report")


def make(spark: SparkSession, a: argparse.Namespace, path: str, out: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    bed, reference = text.bed(spark, a.bed) if a.bed else None, kept(lines.fasta_chunks(spark, a.reference), "reference")
    source = load(spark, path, a.tag if a.mode == "tag" else None, bed if a.mode == "bed" else None)
    reads, table = tables(spark, source, reference, bed, a.threshold, a.distance, a.mode, a.method, a.share, a.indel_share, a.tag, f"{out}/members" if a.json else None)
    table = table.where("name <> ''") if a.only_targets else table
    reads = kept(reads, "reads")
    reads.write.mode("overwrite").parquet(f"{out}/consensus")
    text.write_sam(reads, lines.lengths(reference), f"{out}/consensus_sam")
    bam.write_bam(reads, lines.lengths(reference), f"{out}/consensus_bam")
    text.write_count_table(table, f"{out}/cons")
    return reads, table, bed


def checked(a: argparse.Namespace) -> argparse.Namespace:
    """The arguments, if they go together and are in range."""
    has = lambda c: getattr(a, c, None) not in (None, False)

    def need(ok: bool, what: str) -> None:
        if not ok:
            raise ValueError(what)

    if a.command == "preprocess":
        need(a.length > 0 and a.spacer >= 0, "a barcode has one base or more, and a spacer none or more")
        for c in ("dual", "reverse", "merge"):
            need(not has(c) or has("read2"), f"--{c} needs both mates")
        need(not has("read2") or a.read1 != a.read2, "the mates are in two files")
    if hasattr(a, "share"):
        need(0 <= a.share <= 100 and 0 <= a.indel_share <= 100, "shares are percentages")
        need(a.threshold >= 0 and a.distance >= 0, "a threshold and a distance are not below 0")
        need(a.mode != "bed" or has("bed"), "the mode bed needs --bed")
        need(not has("only_targets") or has("bed"), "--only-targets needs --bed")
        method_of(a.method)
    if a.command == "run":
        need(has("reads") != has("sheet"), "either --reads or --sheet")
    for c in ("fsize", "cutoff", "least"):
        need(not hasattr(a, c) or getattr(a, c) >= 0, f"--{c} is not below 0")
    need(getattr(a, "ml", None) is None or a.ml > 0, "--ml is above 0")
    for c in ("read1", "read2", "reads", "sheet", "bed", "reference", "table", "mutations", "known", "params", "totals"):
        v = getattr(a, c, None) if (a.command, c) != ("run", "reads") else None  # a sample that fails is a row of the summary
        for path in v if isinstance(v, list) else [v]:
            local = path is not None and "://" not in path and not any(x in path for x in "*?[{")
            need(not local or Path(path).exists(), f"--{c}: {path} does not exist")
    return a


def main(argv: list[str] | None = None) -> None:
    a = checked(parser().parse_args(argv))
    spark = SparkSession.builder.appName("molcount").getOrCreate()
    if a.command == "preprocess":
        single, pairs = preprocess.prepared(fastq(spark, a.read1), fastq(spark, a.read2) if a.read2 else None, a.length, a.spacer, a.dual, a.reverse, a.mean, a.adapter, a.merge)
        if pairs is not None:
            x = kept(pairs, "pairs")
            for k in (1, 2):
                text.write_fastq(x.select(F.col(f"name{k}").alias("name"), F.col(f"seq{k}").alias("seq"), F.col(f"qual{k}").alias("qual")), f"{a.out}/R{k}")
        if single is not None:
            text.write_fastq(single, f"{a.out}/{'merged' if a.read2 else 'R1'}")
    elif a.command == "samples":
        found = text.samples_in_store(spark, a.folder)
        text.write_rows(spark.createDataFrame(found, "sample_name string, read1 string, read2 string"), a.out, ["sample_name"])
    elif a.command == "consensus":
        make(spark, a, a.reads or text.one_bam(a.out), a.out)
    elif a.command == "run":
        named = {p.rstrip("/").rsplit("/", 1)[-1]: p for p in a.reads or []} | {r["sample_name"]: r["read1"] for r in (text.sample_sheet(a.sheet) if a.sheet else [])}

        def one_sample(name: str) -> None:
            path, out = named[name], f"{a.out}/{name.rsplit('.', 1)[0] if a.reads else name}"
            reads, table, bed = make(spark, a, path, out)
            write_statistics(*statistics(spark, reads, bed), out, bed is not None)
            text.write_vcf(variants.vcf_lines(variants.by_count(table, a.fsize).withColumn("q", F.lit(None).cast("double"))), f"{out}/vcf")

        done = analysis.batch(list(named), one_sample, a.workers)
        text.write_rows(analysis.batch_summary(spark.createDataFrame(done, "sample string, status string, seconds double, error string")), f"{a.out}/summary", ["sample"])
    elif a.command == "stats":
        bed = text.bed(spark, a.bed) if a.bed else None
        write_statistics(*statistics(spark, spark.read.parquet(a.reads), bed), a.out, bed is not None)
    elif a.command == "downsample":
        f = spark.read.parquet(a.reads).select("contig", "start", F.xxhash64("name").alias("member"), F.col("cluster_count").alias("size"))
        curve = kept(stats.saturation(stats.downsampled(f, ["contig", "start"], seed=a.seed)), "curve")
        stats.write_downsampled(curve, f"{a.out}/curve")
        t = kept(stats.downsampled_thresholds(f, ["contig", "start"], seed=a.seed), "thresholds")
        text.write_rows(t, f"{a.out}/thresholds", ["contig", "start", "rate", "f"])
        total = t.groupBy("rate", "f").agg(F.sum("reads").alias("reads"), F.sum("umis").alias("umis"))
        page = report.curves([tuple(r) for r in total.where("f > 0").select("f", "rate", "umis").orderBy("f", "rate").collect()])  # thresholds times rates
        spark.createDataFrame([(page,)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.out}/picture")
    elif a.command == "filter-reads":
        analysis.filter_reads(spark.read.parquet(a.reads), a.least).write.mode("overwrite").parquet(a.out)
    elif a.command == "aggregate":
        t = text.count_tables(spark, a.tables).where(F.col("fsize") == a.fsize)
        text.write_rows(t.select("folder", *counts.COLUMNS), f"{a.out}/combined_cons", ["folder", "contig", "position"])
        if a.mutations:
            text.write_rows(analysis.metrics(t.drop("folder"), text.mutations(spark, a.mutations), a.fsize), f"{a.out}/mutation_metrics", ["sample", "contig", "position"])
    elif a.command == "summarize":
        t = text.count_tables(spark, a.tables).drop("folder")
        totals = spark.read.csv(a.totals, sep="\t", header=True, schema="sample string, total long, ml_plasma double")
        s = None
        if a.statistics:
            s = text.summary_statistics(spark, a.statistics).withColumn("sample", F.element_at(F.split("path", "/"), -2))
        m = text.mutations(spark, a.mutations)
        text.write_rows(analysis.on_target_fractions(totals.select("sample", "total"), s, t, m), f"{a.out}/on_target_summary", ["sample"])
        text.write_rows(analysis.by_volume(analysis.metrics(t, m, a.fsize).where("is_mutation"), totals.select("sample", "ml_plasma")), f"{a.out}/mutation_metrics", ["sample", "contig", "position"])
    elif a.command == "analysis":
        sheet = text.analysis_sheet(a.sheet, a.base)
        t = kept(text.count_tables(spark, a.tables).drop("folder"), "tables")
        by = {s["sample_name"]: s for s in sheet}
        done = analysis.batch(list(by), lambda n: analyse(spark, by[n], t.where(F.col("sample") == n), a.fsize, a.out))
        text.write_rows(analysis.batch_summary(spark.createDataFrame(done, "sample string, status string, seconds double, error string")), f"{a.out}/summary", ["sample"])
    else:
        table = text.count_table(spark, a.table)
        if a.command == "variants":
            if a.method == "bbmodel":
                alpha, beta = text.background(a.params)
                calls = kept(variants.by_background(table, a.fsize, alpha=alpha, beta=beta), "calls")
                text.write_rows(variants.q_histogram(calls), f"{a.out}/q_histogram", ["bin"])
            else:
                calls = variants.by_count(table, a.fsize, a.cutoff).withColumn("q", F.lit(None).cast("double"))
            text.write_vcf(variants.vcf_lines(calls), f"{a.out}/vcf")
        elif a.command == "filter-cons":
            text.write_count_table(analysis.filter_table(table, (a.fsize,), a.cutoff), a.out)
        elif a.command == "track":
            analysis.track(table, text.mutations(spark, a.mutations), a.fsize, per_ml=a.ml).write.mode("overwrite").json(a.out)
        else:
            s = variants.beta_statistics(table, text.mutations(spark, a.known) if a.known else None, a.fsize).first()
            spark.createDataFrame([(json.dumps(v),) for v in variants.fit_beta(*s)], "value string").coalesce(1).write.mode("overwrite").text(a.out)


if __name__ == "__main__":
    main()
