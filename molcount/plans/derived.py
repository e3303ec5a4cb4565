"""The reads view over the driver's tables, and small lists of regions and mutations.

The tables hold no sequencing data, so reads are derived from lineitem by arithmetic: 8-letter
barcodes with one-letter errors, 240 amplicons on six contigs, 10 bases with errors and true variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.operators import cluster, consensus, counts, grouping, indels
from molcount.plans.store import kept

LETTERS = "ACGT"
LENGTH = 10
#: The reference's bases repeat after so many places; two periods of them from place 0 on.
PERIOD = 20
REFERENCE = "".join(LETTERS[(p * 7 + p % 5) % 4] for p in range(2 * PERIOD))
#: The barcodes of 25 molecules, each without and with an error.
BARCODES = ["".join(LETTERS[(m * 7919 + e) // 4**i % 4] for i in range(8)) for m in range(25) for e in (0, 1)]
#: Regions: contig, start, end, name, ord.
BED = [("chrAF", 1000, 1500, "one", 0), ("chrAF", 1400, 2000, "two", 1), ("chrNO", 2500, 4000, "three", 2), ("chrRF", 1150, 1157, "four", 3), ("chrNO", 900, 1100, "five", 4), ("chrNO", 1090, 1200, "five", 5), ("chrAF", 6000, 6900, "six", 6)]
#: Mutations: name, contig, position, ref, alt, ord.
MUTATIONS = [("m1", "chrAF", 1004, "A", "C", 0), ("m2", "chrAF", 1004, "A", "G", 1), ("m3", "chrNO", 2505, "C", "T", 2), ("m4", "chrRF", 1155, "G", "A", 3), ("m5", "chrNO", 1005, "T", "C", 4), ("m6", "chrXX", 5, "T", "C", 5)]


def letter(i) -> F.col:
    return F.substring(F.lit(LETTERS), (i % 4 + 1).cast("int"), F.lit(1))


def reference_base(p):
    return letter(p * 7 + p % 5)


def reference_bases(p, n):
    """The n (up to PERIOD) bases of the reference from place p on, as one piece of its repeating text."""
    return F.substring(F.lit(REFERENCE), (p % PERIOD + 1).cast("int"), n if isinstance(n, Column) else F.lit(n))


def with_base(seq, where, o, base):
    """seq with another base at place o, counted from 0, where that holds; seq is met once, as code of over 8,000 bytes stays uncompiled."""
    where = F.coalesce(where, F.lit(False))
    return F.overlay(seq, F.when(where, base).otherwise(""), F.when(where, o + 1).otherwise(1).cast("int"), F.when(where, 1).otherwise(0))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df, dealt by the keys' hash where its scan has fewer splits than the cluster has cores.

    A small file is one row group, so one task would make all of the reads; a large table is left as it is scanned.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def reads(spark: SparkSession, sf_dir: str, more: tuple[str, ...] = ()) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    li = spread(li, "l_orderkey", "l_linenumber")
    mol = F.col("l_suppkey") % 25
    barcode = F.get(F.array(*map(F.lit, BARCODES)), (mol * 2 + F.when(F.col("l_orderkey") % 17 == 0, 1).otherwise(0)).cast("int"))
    pos = (F.lit(1000) + F.col("l_partkey") % 40 * 150 + F.col("l_linenumber") % 5).cast("long")
    x = li.select("l_orderkey", "l_linenumber", "l_suppkey", F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("qname"), F.concat(F.lit("chr"), "l_returnflag", "l_linestatus").alias("contig"), pos.alias("pos"), barcode.alias("barcode"), (20 + F.col("l_quantity").cast("int") % 20).alias("phred"))

    # one piece of the reference, with another base at place 4 of every fifth molecule, and with the error over that
    p, at = F.col("pos") + 4, (F.col("l_orderkey") % 23).cast("int")
    seq = reference_bases(F.col("pos"), LENGTH)
    seq = with_base(seq, mol % 5 == 0, F.lit(4), letter(p * 7 + p % 5 + 1))
    q = F.col("pos") + at
    seq = with_base(seq, at.between(0, LENGTH - 1), at, letter(q * 7 + q % 5 + 1 + F.col("l_linenumber")))
    ordinal = F.col("l_orderkey") * 16 + F.col("l_linenumber")
    return x.select("qname", "contig", "pos", "barcode", seq.alias("seq"), F.array_repeat("phred", LENGTH).alias("quals"), ordinal.alias("ordinal"), "phred", F.when(F.col("l_orderkey") % 13 == 5, F.when(F.col("l_linenumber") % 2 == 0, 69).otherwise(9)).otherwise(0).alias("flag"), F.concat(F.lit("g"), (F.col("l_suppkey") % 7).cast("string")).alias("tag"), *more)


#: SQL of the reads with insertions, deletions and clips, the same in Spark and in the oracle. kind: 1 two bases are
#: deleted before base ``cut``, 2 two bases (G, T) are inserted there, 3 the first two bases are clipped, 0 none.
KIND = "CASE WHEN l_orderkey % 19 = 0 THEN 0 WHEN l_suppkey % 25 % 6 IN (1, 2, 3) THEN l_suppkey % 25 % 6 ELSE 0 END"
CUT = "6 - l_linenumber % 5"
CIGAR = f"CASE kind WHEN 1 THEN concat(cast(cut AS {{text}}), 'M2D', cast({LENGTH} - cut AS {{text}}), 'M') WHEN 2 THEN concat(cast(cut AS {{text}}), 'M2I', cast({LENGTH} - 2 - cut AS {{text}}), 'M') WHEN 3 THEN '2S{LENGTH - 2}M' ELSE '{LENGTH}M' END"


def shifted(o: int) -> str:
    """The place in the reference of the o-th base of a read of a kind; none of inserted and clipped bases."""
    return f"CASE WHEN kind = 1 AND {o} >= cut THEN pos + {o} + 2 WHEN kind = 2 AND {o} >= cut + 2 THEN pos + {o} - 2 WHEN kind = 2 AND {o} >= cut THEN NULL WHEN kind = 3 AND {o} < 2 THEN NULL WHEN kind = 3 THEN pos + {o} - 2 ELSE pos + {o} END"


def base_at(o: int) -> str:
    p = f"({shifted(o)})"
    return f"coalesce(substr('ACGT', cast(1 + ({p} * 7 + {p} % 5 + CASE WHEN l_orderkey % 23 = {o} THEN 1 + l_linenumber ELSE 0 END) % 4 AS int), 1), CASE WHEN kind = 3 THEN 'A' WHEN {o} = cut THEN 'G' ELSE 'T' END)"


def indel_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reads(spark, sf_dir, ("l_orderkey", "l_linenumber", "l_suppkey")).drop("seq")
    r = r.withColumns({"kind": F.expr(KIND), "cut": F.expr(CUT)})
    pos, cut, at = F.col("pos"), F.col("cut"), (F.col("l_orderkey") % 23).cast("int")
    # the pieces of a kind, as ``base_at`` gives them base by base; inserted and clipped bases have no errors
    plain = reference_bases(pos, LENGTH)
    gone = F.concat(reference_bases(pos, cut), reference_bases(pos + cut + 2, LENGTH - cut))
    more = F.concat(reference_bases(pos, cut), F.lit("GT"), reference_bases(pos + cut, LENGTH - 2 - cut))
    seq = F.when(F.col("kind") == 1, gone).when(F.col("kind") == 2, more).when(F.col("kind") == 3, F.concat(F.lit("AA"), reference_bases(pos, LENGTH - 2))).otherwise(plain)
    own = F.when((F.col("kind") == 1) & (at >= cut), pos + at + 2).when((F.col("kind") == 2) & (at >= cut + 2), pos + at - 2)
    own = own.when((F.col("kind") == 2) & (at >= cut) | (F.col("kind") == 3) & (at < 2), F.lit(None)).when(F.col("kind") == 3, pos + at - 2).otherwise(pos + at)
    r = r.withColumns({"seq_": seq, "at_": at, "own_": own})
    wrong = F.col("at_").between(0, LENGTH - 1) & F.col("own_").isNotNull()
    return r.withColumns({"seq": with_base(F.col("seq_"), wrong, F.col("at_"), letter(F.col("own_") * 7 + F.col("own_") % 5 + 1 + F.col("l_linenumber"))), "cigar": F.expr(CIGAR.format(text="string"))}).drop("kind", "cut", "seq_", "at_", "own_", "l_orderkey", "l_linenumber", "l_suppkey")


def bed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BED, "contig string, start long, end long, name string, ord int")


def read_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places that reads cover as a list of regions, named by their tags: a region for each start, end and tag."""
    r = reads(spark, sf_dir).select("contig", F.col("pos").alias("start"), (F.col("pos") + F.length("seq") - 1).alias("end"), F.col("tag").alias("name")).distinct()
    return r.withColumn("ord", F.substring("name", 2, 9).cast("int"))


def mutations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MUTATIONS, "name string, contig string, position long, ref string, alt string, ord int")


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouping.without_singleton_regions(grouping.families(grouping.islands(reads(spark, sf_dir))))


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.clusters(families(spark, sf_dir))


def assigned_of(r: DataFrame, once: bool = False) -> DataFrame:
    """Reads with their clusters, of the columns that the later steps use.

    Consensus, singles and counts all read them, so they are written once; ``once`` says that one step alone will.
    """
    placed = grouping.islands(r)
    fam = grouping.without_singleton_regions(grouping.families(placed))
    cols = [c for c in ("pos", "seq", "quals", "cigar", "ordinal") if c in r.columns]
    # written once; where it is small, as few clusters of many reads are, it is sent to the reads and not the reads to it
    clusters = kept(cluster.clusters(fam), "clusters")
    a = consensus.assign(placed, clusters).select(*consensus.FAMILY, "cluster_count", *cols)
    return a if once else kept(a, "assigned")


def assigned(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    return assigned_of(reads(spark, sf_dir), once)


def assigned_indels(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    return assigned_of(indel_reads(spark, sf_dir), once)


def table(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assigned(spark, sf_dir)
    obs = counts.observations(consensus.position_consensus(a), consensus.singletons(a))
    return counts.table(obs, reference_base(F.col("ref_pos")))


def table_indels(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = assigned_indels(spark, sf_dir)
    obs = counts.observations(indels.position_consensus(a), consensus.singletons(a))
    return counts.table(obs, reference_base(F.col("ref_pos")))


def family_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each cluster as a consensus read over its region's start: contig, start, end, size, single."""
    c = clustered(spark, sf_dir).select("contig", "region_start", "centroid", "cluster_count").distinct()
    return c.select("contig", F.col("region_start").alias("start"), (F.col("region_start") + LENGTH).alias("end"), F.col("cluster_count").cast("long").alias("size"), (F.col("cluster_count") == 1).alias("single"), "centroid")
