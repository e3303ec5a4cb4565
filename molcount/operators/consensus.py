"""Consensus of the reads of a molecule."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from molcount.functions.expr import HIGH_COVERAGE, MAX_PHRED, POSTERIOR_ORDER, cigar_ops, consensus_name, error_of, quality_string
from molcount.operators import alignment
from molcount.operators.grouping import REGION
from molcount.plans.store import kept

FAMILY = [*REGION, "centroid"]
#: Log-likelihoods are rounded to so many places before ties are decided.
PLACES = 9
#: Fixed value: the logarithm of a base's error is its phred times this.
LOG_ERROR = -math.log(10) / 10
#: What agreement adds to the logarithm of the error, by phreds of up to 93, the highest of a text file; of 0 it is not asked.
GAINS = (0.0, *(math.log(1 - 10 ** (-q / 10)) - q * LOG_ERROR for q in range(1, 94)))


def assign(placed: DataFrame, clusters: DataFrame) -> DataFrame:
    """Mapped reads with the centroid and count of their cluster.

    Unmapped reads that stand at their mate's place (flag 4) are counted as fragments before, but are no
    reads of a family: their bases have no places.
    """
    if "flag" in placed.columns:
        placed = placed.where(F.coalesce("flag", F.lit(0)).bitwiseAND(F.lit(4)) == 0)
    c = clusters.select(*REGION, "barcode", "centroid", "cluster_count")
    return placed.join(c, [*REGION, "barcode"])


def singletons(assigned: DataFrame) -> DataFrame:
    """The first read (by ordinal) of each cluster of one fragment."""
    cols = [c for c in ("qname", "pos", "seq", "quals", "cigar") if c in assigned.columns]
    one = assigned.where("cluster_count = 1").groupBy(*FAMILY).agg(F.min_by(F.struct(*cols), "ordinal").alias("r"))
    return one.select(*FAMILY, "r.*")


def pileup(reads: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each base of reads without indels: seq from pos on, with its phred."""
    n = F.greatest(F.length("seq"), F.size("quals"))
    places = F.when(F.col("seq").isNotNull() & F.col("quals").isNotNull() & (n > 0), F.sequence(F.lit(0), n - 1))
    x = reads.select(*keys, "ordinal", "pos", "seq", "quals", F.explode(places).alias("o"))
    base = F.when(F.col("o") < F.length("seq"), F.substring(F.col("seq"), F.col("o") + 1, F.lit(1)))
    return x.select(*keys, "ordinal", (F.col("pos") + F.col("o")).alias("ref_pos"), base.alias("base"), F.get("quals", F.col("o")).alias("phred"))


def columns(pile: DataFrame, keys: list[str]) -> DataFrame:
    """The consensus of each column: coverage, most common allele and share, posterior base and quality.

    The likelihood of a base is the product over reads of 1 - e where they agree and e where not;
    phred 0 and N say nothing. The quality is -10 log10(1 - posterior), rounded half to even, at most
    MAX_PHRED. Over HIGH_COVERAGE reads or more the most common base is taken, with MAX_PHRED.
    """
    # of each base of a column: how often it is seen, the logarithm of its errors, and what agreement adds to that
    use = (F.col("base") != "N") & (F.col("phred") > 0)
    known = F.get(F.array(*map(F.lit, GAINS)), F.col("phred").cast("int"))
    gain = F.when(F.col("phred") < len(GAINS), known).otherwise(F.log(1 - error_of(F.col("phred"))) - F.col("phred") * LOG_ERROR)
    s = pile.groupBy(*keys, "ref_pos", "base").agg(F.count(F.lit(1)).alias("n_"), F.sum(F.when(use, F.col("phred"))).alias("phreds_"), F.sum(F.when(use, gain)).alias("gain_"))
    # few rows for each column are left to be laid side by side
    like = [F.sum(F.when(F.col("base") == b, F.col("gain_"))).alias(f"l{b}") for b in POSTERIOR_ORDER]
    count = [F.coalesce(F.sum(F.when(F.col("base") == b, F.col("n_"))), F.lit(0)).alias(f"n{b}") for b in (*POSTERIOR_ORDER, "N")]
    c = s.groupBy(*keys, "ref_pos").agg(F.sum("n_").alias("coverage"), (F.sum("phreds_") * LOG_ERROR).alias("wrong_"), *like, *count)
    c = c.withColumns({f"l{b}": F.round(F.coalesce(F.col("wrong_") + F.coalesce(F.col(f"l{b}"), F.lit(0.0)), F.lit(0.0)), PLACES) for b in POSTERIOR_ORDER})
    best = F.array_max(F.array(*[F.struct(F.col(f"l{b}").alias("l"), F.lit(-i).alias("i"), F.lit(b).alias("b")) for i, b in enumerate(POSTERIOR_ORDER)]))
    top = F.array_max(F.array(*[F.struct(F.col(f"n{b}").alias("n"), F.lit(-i).alias("i"), F.lit(b).alias("b")) for i, b in enumerate(("A", "C", "G", "T", "N"))]))
    c = c.withColumns({"best": best, "top": top})
    others = F.aggregate(F.array(*[F.when(F.col("best.b") != b, F.exp(F.col(f"l{b}") - F.col("best.l"))).otherwise(0.0) for b in POSTERIOR_ORDER]), F.lit(0.0), lambda s, x: s + x)
    wrong = others / (1 + others)
    q = F.when(wrong <= 0, F.lit(float(MAX_PHRED))).otherwise(F.least(F.rint(-10 * F.log10(F.greatest(wrong, F.lit(1e-300)))), F.lit(float(MAX_PHRED)))).cast("int")
    high = F.col("coverage") >= HIGH_COVERAGE
    c = c.withColumns({"base": F.when(high, F.col("top.b")).otherwise(F.col("best.b")), "quality": F.when(high, F.lit(MAX_PHRED)).otherwise(q)})
    of_base = F.coalesce(*[F.when(F.col("base") == b, F.col(f"n{b}")) for b in (*POSTERIOR_ORDER, "N")])
    kinds = sum((F.when(F.col(f"n{b}") > 0, 1).otherwise(0) for b in (*POSTERIOR_ORDER, "N")), F.lit(0))
    return c.select(*keys, "ref_pos", "coverage", "base", "quality", of_base.alias("agree"), kinds.alias("kinds"), F.col("top.b").alias("common"), F.col("top.n").alias("common_n"), F.col("best.b").alias("posterior"), q.alias("posterior_quality"))


def part_mark(part):
    """a to z, then aa, ab, ...: the mark of a read's part, counted from 0."""
    return F.concat(F.when(part >= 26, F.chr(F.floor(part / 26).cast("int") + 96)).otherwise(""), F.chr(F.pmod(part, F.lit(26)).cast("int") + 97))


def position_consensus(assigned: DataFrame, threshold: float = 60.0) -> DataFrame:
    """Consensus bases of families of several fragments, without indels: (family, ref_pos, base, quality).

    A column of fewer than two reads is no base. Where a column has several alleles and the taken
    one has less than threshold % of all the family's reads, the whole family gives no read.
    """
    fam = assigned.where("cluster_count > 1")
    reads = fam.groupBy(*FAMILY).agg(F.count(F.lit(1)).alias("reads"), F.max("cluster_count").alias("cluster_count"))
    col = columns(pileup(fam, FAMILY), FAMILY).where("coverage >= 2").join(reads, FAMILY)
    poor = (F.col("kinds") > 1) & (100.0 * F.col("agree") / F.col("reads") < threshold) if threshold > 0 else F.lit(False)
    w = Window.partitionBy(*FAMILY)
    return col.withColumn("poor", F.max(poor.cast("int")).over(w)).where("poor = 0").drop("poor")


def assembled(bases: DataFrame) -> DataFrame:
    """Consensus reads: one for each run of neighbouring positions; parts of a split family are marked a, b, ..."""
    w = Window.partitionBy(*FAMILY).orderBy("ref_pos")
    x = bases.withColumn("part", F.sum(F.coalesce((F.col("ref_pos") != F.lag("ref_pos").over(w) + 1).cast("int"), F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    one = F.array_sort(F.collect_list(F.struct("ref_pos", "base", "quality")))
    r = x.groupBy(*FAMILY, "part").agg(F.max("cluster_count").alias("cluster_count"), one.alias("b"))
    parts = F.max("part").over(Window.partitionBy(*FAMILY))
    r = r.withColumn("parts", parts + 1)
    name = consensus_name("Consensus", F.col("region_start"), F.concat(F.col("centroid"), F.when(F.col("parts") > 1, F.concat(F.lit("_"), part_mark(F.col("part")))).otherwise("")), F.col("cluster_count"))
    return r.select(name.alias("name"), "contig", F.col("b")[0]["ref_pos"].alias("start"), (F.col("b")[0]["ref_pos"] + F.size("b")).alias("end"), F.array_join(F.transform("b", lambda x: x["base"]), "").alias("seq"), F.array_join(F.transform("b", lambda x: F.chr(x["quality"] + 33)), "").alias("qual"), "cluster_count", *[c for c in FAMILY if c != "contig"])


def singleton_reads(singles: DataFrame) -> DataFrame:
    """Single reads as consensus reads of one fragment, under their names; their barcode is that of their cluster."""
    cigar = F.col("cigar") if "cigar" in singles.columns else F.concat(F.length("seq").cast("string"), F.lit("M"))
    span = F.aggregate(cigar_ops(cigar), F.lit(0), lambda s, o: s + F.when(o["op"].isin("M", "=", "X", "D", "N"), o["n"]).otherwise(0))
    name = consensus_name("Singleton", F.col("region_start"), F.col("centroid"), F.lit(1))
    return singles.select(name.alias("name"), "contig", F.col("pos").alias("start"), (F.col("pos") + span).alias("end"), "seq", quality_string(F.col("quals")).alias("qual"), cigar.alias("cigar"), F.lit(1).cast("long").alias("cluster_count"), *[c for c in FAMILY if c != "contig"])


def modal_consensus(assigned: DataFrame, threshold: float = 60.0) -> DataFrame:
    """The most common sequence of each family (ties by sequence) where its share reaches the threshold."""
    s = assigned.where("cluster_count > 1").groupBy(*FAMILY, "seq").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("pos"), F.max("cluster_count").alias("cluster_count"))
    f = s.groupBy(*FAMILY).agg(F.sum("n").alias("reads"), F.min("pos").alias("start"), F.max("cluster_count").alias("cluster_count"), F.min(F.struct((-F.col("n")).alias("k"), "seq")).alias("m"))
    return f.where(-100.0 * F.col("m.k") / F.col("reads") >= threshold).select(*FAMILY, "start", F.col("m.seq").alias("seq"), (-F.col("m.k")).alias("n"), "reads", "cluster_count")


#: What a column of aligned reads holds, in the order that decides ties.
ALIGNED = ("A", "C", "G", "T", "N", "-")


def aligned_consensus(assigned: DataFrame, threshold: float = 60.0, band: int = alignment.BAND) -> DataFrame:
    """The consensus of each family's reads aligned to its most common sequence (ties by sequence), whatever their places.

    Each different sequence is aligned once, wherever it lies; only where it is unlike the most common one does it
    make rows, so a family of any size is sums of few rows and never in one task. A column of the alignment takes its most
    common letter; where that is no letter the column goes, and where it has less than threshold % of the reads
    the family gives no read. Reads without a sequence take no part.
    """
    s = assigned.where("cluster_count > 1 and seq is not null and seq not in ('', '*')").groupBy(*FAMILY, "seq").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("pos"), F.max("cluster_count").alias("cluster_count"))
    s = kept(s, "sequences")  # met again as centers and as what is aligned to them
    f = s.groupBy(*FAMILY).agg(F.sum("n").alias("reads"), F.min("pos").alias("start"), F.max("cluster_count").alias("cluster_count"), F.min(F.struct((-F.col("n")).alias("k"), "seq"))["seq"].alias("center"))

    def unlike(batches):
        for b in batches:
            found = alignment.differences(b.column("center").to_pylist(), b.column("seq").to_pylist(), band)
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            place, slot, letter = zip(*[d for x in found for d in x], strict=True) if len(at) else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at)) for c in (*FAMILY, "n", "reads")), pa.array(place, pa.int32()), pa.array(slot, pa.int32()), pa.array(letter, pa.string()), b.column("center").take(pa.array(at))], names=[*FAMILY, "n", "reads", "place", "slot", "letter", "center"])

    pairs = s.join(f.select(*FAMILY, "reads", "center"), FAMILY).where("seq <> center").select(*FAMILY, "n", "reads", "center", "seq")
    kinds = ", ".join(f"{c} {dict(pairs.dtypes)[c]}" for c in FAMILY)
    d = pairs.mapInArrow(unlike, f"{kinds}, n long, reads long, place int, slot int, letter string, center string")
    d = d.groupBy(*FAMILY, "place", "slot", "letter").agg(F.sum("n").alias("n"), F.max("reads").alias("reads"), F.max(F.substring(F.col("center"), F.col("place") + 1, F.lit(1))).alias("own"))
    # a column: what differs, and the rest that does not
    entry = lambda n, letter: F.struct(n.alias("n"), (-F.coalesce(F.array_position(F.array(*map(F.lit, ALIGNED)), letter), F.lit(0))).alias("k"), letter.alias("letter"))
    c = d.groupBy(*FAMILY, "place", "slot").agg(F.max(entry(F.col("n"), F.col("letter"))).alias("most"), (F.max("reads") - F.sum("n")).alias("rest"), F.max("reads").alias("reads"), F.max(F.when(F.col("slot") < 0, F.col("own")).otherwise("-")).alias("own"))
    c = c.withColumn("top", F.greatest("most", entry(F.col("rest"), F.col("own"))))
    c = c.withColumn("poor", (F.col("top.letter") != "-") & (100.0 * F.col("top.n") / F.col("reads") < threshold))
    text = F.when(F.col("top.letter") == "-", "").otherwise(F.col("top.letter"))
    change = F.when((F.col("slot") < 0) & (F.col("top.letter") != F.col("own")) | (F.col("slot") >= 0) & (F.col("top.letter") != "-"), F.struct("place", "slot", text.alias("text")))
    g = c.groupBy(*FAMILY).agg(F.max("poor").alias("poor"), F.array_sort(F.collect_list(change)).alias("changes"))
    x = f.join(g, FAMILY, "left").where(~F.coalesce("poor", F.lit(False)))
    none = F.coalesce("changes", F.array().cast("array<struct<place:int,slot:int,text:string>>"))

    def at(p):
        inserted = F.array_join(F.transform(F.filter("changes", lambda v: (v["place"] == p) & (v["slot"] >= 0)), lambda v: v["text"]), "")
        own = F.filter("changes", lambda v: (v["place"] == p) & (v["slot"] < 0))
        return F.concat(inserted, F.coalesce(F.get(own, F.lit(0))["text"], F.substring(F.col("center"), p + 1, F.lit(1))))

    whole = F.array_join(F.transform(F.sequence(F.lit(0), F.length("center")), at), "")
    x = x.withColumn("changes", none).withColumn("seq", F.when(F.size("changes") == 0, F.col("center")).otherwise(whole))
    return x.where("seq <> ''").select(*FAMILY, "start", "seq", "reads", "cluster_count")


def member_histogram(assigned: DataFrame) -> DataFrame:
    """Different member sequences of each family and how often, as JSON in order of sequence."""
    s = assigned.where("cluster_count > 1").groupBy(*FAMILY, "seq").agg(F.count(F.lit(1)).alias("n"))
    m = F.map_from_entries(F.array_sort(F.collect_list(F.struct("seq", "n"))))
    return s.groupBy(*FAMILY).agg(F.to_json(m).alias("members"), F.count(F.lit(1)).alias("sequences"))


def member_lines(made: DataFrame, assigned: DataFrame) -> DataFrame:
    """For each consensus read its name, its sequence, and how often each member sequence occurs."""
    s = assigned.where("cluster_count > 1").groupBy(*FAMILY, "seq").agg(F.count(F.lit(1)).alias("n"))
    m = s.groupBy(*FAMILY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("seq", "n")))).alias("Members"))
    return made.join(m, FAMILY).select(F.col("name").alias("Name"), F.col("seq").alias("Consensus"), "Members")
