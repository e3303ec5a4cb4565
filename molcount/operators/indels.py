"""Position consensus of families whose reads have insertions and deletions, as expressions over columns.

Each column of a family is decided alone from its bases, insertions and deletions; deletions of each
length and insertions of each text count for themselves. Only then the accepted deletions of a family
are taken in order, columns inside one go, and the rest is joined to reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from molcount.functions.expr import HIGH_COVERAGE, MAX_PHRED, cigar_ops, consensus_name, run_lengths
from molcount.operators import consensus
from molcount.operators.consensus import FAMILY
from molcount.plans.store import kept

#: In each CIGAR string with a jump: between two aligned runs something that is no aligned run and moves the read or the reference.
BETWEEN = "[M=X][^M=X]*[IDNS][^M=X]*[M=X]"


def blocks(cigar: Column) -> Column:
    """array<struct<q, r, n>>: where each run of aligned bases begins in the read and from the read's start, and its length."""
    empty = F.array().cast("array<struct<q:int,r:int,n:int>>")
    zero = F.struct(F.lit(0).alias("q"), F.lit(0).alias("r"), empty.alias("out"))

    def step(s, o):
        aligned, n = o["op"].isin("M", "=", "X"), o["n"]
        here = F.array(F.struct(s["q"].alias("q"), s["r"].alias("r"), n.alias("n")))
        q = s["q"] + F.when(o["op"].isin("M", "=", "X", "I", "S"), n).otherwise(0)
        r = s["r"] + F.when(o["op"].isin("M", "=", "X", "D", "N"), n).otherwise(0)
        return F.struct(q.alias("q"), r.alias("r"), F.when(aligned, F.concat(s["out"], here)).otherwise(s["out"]).alias("out"))

    one = F.array(F.struct(F.lit(0).alias("q"), F.lit(0).alias("r"), F.regexp_extract(cigar, "^([0-9]+)M$", 1).cast("int").alias("n")))
    return F.when(cigar.rlike("^[0-9]+M$"), one).otherwise(F.aggregate(cigar_ops(cigar), zero, step)["out"])


def jumps(b: Column) -> Column:
    """array<struct<q, r, at, more, gone>>: between neighbouring blocks, where the first ends in the read and from its start, where the next begins, and how many bases are more and gone; none of a single block."""

    def step(i):
        a, z = F.get(b, i - 1), F.get(b, i)
        q, r = a["q"] + a["n"], a["r"] + a["n"]
        return F.struct(q.alias("q"), r.alias("r"), z["r"].alias("at"), (z["q"] - q).alias("more"), (z["r"] - r).alias("gone"))

    return F.when(F.size(b) > 1, F.transform(F.sequence(F.lit(1), F.size(b) - 1), step))


def with_blocks(reads: DataFrame) -> DataFrame:
    """reads with their blocks (b_) and what lies between those (j_): each different CIGAR string is taken apart once, and their table, written once, met by equality.

    Reads without one have no blocks and go.
    """
    c = reads.select("cigar").where("cigar is not null").distinct().select("cigar", blocks(F.col("cigar")).alias("b_"))
    return reads.join(kept(c.withColumn("j_", jumps(F.col("b_"))), "cigars"), "cigar")


def _blocks(reads: DataFrame) -> Column:
    return F.col("b_") if "b_" in reads.columns else blocks(F.col("cigar"))


def pileup(reads: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each aligned base, as ``consensus.pileup`` gives for reads without a CIGAR string."""
    x = reads.withColumn("b", F.explode(_blocks(reads)))
    x = x.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("b.n") - 1)))
    at = F.col("b.q") + F.col("i")
    return x.select(*keys, "ordinal", (F.col("pos") + F.col("b.r") + F.col("i")).alias("ref_pos"), F.substring(F.col("seq"), at + 1, F.lit(1)).alias("base"), F.get("quals", at).alias("phred"))


def events(reads: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ref_pos, kind, text, n): insertions (at the next reference base) and deletions (at their first base).

    They stand between neighbouring blocks. Where both jump at once only the insertion is taken.
    Without j_ the CIGAR strings are taken apart here, once each, and only those that can have a jump.
    """
    if "j_" in reads.columns:
        x = reads.where("j_ is not null").withColumn("j", F.explode("j_"))
    else:
        # outer, as to a plain one Spark adds a filter of its own on the array, which takes each string apart once more for each mention
        x = reads.where(F.col("cigar").rlike(BETWEEN)).withColumn("b_", _blocks(reads))
        x = x.withColumn("j_", jumps(F.col("b_"))).withColumn("j", F.explode_outer("j_"))
    x = x.where("j.more > 0 or j.gone > 0")
    ins, more = F.col("j.more") > 0, F.col("j.more")
    at = F.when(ins, F.col("j.at")).otherwise(F.col("j.r"))
    text = F.when(ins, F.substring(F.col("seq"), F.col("j.q") + 1, more)).otherwise("")
    return x.select(*keys, (F.col("pos") + at).alias("ref_pos"), F.when(ins, "I").otherwise("D").alias("kind"), text.alias("text"), F.when(ins, more).otherwise(F.col("j.gone")).alias("n"))


def decided(fam: DataFrame, threshold: float, indel_threshold: float) -> DataFrame:
    """Each column of families' reads: base and quality or none, inserted text or none, deleted length or none, poor."""
    cut = with_blocks(fam)
    col = consensus.columns(pileup(cut, FAMILY), FAMILY)
    e = events(cut, FAMILY).groupBy(*FAMILY, "ref_pos", "kind", "text", "n").agg(F.count(F.lit(1)).alias("k"))
    best = lambda kind, value: F.min(F.when(F.col("kind") == kind, F.struct((-F.col("k")).alias("k"), F.col(value).alias("v"))))
    e = e.groupBy(*FAMILY, "ref_pos").agg(best("I", "text").alias("ins"), best("D", "n").alias("dele"), F.coalesce(F.sum(F.when(F.col("kind") == "D", F.col("k"))), F.lit(0)).alias("gone"))
    reads = fam.groupBy(*FAMILY).agg(F.count(F.lit(1)).alias("reads"), F.max("cluster_count").alias("cluster_count"))
    x = col.join(e, [*FAMILY, "ref_pos"], "full").join(reads, FAMILY)
    none = {"coverage": F.lit(0), "gone": F.lit(0), "kinds": F.lit(0), "agree": F.lit(0), "common_n": F.lit(0), "posterior": F.lit("A"), "posterior_quality": F.lit(1)}
    x = x.withColumns({c: F.coalesce(c, v) for c, v in none.items()})
    x = x.withColumn("depth", F.col("coverage") + F.col("gone")).where("depth >= 2")
    high, most = F.col("depth") >= HIGH_COVERAGE, -F.col("dele.k")
    wins = F.coalesce((most > F.col("common_n")) | ((most == F.col("common_n")) & (F.col("common") == "N")), F.lit(False))
    simple = F.when(high, F.when(~wins, F.col("common"))).otherwise(F.col("posterior"))
    simple_q = F.when(high, F.lit(MAX_PHRED)).otherwise(F.col("posterior_quality"))
    inserted, deleted = F.col("ins").isNotNull(), F.col("ins").isNull() & F.col("dele").isNotNull()
    share = lambda n: 100.0 * n / F.col("depth")
    plain = ~inserted & ~deleted
    poor = F.when(deleted, share(F.greatest(most, F.col("common_n"))) < indel_threshold)
    if threshold > 0:
        poor = poor.when(plain, (F.col("kinds") > 1) & (100.0 * F.col("agree") / F.col("reads") < threshold))
    base = F.when(~(deleted & wins), simple)
    return x.select(
        *FAMILY, "ref_pos", "cluster_count", "reads", base.alias("base"), F.when(base.isNotNull(), simple_q).alias("quality"),
        F.when(inserted & (share(-F.col("ins.k")) >= indel_threshold), F.col("ins.v")).alias("inserted"), F.when(deleted & wins & (share(most) >= indel_threshold), F.col("dele.v")).alias("deleted"), F.coalesce(poor, F.lit(False)).alias("poor"),
    )


def position_consensus(assigned: DataFrame, threshold: float = 60.0, indel_threshold: float = 60.0) -> DataFrame:
    """Consensus columns of families of several fragments: (family, ref_pos, base, quality, inserted, deleted, cluster_count).

    assigned has cigar and ordinal. A family with a poor column outside its deletions gives none.
    """
    d = kept(decided(assigned.where("cluster_count > 1"), threshold, indel_threshold), "decided")  # met again for its deletions
    entry = "array<struct<at:bigint,n:int>>"

    def step(acc, x):
        last = F.element_at(acc, -1)
        return F.when((F.size(acc) > 0) & (last["at"] + last["n"] > x["at"]), acc).otherwise(F.concat(acc, F.array(x)))

    cuts = d.where("deleted is not null").groupBy(*FAMILY).agg(F.array_sort(F.collect_list(F.struct(F.col("ref_pos").cast("long").alias("at"), F.col("deleted").alias("n")))).alias("xs"))
    cuts = cuts.select(*FAMILY, F.aggregate("xs", F.array().cast(entry), step).alias("cuts"))
    x = d.join(cuts, FAMILY, "left")
    inside = F.exists("cuts", lambda c: (F.col("ref_pos") > c["at"]) & (F.col("ref_pos") < c["at"] + c["n"]))
    x = x.where(~F.coalesce(inside, F.lit(False)))
    x = x.withColumn("poor", F.max("poor").over(Window.partitionBy(*FAMILY)))
    return x.where(~F.col("poor") & (F.col("base").isNotNull() | F.col("inserted").isNotNull() | F.col("deleted").isNotNull())).drop("poor", "cuts", "reads")


def assembled(cols: DataFrame) -> DataFrame:
    """Consensus reads with their CIGAR strings: one for each run of neighbouring positions, parts marked a, b, ..."""
    w = Window.partitionBy(*FAMILY).orderBy("ref_pos")
    after = F.lag(F.col("ref_pos") + F.coalesce("deleted", F.lit(1))).over(w)
    x = cols.withColumn("part", F.sum(F.coalesce((F.col("ref_pos") != after).cast("int"), F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = x.groupBy(*FAMILY, "part").agg(F.max("cluster_count").alias("cluster_count"), F.array_sort(F.collect_list(F.struct("ref_pos", "base", "quality", "inserted", "deleted"))).alias("b"))
    join = lambda f: F.array_join(F.transform("b", f), "")
    text = lambda c: F.coalesce(c, F.lit(""))
    letters = join(lambda c: F.concat(F.repeat(F.lit("I"), F.length(text(c["inserted"]))), F.when(c["base"].isNotNull(), "M").otherwise(""), F.repeat(F.lit("D"), F.coalesce(c["deleted"], F.lit(0)))))
    r = r.withColumns({
        "seq": join(lambda c: F.concat(text(c["inserted"]), text(c["base"]))),
        "qual": join(lambda c: F.concat(F.repeat(F.lit("]"), F.length(text(c["inserted"]))), F.when(c["base"].isNotNull(), F.chr(c["quality"] + 33)).otherwise(""))),
        "letters": letters, "start": F.col("b")[0]["ref_pos"],
    }).where("seq <> ''")
    parts = F.max("part").over(Window.partitionBy(*FAMILY)) + 1
    r = r.withColumn("parts", parts)
    name = consensus_name("Consensus", F.col("region_start"), F.concat(F.col("centroid"), F.when(F.col("parts") > 1, F.concat(F.lit("_"), consensus.part_mark(F.col("part")))).otherwise("")), F.col("cluster_count"))
    end = F.col("start") + F.length(F.regexp_replace("letters", "I", ""))
    return r.select(name.alias("name"), "contig", "start", end.alias("end"), "seq", "qual", run_lengths(F.col("letters")).alias("cigar"), "cluster_count", *[c for c in FAMILY if c != "contig"])
