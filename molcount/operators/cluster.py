"""Error-tolerant clustering of barcodes within regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from molcount.functions.expr import hamming
from molcount.operators.grouping import REGION
from molcount.plans.store import dropped, kept

#: Fixed value: regions with more barcodes than this are compared by blocks only.
BLOCKING = 30


def edges(fam: DataFrame, distance: int = 1) -> DataFrame:
    """Ordered pairs (barcode, other) of a region within the distance, from the larger count; ties from the first by barcode.

    Up to BLOCKING barcodes all pairs of a region are compared. Above, barcodes of one length meet under keys in which
    as many letters as the distance are masked: near pairs share a key, and a key has at most a barcode for
    each filling of the mask, so no bucket grows with the region. Where a region's barcodes differ in length
    pairs must share a half (distance 0 or 1) or a third (2). For larger distances there are no pairs above BLOCKING.
    """
    w = Window.partitionBy(*REGION)
    f = fam.select(*REGION, "barcode", "cnt").withColumns({"n": F.count(F.lit(1)).over(w), "even": F.min(F.length("barcode")).over(w) == F.max(F.length("barcode")).over(w)})
    length = F.length("barcode")
    parts = 2 if distance <= 1 else 3
    cut = F.floor(length / parts).cast("int")
    key = lambda no, part: F.struct(no.cast("int").alias("no"), part.alias("part"))
    none = F.array().cast("array<struct<no:int,part:string>>")
    shared = F.array(*[key(F.lit(i), F.substring(F.col("barcode"), cut * i + 1, cut if i + 1 < parts else length)) for i in range(parts)])
    masked = lambda text, i: F.concat(F.substring(text, F.lit(1), i - 1), F.lit("*"), F.substring(text, i + 1, length))
    places = F.sequence(F.lit(1), length)
    single = F.transform(places, lambda i: key(i, masked(F.col("barcode"), i)))
    double = F.flatten(F.transform(places, lambda i: F.transform(F.filter(places, lambda j: j > i), lambda j: key(i * 1024 + j, masked(masked(F.col("barcode"), i), j)))))
    keys = F.when(F.col("n") <= BLOCKING, F.array(key(F.lit(-1), F.lit(""))))
    if distance <= 2:
        # two barcodes of one length that are equal are one barcode: a distance of 0 has no pairs
        keys = keys.when(F.col("even") & (length > distance), (none, single, double)[max(distance, 0)]).otherwise(shared)
    else:
        keys = keys.otherwise(none)
    k = f.select(*REGION, "barcode", "cnt", F.explode(keys).alias("k")).select(*REGION, "barcode", "cnt", "k.no", "k.part")
    a, b = k, k.select(*REGION, "no", "part", F.col("barcode").alias("other"), F.col("cnt").alias("other_cnt"))
    first = (F.col("cnt") > F.col("other_cnt")) | ((F.col("cnt") == F.col("other_cnt")) & (F.col("barcode") < F.col("other")))
    near = a.join(b, [*REGION, "no", "part"]).where(first & (hamming(F.col("barcode"), F.col("other")) <= distance))
    return near.select(*REGION, "barcode", "cnt", "other", "other_cnt").distinct()


#: Regions of more barcodes than this are settled by ranked claims over blocked edges instead of one fold.
FOLD = 500


def clusters(fam: DataFrame, distance: int = 1, fold: int = FOLD) -> DataFrame:
    """Each barcode's centroid and the cluster's summed count.

    By count (then barcode), a barcode joins the earliest centroid within the distance or becomes one.
    Which pairs are compared at all is the rule of ``edges``: above BLOCKING barcodes a pair within
    distance 1 or 2 always shares a block, and for larger distances there are no pairs.
    Regions of up to ``fold`` barcodes are folded in one built-in expression; larger ones by ``claims``,
    with the same result. The families are written once; both ways and the choice between them read that table.
    """
    entry = "array<struct<bc:string,cen:string,cnt:bigint>>"
    f = kept(fam.select(*REGION, "barcode", "cnt").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*REGION))), "families")
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("cnt")).alias("k"), F.col("barcode").alias("bc"), F.col("cnt").alias("cnt"))))
    per = f.where(F.col("n") <= fold).groupBy(*REGION).agg(ordered.alias("xs"))
    compared = F.lit(True) if distance <= 2 else F.size("xs") <= BLOCKING

    def step(acc, x):
        near = F.filter(acc, lambda s: (s["bc"] == s["cen"]) & compared & (hamming(s["bc"], x["bc"]) <= distance))
        return F.concat(acc, F.array(F.struct(x["bc"].alias("bc"), F.coalesce(F.get(near, F.lit(0))["bc"], x["bc"]).alias("cen"), x["cnt"].alias("cnt"))))

    folded = per.select(*REGION, F.explode(F.aggregate("xs", F.array().cast(entry), step)).alias("c"))
    c = folded.select(*REGION, F.col("c.bc").alias("barcode"), F.col("c.cen").alias("centroid"), F.col("c.cnt").alias("cnt"))
    if (f.agg(F.max("n").alias("n")).first()["n"] or 0) > fold:
        c = c.unionByName(claims(f.where(F.col("n") > fold), distance))
    sums = c.groupBy(*REGION, "centroid").agg(F.sum("cnt").alias("cluster_count"))
    return c.join(sums, [*REGION, "centroid"]).select(*REGION, "barcode", "centroid", "cnt", "cluster_count")


def claims(fam: DataFrame, distance: int) -> DataFrame:
    """The same clusters for regions of any size: rounds of equality joins, no region in one task.

    A barcode none of whose earlier neighbours is open any more is a centroid if none of them is one, and else
    belongs to the earliest that is. Each round settles all barcodes whose earlier neighbours are settled;
    its rows are written, which cuts the lineage, and those of the round before go. The first open barcode of a region
    is settled in each round, so a round that settles none is an error.
    """
    near = kept(edges(fam, distance).select(*REGION, "barcode", "cnt", "other"), "edges")
    state, open_ = kept(fam.select(*REGION, "barcode", "cnt", F.lit(None).cast("string").alias("centroid")), "claims"), None
    while True:
        heads = state.select(*REGION, "barcode", F.col("centroid").alias("head"))
        seen = near.join(heads, [*REGION, "barcode"]).groupBy(*REGION, F.col("other").alias("barcode")).agg(
            F.max(F.col("head").isNull()).alias("waits"), F.min(F.when(F.col("head") == F.col("barcode"), F.struct((-F.col("cnt")).alias("k"), "barcode"))).alias("first")
        )
        x = state.join(seen, [*REGION, "barcode"], "left")
        new = F.when(F.coalesce(F.col("waits"), F.lit(False)), F.lit(None).cast("string")).otherwise(F.coalesce(F.col("first.barcode"), F.col("barcode")))
        before, state = state, kept(x.select(*REGION, "barcode", "cnt", F.coalesce("centroid", new).alias("centroid")), "claims")
        dropped(before)
        left = state.where("centroid is null").count()
        if not left:
            dropped(near)
            return state.select(*REGION, "barcode", "centroid", "cnt")
        if open_ is not None and left >= open_:
            raise RuntimeError("the claims of barcodes do not settle")
        open_ = left
