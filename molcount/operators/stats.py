"""Family-size statistics of consensus reads (contig, start, end, size, single, name)."""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from molcount.functions.expr import FAMILY_SIZES, name_count, name_kind
from molcount.operators.variants import log_gamma


def regions(reads: DataFrame) -> DataFrame:
    """By (contig, start): largest end, and reads and molecules at each threshold, as arrays in order of the thresholds.

    0 counts each read, 1 also single reads, more only families of as many reads. Families are counted by
    size first, so an amplicon of any number of families is as many sums as there are thresholds.
    """
    sizes = reads.groupBy("contig", "start", "single", "size").agg(F.max("end").alias("end"), F.count(F.lit(1)).alias("n"))
    one, n = F.col("single"), F.col("n")
    total = F.when(one, n).otherwise(F.col("size") * n)
    in_ = lambda f: F.when(one, F.lit(f <= 1)).otherwise(F.col("size") >= f)
    reads_at = [F.coalesce(F.sum(F.when(in_(f), total)), F.lit(0)).cast("long").alias(f"r{f}") for f in FAMILY_SIZES]
    umis_at = [F.coalesce(F.sum(F.when(in_(f), total if f == 0 else n)), F.lit(0)).cast("long").alias(f"u{f}") for f in FAMILY_SIZES]
    single = F.coalesce(F.sum(F.when(one, n)), F.lit(0)).cast("long").alias("singletons")
    g = sizes.groupBy("contig", "start").agg(F.max("end").alias("end"), single, *reads_at, *umis_at)
    return g.select("contig", "start", "end", "singletons", F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"r{f}").alias("reads"), F.col(f"u{f}").alias("umis")) for f in FAMILY_SIZES]).alias("at"))


def thresholds(reg: DataFrame) -> DataFrame:
    """Reads and molecules of each region at each threshold."""
    return reg.select("contig", "start", "end", "name", F.explode("at").alias("t")).select("contig", "start", "end", "name", "t.f", "t.reads", "t.umis")


def lines(reg: DataFrame) -> DataFrame:
    """One line of text for each region: region, place, name, numbers of consensus and of single reads."""
    families = F.filter("at", lambda t: t["f"] == 1)[0]["umis"] - F.col("singletons")
    region = F.concat_ws(":", "contig", F.col("start").cast("string"))
    fields = [region, F.concat(region, F.lit("-"), F.col("end").cast("string")), F.col("name"), F.concat(F.lit("consensus_reads: "), families.cast("string")), F.concat(F.lit("singletons: "), F.col("singletons").cast("string"))]
    return reg.orderBy("contig", "start").select(F.concat_ws("\t", *fields).alias("value"))


def of_reads(reads: DataFrame) -> DataFrame:
    """Consensus and single reads (name, contig, start, end) as (contig, start, end, size, single), by their names."""
    return reads.select("contig", "start", "end", name_count(F.col("name")).cast("long").alias("size"), (name_kind(F.col("name")) == "Singleton").alias("single"))


def report(t: DataFrame) -> DataFrame:
    """Rows of regions with the share of their reads, and the rows of all regions together."""
    g = t.groupingSets([["contig", "start", "name", "f"], ["f"]], "contig", "start", "name", "f").agg(F.sum("reads").alias("reads"), F.sum("umis").alias("umis"), F.grouping("contig").alias("all"))
    first = F.max(F.when(F.col("f") == 0, F.col("reads"))).over(Window.partitionBy("contig", "start", "name", "all"))
    return g.select(F.when(F.col("all") == 1, "All").otherwise(F.concat_ws(":", "contig", "start")).alias("region"), F.when(F.col("all") == 1, "all_regions").otherwise(F.col("name")).alias("name"), "f", F.coalesce(F.try_divide("reads", first), F.lit(0.0)).alias("fraction"), "reads", "umis")


def target_coverage(t: DataFrame) -> DataFrame:
    """Molecules on regions with a name, of all, by threshold."""
    g = t.groupBy("f").agg(F.sum(F.when(F.col("name") != "", F.col("umis")).otherwise(0)).alias("on_target"), F.sum("umis").alias("all_umis"))
    return g.select("f", "on_target", (F.col("all_umis") - F.col("on_target")).alias("off_target"), "all_umis", F.coalesce(F.try_divide("on_target", "all_umis"), F.lit(0.0)).alias("fraction"))


def family_histogram(reads: DataFrame) -> DataFrame:
    return reads.groupBy(F.when(F.col("single"), 1).otherwise(F.col("size")).alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy("size")


#: Families of a key are thinned in blocks of about so many, each in one step of a task.
BLOCK_FAMILIES = 4096
#: Above this the draw of a share is by the normal law with the exact mean and variance, rounded and kept in range.
EXACT = 1_000_000_000


def _share(rng: np.random.Generator, here: int, rest: int, take: int) -> int:
    """How many of ``take`` reads drawn from ``here + rest`` fall among the first ``here``."""
    total = here + rest
    if take <= 0 or here <= 0:
        return 0
    if rest <= 0 or take >= total:
        return min(take, here)
    if total < EXACT:
        return int(rng.hypergeometric(here, rest, take))
    p = here / total
    sd = math.sqrt(take * p * (1 - p) * (total - take) / (total - 1))
    return int(min(max(round(rng.normal(take * p, sd)), take - rest, 0), here, take))


def _split(rng: np.random.Generator, sizes: np.ndarray, take: int) -> np.ndarray:
    """The reads kept of each family when ``take`` of all are drawn without replacement."""
    total = int(sizes.sum())
    if take >= total:
        return sizes.copy()
    if total < EXACT:
        return rng.multivariate_hypergeometric(sizes, take, method="marginals")
    out = np.zeros(len(sizes), dtype=np.int64)
    for i, here in enumerate(sizes.tolist()):
        total -= here
        out[i] = _share(rng, here, total, take)
        take -= int(out[i])
    return out


def thinned(families: DataFrame, keys: list[str], rates: int = 10, seed: int = 1) -> DataFrame:
    """(keys, rate, kept, n): how many families of keys keep how many reads after drawing round(rate * reads) without replacement.

    families: keys, member (an id) and size. The number drawn is split down a tree: over blocks of families
    and then over the families of a block, each split hypergeometric, so that no read is a row and what is moved
    are families. Draws are seeded by key, rate and block, so reruns agree. The reads of a rate are drawn from those of
    the next higher one, so each rate is a fair draw of all reads and a curve never falls.
    """
    f = families.select(*keys, F.col("member"), F.col("size").cast("long").alias("size")).where("size > 0")
    of = f.groupBy(*keys).agg(F.sum("size").alias("all_"), F.ceil(F.count(F.lit(1)) / BLOCK_FAMILIES).cast("int").alias("blocks_"))
    same = lambda a, b, names: functools.reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names])
    x = f.alias("f").join(of.alias("o"), same("f", "o", keys)).select("f.*", "all_", F.pmod(F.xxhash64("member"), F.col("blocks_")).cast("int").alias("block_"))
    key = F.xxhash64(*keys, F.lit(seed)).alias("key_")
    blocks = x.groupBy(*keys, "block_").agg(F.sum("size").alias("here")).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("block_", "here"))).alias("b"))
    fields = [f for f in families.schema if f.name in keys]
    fields = [next(f for f in fields if f.name == c) for c in keys]

    def quotas(batches):
        for b in batches:
            at, block, quota = [], [], []
            for i, (k, parts) in enumerate(zip(b.column("key_").to_pylist(), b.column("b").to_pylist(), strict=True)):
                have = [p["here"] for p in parts]
                total, got = sum(have), []
                for r in range(rates, 0, -1):
                    rest, left = sum(have), round(r * total / rates)
                    for j, p in enumerate(parts):
                        rest -= have[j]
                        have[j] = _share(np.random.default_rng([k & (1 << 64) - 1, r, p["block_"], 1]), have[j], rest, left)
                        left -= have[j]
                    got.append(list(have))
                at += [i] * len(parts)
                block += [p["block_"] for p in parts]
                quota += [list(q)[::-1] for q in zip(*got, strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at, pa.int64())) for c in keys), pa.array(block, pa.int32()), pa.array(quota, pa.list_(pa.int64()))], names=[*keys, "block_", "quota"])

    head = T.StructType(fields)
    quota = blocks.select(*keys, "b", key).mapInArrow(quotas, T.StructType([*head.fields, T.StructField("block_", T.IntegerType()), T.StructField("quota", T.ArrayType(T.LongType()))]))
    y = x.alias("f").join(quota.alias("q"), same("f", "q", [*keys, "block_"])).select("f.*", "q.quota", F.xxhash64(*[F.col(f"f.{c}") for c in keys], F.lit(seed)).alias("key_"))
    y = y.repartition(*keys, "block_").sortWithinPartitions(*keys, "block_", "member", "size")

    def drawn(batches):
        held: list = []

        def done():
            k, block, quota = held[0][0]
            sizes = np.concatenate([h[1] for h in held])
            rows = []
            for r in range(rates, 0, -1):
                sizes = _split(np.random.default_rng([k & (1 << 64) - 1, r, block, 2]), sizes, quota[r - 1])
                kept, n = np.unique(sizes[sizes > 0], return_counts=True)
                rows += [(r, int(a), int(b)) for a, b in zip(kept, n, strict=True)]
            if rows:
                rate, kept, n = zip(*rows, strict=True)
                first = pa.array([0] * len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([*(held[0][2].column(c).take(first) for c in keys), pa.array(rate, pa.int32()), pa.array(kept, pa.int64()), pa.array(n, pa.int64())], names=[*keys, "rate", "kept", "n"])
            held.clear()

        for b in batches:
            ids = np.stack([b.column("key_").to_numpy(), b.column("block_").to_numpy().astype(np.int64)], axis=1)
            cut = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1).tolist(), len(ids)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if lo == hi:
                    continue
                if held and held[0][0][:2] != tuple(ids[lo].tolist()):
                    yield from done()
                one = b.slice(lo, 1)
                held.append(((*ids[lo].tolist(), one.column("quota")[0].as_py()), b.column("size").slice(lo, hi - lo).to_numpy(), one))
        if held:
            yield from done()

    return y.mapInArrow(drawn, T.StructType([*head.fields, T.StructField("rate", T.IntegerType()), T.StructField("kept", T.LongType()), T.StructField("n", T.LongType())])).groupBy(*keys, "rate", "kept").agg(F.sum("n").alias("n"))


def downsampled(families: DataFrame, keys: list[str], rates: int = 10, seed: int = 1) -> DataFrame:
    """Reads, molecules and families of several reads of keys at each rate, of a draw by ``thinned``."""
    t = thinned(families, keys, rates, seed)
    return t.groupBy(*keys, "rate").agg(F.sum(F.col("kept") * F.col("n")).alias("reads"), F.sum("n").alias("umis"), F.coalesce(F.sum(F.when(F.col("kept") > 1, F.col("n"))), F.lit(0)).alias("families"))


def downsampled_thresholds(families: DataFrame, keys: list[str], rates: int = 10, seed: int = 1) -> DataFrame:
    """Reads and molecules of keys at each rate and family-size threshold; 0 counts each read."""
    t = thinned(families, keys, rates, seed).withColumn("f", F.explode(F.array(*map(F.lit, FAMILY_SIZES)))).where("kept >= f")
    return t.groupBy(*keys, "rate", "f").agg(F.sum(F.col("kept") * F.col("n")).alias("reads"), F.sum(F.when(F.col("f") == 0, F.col("kept") * F.col("n")).otherwise(F.col("n"))).alias("umis"))


#: Products of up to so many factors are taken factor by factor.
FACTORS = 64


def expected_downsampled(families: DataFrame, keys: list[str], rates: int = 10) -> DataFrame:
    """The exact mean, over all draws, of molecules and of families of several reads at each rate.

    A family of s of n reads is missed by k drawn reads with probability C(n - s, k) / C(n, k), and hit once with
    s C(n - s, k - 1) / C(n, k). Families are counted by size first.
    """
    sizes = families.groupBy(*keys, F.col("size").cast("long").alias("size_")).agg(F.count(F.lit(1)).alias("m_")).where("size_ > 0")
    total = sizes.groupBy(*keys).agg(F.sum(F.col("size_") * F.col("m_")).alias("n_"))
    x = sizes.join(total, keys).withColumn("rate", F.explode(F.sequence(F.lit(1), F.lit(rates)))).withColumn("k_", F.rint(F.col("rate") * F.col("n_") / rates).cast("long"))
    s, n, k, m = (F.col(c) for c in ("size_", "n_", "k_", "m_"))
    # in logarithms of products of s factors, each a ratio of reads not drawn to reads; of many factors by logarithms of gamma,
    # so the work of a family does not grow with its reads
    lg = lambda x: log_gamma(F.greatest(x, F.lit(1)).cast("double"))
    log = lambda up, down: F.log(F.try_divide(up.cast("double"), down.cast("double")))
    gone = F.aggregate(F.sequence(F.lit(0).cast("long"), s - 1), F.lit(0.0), lambda a, i: a + log(n - k - i, n - i))
    once = F.aggregate(F.sequence(F.lit(0).cast("long"), s - 2), F.lit(0.0), lambda a, i: a + log(n - k - i, n - 1 - i))
    gone = F.when(s <= FACTORS, gone).otherwise(lg(n - k + 1) - lg(n - k - s + 1) - lg(n + 1) + lg(n - s + 1))
    once = F.when(s <= FACTORS, once).otherwise(lg(n - k + 1) - lg(n - k - s + 2) - lg(n) + lg(n - s + 1))
    none = F.when(n - k < s, 0.0).otherwise(F.exp(gone))
    single = F.when(s == 1, k / n).when(n - k < s - 1, 0.0).otherwise(s * k / n * F.exp(once))
    return x.groupBy(*keys, "rate").agg(F.max(k).alias("reads"), F.greatest(F.sum(m * (1 - none)), F.lit(0.0)).alias("umis"), F.greatest(F.sum(m * (1 - none - single)), F.lit(0.0)).alias("families"))


def saturation(down: DataFrame, rates: int = 10) -> DataFrame:
    """The curve of all regions together: reads, molecules and families by rate, and the share of the last rate's molecules."""
    t = down.groupBy("rate").agg(F.sum("reads").alias("reads"), F.sum("umis").alias("umis"), F.sum("families").alias("families"))
    last = t.where(F.col("rate") == rates).select(F.col("umis").alias("all_"))
    return t.crossJoin(F.broadcast(last)).select((F.col("rate") / rates).alias("rate"), "reads", "umis", "families", F.coalesce(F.try_divide("umis", "all_"), F.lit(0.0)).alias("saturation"))


def write_downsampled(curve: DataFrame, path: str) -> None:
    """The curve as one tab-separated file with a header."""
    curve.orderBy("rate").coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True)
