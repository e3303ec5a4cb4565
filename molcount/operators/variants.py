"""Variant calls from the count table, and the background model."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The background's default parameters.
ALPHA, BETA = 2.168215069116764, 3531.588541594945


def candidates(cons: DataFrame, fsize: int = 3) -> DataFrame:
    """Rows of one threshold with an other allele."""
    return cons.where((F.col("fsize") == fsize) & (F.col("alt_frequency") > 0) & ~F.col("alt_allele").isin("", "N"))


def by_count(cons: DataFrame, fsize: int = 3, cutoff: int = 3) -> DataFrame:
    return candidates(cons, fsize).where(F.col("alt_count") >= cutoff)


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function of x > 0: Stirling's series, from 8 steps further on for small x."""
    y = x + 8.0
    series = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * F.pow(y, 3)) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    steps = F.lit(1.0)
    for k in range(8):
        steps = steps * (x + float(k))
    return series - F.log(steps)


def q_score(a: Column, n: Column, alpha: float = ALPHA, beta: float = BETA) -> Column:
    """-10 log10 of the beta-binomial chance of a or more among n, at least 1e-10 of chance.

    The chances of 0, 1, ... follow from each other by their ratio; that of 0 is by logarithms of
    gamma. The sum ends at so many other alleles that, for a background near 0, more have less than the
    least chance that counts; so its length follows the background's share of the depth, not the depth.
    """
    first = log_gamma(F.lit(float(beta)) + n) - log_gamma(F.lit(float(alpha + beta)) + n) + (math.lgamma(alpha + beta) - math.lgamma(beta))
    start = F.struct(F.exp(first).alias("p"), F.lit(0.0).alias("s"))

    def step(x, k):
        ratio = (n - k) * (F.lit(alpha) + k) / ((k + 1) * (n - k - 1 + F.lit(beta)))
        return F.struct((x["p"] * ratio).alias("p"), (x["s"] + x["p"]).alias("s"))

    # beyond so many other alleles the chance is under the least one, whatever the depth
    last = F.least(a.cast("long"), F.ceil(n * (alpha + 12 * math.sqrt(alpha) + 30) / (alpha + beta)) + 60)
    below = F.aggregate(F.sequence(F.lit(0), last.cast("int") - 1), start, step)["s"]
    return -10 * F.log10(F.greatest(1 - below, F.lit(1e-10)))


def by_background(cons: DataFrame, fsize: int = 3, threshold: float = 0.01, alpha: float = ALPHA, beta: float = BETA) -> DataFrame:
    return candidates(cons, fsize).withColumn("q", q_score(F.col("alt_count"), F.col("coverage"), alpha, beta)).where(F.col("q") >= threshold)


def q_histogram(calls: DataFrame, bins: int = 100) -> DataFrame:
    """(bin, low, high, n): so many bins of equal width from the least to the largest q, empty ones too.

    The largest q belongs to the last bin, also where all are equal. Without calls all bins are empty and have no borders.
    """
    ends = calls.agg(F.min("q").alias("lo"), F.max("q").alias("hi"))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("q") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))).otherwise(bins - 1).cast("int")
    n = calls.where("q is not null").crossJoin(F.broadcast(ends)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    grid = calls.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(ends))
    return grid.join(n, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * width).alias("low"), (F.col("lo") + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def vcf_lines(calls: DataFrame, low_q: float = 10.0, low_count: int = 5) -> DataFrame:
    """The data lines of a VCF file; a field without a value is a dot."""
    marks = F.concat_ws(",", F.when(F.col("q") < low_q, "q10"), F.when(F.col("alt_count") < low_count, "a5"))
    info = F.concat(F.lit("DP="), F.col("coverage").cast("string"), F.lit(";AD="), F.col("alt_count").cast("string"), F.lit(";AF="), F.format_string("%.6g", F.col("alt_count") / F.col("coverage")))
    dot = lambda c: F.coalesce(F.when(c != "", c), F.lit("."))
    fields = ["contig", F.col("position").cast("string"), F.lit("."), dot(F.col("reference")), dot(F.col("alt_allele")), F.coalesce(F.when(F.col("q").isNotNull(), F.format_string("%.2f", "q")), F.lit(".")), F.when(marks == "", "PASS").otherwise(marks), info]
    return calls.select(F.concat_ws("\t", *fields).alias("value"))


def beta_statistics(cons: DataFrame, known: DataFrame | None = None, fsize: int = 3) -> DataFrame:
    """What the fit needs of the frequencies between 0 and 1: count, mean, variance and sums of logarithms.

    known: (contig, position) to leave out.
    """
    x = candidates(cons, fsize).where("alt_frequency < 1")
    if known is not None:
        x = x.join(known.select("contig", "position").distinct(), ["contig", "position"], "left_anti")
    v = F.col("alt_frequency")
    return x.agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("variance"), F.sum(F.log(v)).alias("log_sum"), F.sum(F.log(1 - v)).alias("log1_sum"))


def fit_beta(n: int, mean: float, variance: float, log_sum: float, log1_sum: float, rounds: int = 400) -> tuple[float, float]:
    """Beta parameters of highest likelihood from the statistics: moments first, then a simplex over their logarithms."""
    k = mean * (1 - mean) / variance - 1 if variance > 0 else 1.0
    start = [math.log(max(mean * k, 1e-3)), math.log(max((1 - mean) * k, 1e-3))]

    def loss(x):
        a, b = math.exp(x[0]), math.exp(x[1])
        return -((a - 1) * log_sum + (b - 1) * log1_sum - n * (math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)))

    points = [start, [start[0] + 0.5, start[1]], [start[0], start[1] + 0.5]]
    for _ in range(rounds):
        points.sort(key=loss)
        low, mid, high = points
        c = [(low[i] + mid[i]) / 2 for i in (0, 1)]
        at = lambda t: [c[i] + t * (high[i] - c[i]) for i in (0, 1)]
        r = at(-1)
        if loss(r) < loss(low):
            e = at(-2)
            points[2] = e if loss(e) < loss(r) else r
        elif loss(r) < loss(mid):
            points[2] = r
        else:
            s = at(0.5)
            if loss(s) < loss(high):
                points[2] = s
            else:
                points[1:] = [[(low[i] + p[i]) / 2 for i in (0, 1)] for p in (mid, high)]
    best = min(points, key=loss)
    return math.exp(best[0]), math.exp(best[1])
