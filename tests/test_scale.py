"""Draws against their exact mean, and the operators for large inputs against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from molcount.functions import expr
from molcount.operators import cluster, consensus, grouping, stats
from molcount.plans import store


@pytest.mark.parametrize(("size", "block"), [(2, 4096), (10, 4096), (20, 4096), (10, 7)])
def test_draws_have_the_exact_mean(spark, monkeypatch, size, block):
    monkeypatch.setattr(stats, "BLOCK_FAMILIES", block)
    keys, families = 120, 25
    f = spark.range(keys * families).select((F.col("id") % keys).alias("k"), F.col("id").alias("member"), F.lit(size).cast("long").alias("size"))
    got = {(r["k"], r["rate"]): r for r in stats.downsampled(f, ["k"]).collect()}
    mean = {r["rate"]: r for r in stats.expected_downsampled(f, ["k"]).where("k = 0").collect()}
    n = size * families
    for rate in range(1, 11):
        k = round(rate * n / 10)
        p0 = math.comb(n - size, k) / math.comb(n, k)
        p1 = size * math.comb(n - size, k - 1) / math.comb(n, k)
        assert mean[rate]["umis"] == pytest.approx(families * (1 - p0)) and mean[rate]["families"] == pytest.approx(families * (1 - p0 - p1))
        assert all(got[(key, rate)]["reads"] == k for key in range(keys))
        for name, p in (("umis", 1 - p0), ("families", 1 - p0 - p1)):
            seen = sum(got[(key, rate)][name] for key in range(keys)) / (keys * families)
            assert abs(seen - p) <= 5 * math.sqrt(max(p * (1 - p), 0) / (keys * families)) + 1e-9, (rate, name)


def test_draws_of_mixed_sizes_favour_none(spark):
    """Large families are hit as often as their share of the reads says."""
    f = spark.range(3000).select((F.col("id") % 100).alias("k"), F.col("id").alias("member"), F.when(F.col("id") < 1500, 1).otherwise(9).cast("long").alias("size"))
    t = stats.thinned(f, ["k"]).where("rate = 3").groupBy().agg(F.sum(F.when(F.col("kept") > 1, F.col("n"))).alias("several"), F.sum(F.col("kept") * F.col("n")).alias("reads")).first()
    exact = stats.expected_downsampled(f, ["k"]).where("rate = 3").groupBy().agg(F.sum("families").alias("x")).first()["x"]
    assert t["reads"] == 100 * 45 and abs(t["several"] - exact) < 5 * math.sqrt(exact)
    again = stats.thinned(f.repartition(7), ["k"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, stats.thinned(f, ["k"]).collect()))
    assert stats.downsampled(f.where("false"), ["k"]).count() == 0
    assert stats.downsampled(f.withColumn("k", F.lit(None).cast("string")), ["k"]).where("rate = 10").first()["umis"] == 3000


def test_a_key_of_more_reads_than_numbers_drawn_exactly(spark):
    f = spark.createDataFrame([("x", i, 400_000_000) for i in range(30)], "k string, member long, size long")
    got = {r["rate"]: r["reads"] for r in stats.downsampled(f, ["k"]).collect()}
    assert got == {r: round(r * 30 * 400_000_000 / 10) for r in range(1, 11)}


def test_islands_of_any_bins(spark):
    rng = random.Random(3)
    for n, top, t in ((30, 300, 3), (200, 3000, 0), (800, 9000, 20)):
        rows = sorted({(rng.choice("ab"), rng.randrange(top)) for _ in range(n)})
        want, last = {}, None
        for c, p in rows:
            if last is None or c != last[0] or p > last[1] + t:
                start = p
            want[(c, p)], last = start, (c, p)
        ends = {}
        for (c, p), s in want.items():
            ends[(c, s)] = max(ends.get((c, s), 0), p + 1)
        for width in (7, 64, 1 << 16):
            got = {(r[0], r[1]): (r[2], r[3]) for r in grouping.islands_of(spark.createDataFrame(rows, "contig string, pos long"), t, width).collect()}
            assert got == {(c, p): (s, ends[(c, s)]) for (c, p), s in want.items()}


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_edges_of_large_regions(spark, distance):
    rng = random.Random(distance)
    pool = {"".join(rng.choice("ACGT") for _ in range(6)) for _ in range(150)}
    pool |= {b[:i] + rng.choice("ACGTN") + b[i + 1 :] for b in sorted(pool)[:60] for i in (0, 3, 5)}
    fam = [("a", 1, b, rng.randrange(1, 6)) for b in sorted(pool)]
    mixed = [("b", 1, b, rng.randrange(1, 6)) for b in sorted({b[: rng.choice((5, 6))] for b in pool})]
    df = spark.createDataFrame(fam + mixed, "contig string, region_start long, barcode string, cnt long")
    got = {(r["contig"], r["barcode"], r["other"]) for r in cluster.edges(df, distance).collect()}
    far = lambda a, b: sum(x != y for x, y in zip(a, b, strict=False))
    near = {(c, a, b) for c, _, a, m in fam for _, _, b, n in fam if (m > n or (m == n and a < b)) and far(a, b) <= distance}
    assert {g for g in got if g[0] == "a"} == near
    # of unlike lengths, those that share a half or a third
    parts = 3 if distance == 2 else 2
    cut = lambda b: [b[i * (len(b) // parts) : (i + 1) * (len(b) // parts) if i + 1 < parts else None] for i in range(parts)]
    near = {(c, a, b) for c, _, a, m in mixed for _, _, b, n in mixed if (m > n or (m == n and a < b)) and far(a, b) <= distance and any(x == y for x, y in zip(cut(a), cut(b), strict=True))}
    assert {g for g in got if g[0] == "b"} == near


def test_unmapped_reads_are_fragments_but_no_reads(spark):
    reads = [("r1", "a", 5, "AAAA", "ACGT", [30] * 4, 1, 0), ("r2", "a", 5, "AAAA", "ACGT", [30] * 4, 2, 4), ("r3", "a", 5, "AAAA", "ACGT", [30] * 4, 3, 16), ("r4", "a", 5, "CCCC", "TTTT", [30] * 4, 4, 4)]
    r = spark.createDataFrame(reads, "qname string, contig string, pos long, barcode string, seq string, quals array<int>, ordinal long, flag int")
    placed = grouping.islands(r)
    fam = grouping.families(placed)
    assert {x["barcode"]: x["cnt"] for x in fam.collect()} == {"AAAA": 3, "CCCC": 1}
    a = consensus.assign(placed, cluster.clusters(fam, 0))
    assert sorted(x["qname"] for x in a.collect()) == ["r1", "r3"]
    assert {x["cluster_count"] for x in a.collect()} == {3}
    assert consensus.singletons(a).count() == 0


def test_tables_of_rounds_go(spark):
    before = len(store._kept)
    fam = spark.createDataFrame([("a", 1, b, n) for b, n in (("AAAA", 9), ("AAAC", 5), ("AACC", 3), ("ACCC", 2))], "contig string, region_start long, barcode string, cnt long")
    assert {r["barcode"]: r["centroid"] for r in cluster.claims(fam, 1).collect()} == {"AAAA": "AAAA", "AAAC": "AAAA", "AACC": "AACC", "ACCC": "AACC"}
    assert len(store._kept) == before + 1


def test_phred_zero_and_n_say_nothing(spark):
    pile = spark.createDataFrame([("f", 1, "A", 0), ("f", 1, "C", 20), ("f", 1, "N", 30)], "k string, ref_pos long, base string, phred int")
    c = consensus.columns(pile, ["k"]).first()
    assert (c["base"], c["coverage"], c["kinds"]) == ("C", 3, 3) and expr.MAX_PHRED == 60


def test_means_of_large_families(spark):
    """The work of a family does not grow with its reads, nor must they fit an array."""
    f = spark.createDataFrame([("x", i, s) for i, s in enumerate((3, 64, 65, 700, 5000))] + [("y", 9, 3_000_000_000), ("y", 10, 1)], "k string, member long, size long")
    got = {(r["k"], r["rate"]): r for r in stats.expected_downsampled(f, ["k"]).collect()}
    sizes = (3, 64, 65, 700, 5000)
    n = sum(sizes)
    for rate in range(1, 11):
        k = round(rate * n / 10)
        p0 = [math.comb(n - s, k) / math.comb(n, k) for s in sizes]
        p1 = [s * math.comb(n - s, k - 1) / math.comb(n, k) for s in sizes]
        assert got[("x", rate)]["umis"] == pytest.approx(sum(1 - p for p in p0), abs=1e-6)
        assert got[("x", rate)]["families"] == pytest.approx(sum(1 - p - q for p, q in zip(p0, p1, strict=True)), abs=1e-6)
        assert got[("y", rate)]["umis"] == pytest.approx(1 + rate / 10, abs=1e-6)


def test_fragments_are_dealt_before_they_are_told_apart(spark):
    rows = [("c", 1, 9, b, q) for b, q in [("A", "x"), ("A", "x"), ("A", "y"), ("A", None), ("C", None), ("C", None), ("G", "x")]] + [("c", 1, 9, None, "z"), ("d", 1, 9, "A", "x")]
    fam = grouping.families(spark.createDataFrame(rows, "contig string, region_start long, region_end long, barcode string, qname string"))
    assert {(r["contig"], r["barcode"]): r["cnt"] for r in fam.collect()} == {("c", "A"): 2, ("c", "C"): 0, ("c", "G"): 1, ("c", None): 1, ("d", "A"): 1}
    plan = fam._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan.split("Exchange")[-1]  # nothing holds all names before they are dealt
