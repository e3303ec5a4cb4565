"""Consensus with insertions and deletions, against reads assembled by hand."""

import random

import by_hand
from pyspark.sql import functions as F

from molcount.operators import consensus, counts, indels

SCHEMA = "contig string, region_start long, centroid string, cluster_count long, qname string, ordinal long, pos long, cigar string, seq string, quals array<int>"


def reads(*rows):
    return [(p, c, s, [30] * len(s)) for p, c, s in rows]


def families(spark, fams):
    rows = [("c", 10, f"F{k}", max(2, len(f)), f"r{i}", i, p, c, s, q) for k, f in enumerate(fams) for i, (p, c, s, q) in enumerate(f)]
    return spark.createDataFrame(rows, SCHEMA)


def test_rules_by_hand():
    got = by_hand.assemble(reads(*[(10, "3M2I2M", "ACGTTCA")] * 3))
    assert got[:2] == (10, "ACGTTCA") and got[2][3:5] == "]]" and got[3] == "3M2I2M" and got[4] == []
    assert by_hand.assemble(reads(*[(10, "2M2D2M", "ACCA")] * 3))[3] == "2M2D2M"
    # neither a base nor the deletion has enough
    assert by_hand.assemble(reads((10, "5M", "ACGTA"), (10, "5M", "ACGTA"), (10, "2M1D2M", "ACTA"), (10, "2M1D2M", "ACTA"))) is None
    # deletions of unlike length are not added up
    c = by_hand.columns(reads(*[(10, "6M", "ACGTAC")] * 3, *[(10, "2M1D3M", "ACTAC")] * 2, *[(10, "2M2D2M", "ACAC")] * 2))
    assert c[12].top() == ("G", 100 * 3 / 7)


def test_clips_and_indels_move_bases(spark):
    df = families(spark, [[(100, "2S3M1D2M2I1M", "TTACGTACCG", [30] * 10)]])
    assert sorted(tuple(r) for r in indels.pileup(df, []).select("ref_pos", "base").collect()) == [(100, "A"), (101, "C"), (102, "G"), (104, "T"), (105, "A"), (106, "G")]
    assert sorted(tuple(r) for r in indels.events(df, []).collect()) == [(103, "D", "", 1), (106, "I", "CC", 2)]


def test_columns_and_reads_like_those_by_hand(spark):
    rng = random.Random(5)
    fams = []
    for _ in range(150):
        ref = "".join(rng.choices("ACGT", k=14))
        fam = []
        shapes = rng.sample(["12M", "5M1D6M", "5M2D5M", "6M1I6M", "6M2I5M", "2S10M", "4M2D2M1D3M", "3M1I3M1D4M"], rng.choice([1, 1, 2, 3]))
        for _ in range(rng.choice([2, 3, 5, 8, 60])):
            cigar, seq, r = rng.choice(shapes), "", 0
            for n, op in by_hand._OP.findall(cigar):
                n = int(n)
                seq += ref[r : r + n] if op == "M" else "G" * n if op in "IS" else ""
                r += n if op in "MD" else 0
            seq = "".join(rng.choice("ACGT") if rng.random() < 0.03 else b for b in seq)
            fam.append((10, cigar, seq, [rng.choice([10, 30, 37]) for _ in seq]))
        fams.append(fam)
    df = families(spark, fams)
    got = {}
    for r in indels.assembled(indels.position_consensus(df)).collect():
        got.setdefault(r["centroid"], []).append((r["start"], r["seq"], r["qual"], r["cigar"]))
    ok = 0
    for k, fam in enumerate(fams):
        want = by_hand.assemble(fam)
        if want is None:
            assert f"F{k}" not in got
            continue
        start, seq, qual, cigar, splits = want
        # the last places may have fewer than two reads
        tail = len(seq) - len(seq.rstrip("N")) if qual.endswith("!") else 0
        if tail == 0 and not splits:
            assert got[f"F{k}"] == [(start, seq, qual, cigar)]
            ok += 1
    assert ok > 40


def test_indels_in_the_count_table(spark):
    df = families(spark, [[(10, "3M2I2M", "ACGTTCA", [30] * 7)] * 3, [(10, "2M2D2M", "ACCA", [30] * 4)] * 4])
    one = spark.createDataFrame([("c", 10, "S", 1, "s", 9, 10, "2M1D1M", "ACT", [30] * 3)], SCHEMA)
    obs = counts.observations(indels.position_consensus(df), consensus.singletons(df.unionByName(one)))
    n = {(r["ref_pos"], r["fsize"], r["allele"]): r["n"] for r in obs.groupBy("ref_pos", "fsize", "allele").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert n[13, 0, "I"] == 3 and n[13, 3, "I"] == 1 and (13, 4, "I") not in n
    assert n[12, 0, "D"] == 5 and n[12, 4, "D"] == 1 and n[12, 1, "D"] == 2 and (13, 0, "D") not in n


def test_marks_of_many_parts(spark):
    x = spark.range(60).select("id", consensus.part_mark(F.col("id")).alias("m")).collect()
    m = {r["id"]: r["m"] for r in x}
    assert (m[0], m[25], m[26], m[51], m[52]) == ("a", "z", "aa", "az", "ba")
