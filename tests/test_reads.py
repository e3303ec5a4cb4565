"""Operators on reads: small examples, and every registered query against its SQL."""

import gzip
import math
import random
import struct
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from molcount.functions import expr
from molcount.operators import cluster, consensus, counts, grouping, intervals, preprocess, stats, variants
from molcount.plans import registry
from molcount.sources import reads as sources
from molcount.sources import text

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(spark, column, **lit):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in lit.items()]).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("name", ["q_regions", "q_merge_regions", "q_regions_bed", "q_edges", "q_clusters", "q_position_consensus", "q_indel_reads", "q_cons", "q_overall_stats", "q_downsample_expected", "q_variants_bb", "q_mutation_metrics"])
def test_query_equals_sql(spark, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda d: sorted(map(str, d[sorted(d.columns)].astype(object).where(d.notna(), None).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)


def test_every_query_has_sql():
    # seeded random draws and alignments have none
    assert set(registry.QUERIES) - set(registry.ORACLES) <= {"q_downsample", "q_downsample_thresholds", "q_aligned_consensus"}


# --- expressions --------------------------------------------------------------------------------
def test_expressions(spark):
    assert value(spark, expr.hamming(F.col("a"), F.col("b")), a="ACGT", b="AGGA") == 2
    assert value(spark, expr.barcode_of(F.col("a")), a="x:y:ACGT") == "ACGT"
    assert value(spark, expr.run_lengths(F.col("a")), a="MMMIIMDD") == "3M2I1M2D"
    assert value(spark, expr.quality_string(expr.phreds(F.col("a"))), a="!I?") == "!I?"
    name = "Consensus_read_0_TTGTAAAGCATGAAATAGC_a_Count=144"
    assert value(spark, expr.name_kind(F.col("a")), a=name) == "Consensus" and value(spark, expr.name_count(F.col("a")), a=name) == 144
    assert value(spark, expr.sample_name(F.col("a")), a="/d/x.fastq.gz") == "x" and value(spark, expr.sample_name(F.col("a"), "paired"), a="/d/x_R1_001.fastq.gz") == "x"


# --- regions -------------------------------------------------------------------------------------
def bed(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "contig string, start long, end long, name string, ord int")


def test_merge_regions(spark):
    got = lambda b, t: [tuple(r) for r in intervals.merge_regions(b, t).orderBy("start").collect()]
    b = bed(spark, ("chr1", 100, 200, "region1"), ("chr1", 190, 300, "region2"), ("chr1", 500, 600, "region3"))
    assert got(b, 0) == [("chr1", 100, 300, "region1,region2"), ("chr1", 500, 600, "region3")]
    assert got(bed(spark, ("chr1", 100, 200, "a"), ("chr1", 210, 300, "a")), 10) == [("chr1", 90, 310, "a")]
    # the last end counts, not the largest
    assert got(bed(spark, ("c", 1, 100, "a"), ("c", 5, 10, "b"), ("c", 50, 60, "c")), 0) == [("c", 1, 10, "a,b"), ("c", 50, 60, "c")]


def test_annotations(spark):
    b = bed(spark, ("chr1", 100, 200, "x"), ("chr1", 150, 300, "y"))
    p = spark.createDataFrame([("chr1", 100), ("chr1", 175), ("chr1", 200), ("chr1", 301), ("chr2", 150)], "contig string, position long")
    want = {100: "x", 175: "x,y", 200: "x,y", 301: "", 150: ""}
    for limit in (100_000, 0):  # broadcast, and bins
        intervals.BROADCAST_ROWS = limit
        assert {r["position"]: r["name"] for r in intervals.annotate_all(p, b, F.col("position"), ["contig", "position"]).collect()} == want
    intervals.BROADCAST_ROWS = 100_000
    spans = spark.createDataFrame([("chr1", 90, 310), ("chr1", 190, 400)], "contig string, start long, end long")
    assert {r["start"]: r["name"] for r in intervals.end_inside(spans, b, ["contig", "start", "end"]).collect()} == {90: "", 190: "x"}
    assert {r["start"]: r["name"] for r in intervals.first_overlap(spans, b, ["contig", "start", "end"]).collect()} == {90: "x", 190: "x"}


def test_islands_and_fragments(spark):
    rows = [("r1", "c", 10, "A"), ("r1", "c", 12, "A"), ("r2", "c", 30, "A"), ("r3", "c", 51, "B"), ("r4", "c", 10, "A")]
    placed = grouping.islands(spark.createDataFrame(rows, "qname string, contig string, pos long, barcode string"))
    fam = grouping.families(placed)
    assert sorted(map(tuple, fam.collect())) == [("c", 10, 31, "A", 3), ("c", 51, 52, "B", 1)]
    assert grouping.without_singleton_regions(fam).count() == 1


# --- clusters -------------------------------------------------------------------------------------
def stars(counts_, d):
    seeds, out = [], {}
    for bc, _ in sorted(counts_.items(), key=lambda x: (-x[1], x[0])):
        near = next((s for s in seeds if sum(a != b for a, b in zip(s, bc, strict=True)) <= d), None)
        out[bc] = near or bc
        if not near:
            seeds.append(bc)
    return out


@pytest.mark.parametrize("d", [1, 2])
def test_clusters(spark, d):
    rng = random.Random(3)
    sets = [{"ACGTACGTACGT": 10, "ACGTACGTACGA": 2, "ACGTACGTACGG": 3, "GGGGGGGGGGGG": 5, "GGGGGGGGGGGA": 1}]
    sets += [{"".join(rng.choice("ACG") for _ in range(5)): rng.randrange(1, 9) for _ in range(40)} for _ in range(4)]
    rows = [("c", i, 0, b, n) for i, s in enumerate(sets) for b, n in s.items()]
    got = cluster.clusters(spark.createDataFrame(rows, "contig string, region_start long, region_end long, barcode string, cnt long"), d).collect()
    for i, s in enumerate(sets):
        assert {r["barcode"]: r["centroid"] for r in got if r["region_start"] == i} == stars(s, d)
    assert sorted({r["cluster_count"] for r in got if r["region_start"] == 0}) == [6, 15]


def test_edges_and_blocks(spark):
    rng = random.Random(42)
    many = {"".join(rng.choice("ACGT") for _ in range(12)): rng.randrange(1, 100) for _ in range(50)} | {"AAAAAAAAAAAA": 50, "AAAAAAAAAAAC": 10, "AAAAAAAAAAAG": 5}
    fam = spark.createDataFrame([("c", 1, b, n) for b, n in many.items()] + [("c", 2, "AAAA", 3), ("c", 2, "AAAC", 3)], "contig string, region_start long, barcode string, cnt long")
    got = {(r["barcode"], r["other"]) for r in cluster.edges(fam, 1).collect()}
    ok = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True)) == 1 and (many[a], b) > (many[b], a)
    assert {e for e in got if len(e[0]) == 12} == {(a, b) for a in many for b in many if a != b and ok(a, b)}
    assert ("AAAA", "AAAC") in got and cluster.edges(fam, 3).where("region_start = 1").count() == 0


# --- consensus ------------------------------------------------------------------------------------
def column(spark, *alleles):
    rows = [("f", 1, a, q) for a, qs in alleles for q in qs]
    return consensus.columns(spark.createDataFrame(rows, "f string, ref_pos long, base string, phred int"), ["f"]).first()


def posterior(alleles):
    like = {b: math.prod((1 - 10 ** (-q / 10)) if a == b else 10 ** (-q / 10) for a, qs in alleles for q in qs if a != "N" and q) for b in "ATCG"}
    best = max("ATCG", key=lambda b: (round(math.log(like[b]), 9), -"ATCG".index(b)))  # equal up to rounding: by order
    p = like[best] / sum(like.values())
    return best, 60 if p == 1 else min(60, round(-10 * math.log10(1 - p)))


@pytest.mark.parametrize("alleles", [[("A", [30] * 4)], [("A", [30, 30, 25]), ("C", [20])], [("T", [35] * 4)], [("A", [10, 10]), ("C", [10, 10])], [("N", [2, 2])], [("G", [12, 7]), ("T", [9])]])
def test_column_posterior(spark, alleles):
    got = column(spark, *alleles)
    assert (got["base"], got["quality"]) == posterior(alleles)


def test_deep_column_takes_the_most_common(spark):
    got = column(spark, ("A", [2] * 20), ("C", [2] * 31))
    assert (got["base"], got["quality"], got["coverage"]) == ("C", 60, 51)


def test_count_table_ties_and_coverage(spark):
    obs = spark.createDataFrame([("c", 9, 0, "A", 5), ("c", 9, 0, "C", 2), ("c", 9, 0, "T", 2), ("c", 9, 0, "I", 9), ("c", 9, 1, "A", 5)], "contig string, ref_pos long, fsize int, allele string, n long")
    ref = spark.createDataFrame([("c", 9, "A")], "contig string, ref_pos long, reference string")
    got = {r["fsize"]: r for r in counts.table(obs, ref).collect()}
    assert (got[0]["position"], got[0]["coverage"], got[0]["alt_allele"], got[0]["alt_frequency"]) == (10, 9, "I", 1.0)
    assert (got[1]["alt_allele"], got[1]["alt_count"]) == ("", 0)


def test_thresholds(spark):
    sizes = {(1, 5, ""): ([5, 3], 2), (9, 15, "x"): ([4, 2], 3)}
    rows = [("c", a, b, n, False) for (a, b, _), (f, _) in sizes.items() for n in f] + [("c", a, b, 1, True) for (a, b, _), (_, k) in sizes.items() for _ in range(k)]
    names = spark.createDataFrame([(a, n) for a, _, n in sizes], "start long, name string")
    reg = stats.regions(spark.createDataFrame(rows, "contig string, start long, end long, size long, single boolean")).join(names, "start")
    assert sorted(r["value"] for r in stats.lines(reg).collect()) == ["c:1\tc:1-5\t\tconsensus_reads: 2\tsingletons: 2", "c:9\tc:9-15\tx\tconsensus_reads: 2\tsingletons: 3"]
    t = stats.thresholds(reg)
    got = {(r["start"], r["f"]): (r["reads"], r["umis"]) for r in t.collect()}
    assert got[1, 0] == (10, 10) and got[1, 1] == (10, 4) and got[1, 2] == (8, 2) and got[9, 3] == (4, 1) and got[9, 30] == (0, 0)
    all_ = {r["f"]: (r["reads"], r["umis"]) for r in stats.report(t).where("region = 'All'").collect()}
    assert all_[0] == (19, 19)
    assert {r["f"]: r["on_target"] for r in stats.target_coverage(t).collect()}[0] == 9


def test_downsampling(spark):
    f = spark.createDataFrame([("x", i, 1 + i % 7) for i in range(40)], "k string, member long, size long")
    got = {r["rate"]: r for r in stats.downsampled(f, ["k"]).collect()}
    total = sum(1 + i % 7 for i in range(40))
    assert got[10]["reads"] == total and got[10]["umis"] == 40
    assert all(got[r]["reads"] == round(r * total / 10) for r in got) and all(got[r]["umis"] <= got[r + 1]["umis"] for r in range(1, 10))


def test_q_score(spark):
    lg = math.lgamma
    pmf = lambda k, n, a, b: math.exp(lg(n + 1) - lg(k + 1) - lg(n - k + 1) + lg(k + a) + lg(n - k + b) - lg(n + a + b) + lg(a + b) - lg(a) - lg(b))
    rows = [(a, n) for n in (10, 400, 3000, 200_000) for a in (1, 2, 5, 9)]
    got = spark.createDataFrame(rows, "a long, n long").withColumn("q", variants.q_score(F.col("a"), F.col("n"))).collect()
    for r in got:
        p = 1 - sum(pmf(k, r["n"], variants.ALPHA, variants.BETA) for k in range(r["a"]))
        assert abs(r["q"] + 10 * math.log10(max(p, 1e-10))) < 0.01


def test_beta_fit():
    rng = random.Random(1)
    v = [rng.betavariate(2.0, 50.0) for _ in range(4000)]
    n, m = len(v), sum(v) / len(v)
    a, b = variants.fit_beta(n, m, sum((x - m) ** 2 for x in v) / n, sum(map(math.log, v)), sum(math.log(1 - x) for x in v))
    assert abs(a - 2) < 0.15 and abs(b - 50) < 4


# --- raw reads and files -----------------------------------------------------------------------------
def test_extraction_and_trimming(spark):
    r = spark.createDataFrame([("n1 x", "ACGTTTGGGG", "IIIIIIIIII"), ("solo", "CCCCAAGG", "IIIIIIII")], "name string, seq string, qual string")
    assert [tuple(x) for x in preprocess.extract(r, 4, 2).collect()] == [("n1:ACGT x", "ACGT", "GGGG", "IIII"), ("solo:CCCC solo", "CCCC", "GG", "II")]
    p = r.selectExpr("name as name1", "seq as seq1", "qual as qual1", "name as name2", "reverse(seq) as seq2", "qual as qual2")
    got = preprocess.extract_pairs(p, 2, dual=True).collect()
    assert got[0]["barcode"] == "ACGG" and got[0]["seq2"] == "GGTTTGCA"
    assert preprocess.extract_pairs(p, 2, reverse=True).collect()[0]["barcode"] == "GG"
    a = spark.createDataFrame([("r", "A" * 25 + "AGATCGG" + "CC", "I" * 34), ("s", "A" * 22 + "AGATC", "I" * 27), ("t", "CCCAGA", "IIIIII")], "name string, seq string, qual string")
    assert {x["name"]: len(x["seq"]) for x in preprocess.trim_adapter(a, "AGATCGG").collect()} == {"r": 25, "s": 22}
    assert preprocess.quality_filter(r, mean=41).count() == 0 and preprocess.quality_filter(r, mean=30).count() == 2


def test_text_sources(spark, tmp_path):
    (tmp_path / "a.bed").write_text("chr1 100 200 r1 0 x\nchr1\t5\t6\nchr2\t1000\t1100\tr4\n")
    assert [(r["contig"], r["start"], r["name"]) for r in text.bed(spark, str(tmp_path / "a.bed")).orderBy("ord").collect()] == [("chr1", 100, "r1"), ("chr2", 1000, "r4")]
    (tmp_path / "m.bed").write_text("# comment\n\nchr1\t5\t6\tm1\tA\tC\textra\n")
    assert text.mutations(spark, str(tmp_path / "m.bed")).first()["alt"] == "C"
    (tmp_path / "bad.bed").write_text("chr1\t5\t6\tm1\n")
    with pytest.raises(Exception, match="six fields"):
        text.mutations(spark, str(tmp_path / "bad.bed")).collect()
    (tmp_path / "r.fa").write_text(">3 x\nacg\nTT\n>4\nGG\n")
    assert [(r["contig"], r["ref_pos"], r["reference"]) for r in text.fasta(spark, str(tmp_path / "r.fa")).orderBy("contig", "ref_pos").collect()] == [("3", 0, "A"), ("3", 1, "C"), ("3", 2, "G"), ("3", 3, "T"), ("3", 4, "T"), ("4", 0, "G"), ("4", 1, "G")]
    (tmp_path / "x.sam").write_text("@HD\tVN:1\nq:ACGT\t0\tchr1\t101\t60\t4M\t*\t0\t0\tACGT\tIIII\tUG:Z:a:b\tNM:i:0\n")
    r = text.sam(spark, str(tmp_path / "x.sam")).first()
    assert (r["pos"], r["quals"], r["tags"]) == (100, [40] * 4, {"UG": "a:b", "NM": "0"})
    (tmp_path / "sheet.csv").write_text("Sample,R1,R2\ns1,a,b\n")
    assert text.sample_sheet(str(tmp_path / "sheet.csv")) == [{"sample_name": "s1", "read1": "a", "read2": "b"}]
    for n in ("s_R1_001.fastq.gz", "s_R2_001.fastq.gz", "t_1.fastq", "u_R1_more.fastq", "vR1.fastq", "w.fq.gz"):
        (tmp_path / n).write_text("x")
    assert [(s, bool(b)) for s, _, b in text.samples(str(tmp_path))] == [("s", True), ("t", False), ("u", False), ("v", False)]
    assert [s for s, _, _ in text.samples_in_store(spark, str(tmp_path))] == ["s", "t", "u", "v"]


def test_count_table_round_trip(spark, tmp_path):
    t = registry.QUERIES["q_cons_annotated"](spark, SF).where("fsize = 3 and contig = 'chrAF'")
    text.write_count_table(t, str(tmp_path / "cons"))
    back = text.count_table(spark, str(tmp_path / "cons"))
    assert sorted(map(str, back.select(*sorted(back.columns)).collect())) == sorted(map(str, t.select(*sorted(t.columns)).collect()))


def block(data):
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return struct.pack("<BBBBIBBHBBHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def test_read_files(spark, tmp_path):
    with gzip.open(tmp_path / "a.fastq.gz", "wt") as f:
        f.write("@r1 x\nACGT\n+\nIIII\n@r2\nGG\n+\n!!\n")
    head = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000)
    rec = struct.pack("<iiBBHHHiiii", 0, 99, 3, 60, 0, 1, 0, 4, -1, -1, 0) + b"q1\0" + struct.pack("<I", 4 << 4) + bytes([0x12, 0x48]) + bytes([30, 31, 32, 33])
    data = head + struct.pack("<i", len(rec)) + rec
    (tmp_path / "a.bam").write_bytes(block(data[:20]) + block(data[20:]) + block(b""))
    sources.register(spark)
    got = spark.read.format("fastq").option("path", str(tmp_path / "*.fastq.gz")).load().orderBy("ordinal").collect()
    assert [(r["name"], r["seq"], r["qual"]) for r in got] == [("@r1 x", "ACGT", "IIII"), ("@r2", "GG", "!!")]
    r = spark.read.format("bam").option("path", str(tmp_path / "a.bam")).load().first()
    assert (r["qname"], r["contig"], r["pos"], r["cigar"], r["seq"], r["quals"]) == ("q1", "chr1", 99, "4M", "ACGT", [30, 31, 32, 33])
