"""Commands from files to files, and operators over samples."""

import gzip
import json
import random

import pytest

from molcount import cli
from molcount.operators import analysis, cluster, grouping, variants
from molcount.sources import text


def lines(folder):
    return [x for p in sorted(folder.glob("part-*")) for x in (gzip.open(p, "rt") if p.suffix == ".gz" else p.open()).read().splitlines()]


def sam_line(name, pos, cigar, seq):
    return f"{name}\t0\tchr1\t{pos}\t60\t{cigar}\t*\t0\t0\t{seq}\t{'I' * len(seq)}\n"


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("files")
    (d / "ref.fa").write_text(">chr1\nACGTACGTACGT\n")
    fam = [sam_line(f"a{i}:AAAA", 1, "4M2D4M", "ACGTGTAC") for i in range(3)] + [sam_line(f"b{i}:CCCC", 1, "8M", "ACCTACGT") for i in range(6)]
    one = [sam_line("s:GGGG", 1, "2S6M", "TTACGTAC")]
    (d / "x.sam").write_text("@HD\tVN:1.6\n" + "".join(fam + one))
    (d / "r.bed").write_text("chr1\t2\t5\tspot\n")
    (d / "m.bed").write_text("chr1\t3\t3\tm1\tG\tC\n")
    return d


@pytest.fixture(scope="module")
def made(spark, files):
    out = files / "out" / "s1"
    cli.main(["consensus", "--reads", str(files / "x.sam"), "--reference", str(files / "ref.fa"), "--bed", str(files / "r.bed"), "--out", str(out)])
    return out


def test_consensus_reads_and_table(made):
    sam = lines(made / "consensus_sam")
    assert sam[:3] == ["@HD\tVN:1.6\tSO:coordinate", "@SQ\tSN:chr1\tLN:12", "@RG\tID:L1\tSM:L1"]
    body = {x.split("\t")[0]: x.split("\t") for x in sam[3:]}
    assert {k: (v[3], v[5], v[9]) for k, v in body.items()} == {"Consensus_read_0_AAAA_Count=3": ("1", "4M2D4M", "ACGTGTAC"), "Consensus_read_0_CCCC_Count=6": ("1", "8M", "ACCTACGT"), "Singleton_read_0_GGGG_Count=1": ("1", "2S6M", "TTACGTAC")}
    rows = [x.split("\t") for x in lines(made / "cons")]
    at = {(int(r[2]), int(r[13])): dict(zip(rows[0], r, strict=True)) for r in rows[1:]}
    assert (at[3, 0]["C"], at[3, 0]["G"], at[3, 0]["Coverage"], at[3, 0]["Name"]) == ("6", "4", "10", "spot")
    assert (at[5, 0]["D"], at[5, 3]["D"], at[5, 3]["A"]) == ("3", "1", "1") and at[6, 3]["D"] == "0" and at[1, 3]["Name"] in ("", '""')


def test_statistics_hold_single_reads(files, made):
    cli.main(["stats", "--reads", str(made / "consensus"), "--bed", str(files / "r.bed"), "--out", str(files / "stats")])
    got = {(r[0], r[3]): r[4:] for r in (x.split("\t") for x in lines(files / "stats" / "summary_statistics"))}
    assert got["chr1:0", "0"] == ["1.0", "10", "10"] and got["chr1:0", "1"] == ["1.0", "10", "3"] and got["All", "5"][1:] == ["6", "1"]
    assert lines(files / "stats" / "hist") == ["chr1:0\tchr1:0-10\t\tconsensus_reads: 2\tsingletons: 1"]


def test_calls_have_all_fields(spark, files, made):
    cli.main(["variants", "--table", str(made / "cons"), "--fsize", "0", "--out", str(files / "calls")])
    got = [x for x in lines(files / "calls" / "vcf") if not x.startswith("#")]
    assert sorted(got)[0] == "chr1\t3\t.\tG\tC\t.\tPASS\tDP=10;AD=6;AF=0.600000"
    cli.main(["variants", "--table", str(made / "cons"), "--fsize", "0", "--method", "bbmodel", "--out", str(files / "bb")])
    assert all(len(x.split("\t")) == 8 for x in lines(files / "bb" / "vcf") if not x.startswith("##"))
    big = spark.createDataFrame([("c", 5, "A", "T", 1000, 1_234_567, 1234.5)], "contig string, position long, reference string, alt_allele string, alt_count long, coverage long, q double")
    assert variants.vcf_lines(big).first()["value"].split("\t")[5] == "1234.50"


@pytest.mark.parametrize("more", [["--mode", "bed", "--bed"], ["--method", "most"], ["--method", "msa"]])
def test_other_modes_and_methods(files, more, tmp_path):
    more = [*more, str(files / "r.bed")] if more[-1] == "--bed" else more
    cli.main(["consensus", "--reads", str(files / "x.sam"), "--reference", str(files / "ref.fa"), *more, "--out", str(tmp_path / "o")])
    assert any(x.startswith("Consensus_read_") for x in lines(tmp_path / "o" / "consensus_sam"))


def test_modes_need_their_input(spark):
    r = spark.createDataFrame([("c", 1)], "contig string, pos long")
    for mode in ("bed", "tag", "else"):
        with pytest.raises(ValueError):
            grouping.placed(r, mode)
    with pytest.raises(ValueError):
        cli.method_of("median")
    assert [cli.method_of(m) for m in ("pos", "most", "MSA", "multiple")] == ["position", "most", "msa", "multiple"]


def test_many_samples(files, made):
    base = files / "out"
    cli.main(["run", "--reads", str(files / "x.sam"), str(files / "none.sam"), "--reference", str(files / "ref.fa"), "--out", str(files / "all")])
    rows = [x.split("\t") for x in lines(files / "all" / "summary")]
    assert {r[0].rsplit("/", 1)[-1]: (r[1], r[4], r[5]) for r in rows[1:]} == {"none.sam": ("failed", "2", "1"), "x.sam": ("ok", "2", "1")}
    cli.main(["aggregate", "--tables", str(base / "*" / "cons"), "--mutations", str(files / "m.bed"), "--fsize", "0", "--out", str(files / "agg")])
    head, *rest = [x.split("\t") for x in lines(files / "agg" / "mutation_metrics")]
    assert [r[head.index("alt_reads")] for r in rest if r[head.index("is_mutation")] == "true"] == ["6"]
    (files / "totals.tsv").write_text("sample\ttotal\tml_plasma\nsample\t40\t2.0\n")
    cli.main(["summarize", "--tables", str(base / "*" / "cons"), "--mutations", str(files / "m.bed"), "--totals", str(files / "totals.tsv"), "--fsize", "0", "--out", str(files / "sum")])
    assert lines(files / "sum" / "on_target_summary")[1] == "sample\t40\t10\tmutation_bed\t0.25"
    assert lines(files / "sum" / "mutation_metrics")[1].split("\t")[-1] == "3.0"
    (files / "sheet.csv").write_text(f'sample_name,read1,mutation_bed,ml_plasma\nsample,"a,b.fastq",{files / "m.bed"},2\nother,x,missing.bed,\n')
    cli.main(["analysis", "--sheet", str(files / "sheet.csv"), "--tables", str(base / "*" / "cons"), "--base", str(files), "--fsize", "0", "--out", str(files / "ana")])
    status = {r.split("\t")[0]: r.split("\t")[1] for r in lines(files / "ana" / "summary")[1:]}
    assert status == {"other": "failed", "sample": "ok"} and "mm_per_ml" in json.loads(lines(files / "ana" / "sample")[0])


def test_raw_reads_to_files(spark, files, tmp_path):
    (tmp_path / "a_R1.fastq").write_text("@r1 x\nACGTTTGG\n+\nIIIIIIII\n")
    (tmp_path / "a_R2.fastq").write_text("@r1 y\nCCCC\n+\nIIII\n")
    cli.main(["preprocess", "--read1", str(tmp_path / "a_R1.fastq"), "--read2", str(tmp_path / "a_R2.fastq"), "--length", "4", "--out", str(tmp_path / "o")])
    assert lines(tmp_path / "o" / "R1") == ["@r1:ACGT x", "TTGG", "+", "IIII"] and lines(tmp_path / "o" / "R2")[1] == "CCCC"


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_claims_equal_the_fold(spark, distance):
    rng = random.Random(distance)
    rows = []
    for region, n in (("a", 25), ("b", 60)):
        codes = {"".join(rng.choices("AC", k=7)) for _ in range(n)}
        rows += [("c", ord(region), 200, b, rng.randint(1, 4)) for b in codes]
    fam = spark.createDataFrame(rows, "contig string, region_start long, region_end long, barcode string, cnt long")
    fold, claim = [sorted(map(tuple, cluster.clusters(fam, distance, fold=f).collect())) for f in (500, 0)]
    assert fold == claim and len(fold) == len(rows)


def test_sources_of_samples(spark, tmp_path):
    (tmp_path / "s.tsv").write_text("region\tplace\tname\tfamily_size\tfraction\treads\tumis\nchr1:0\tchr1:0-9\tspot\t0\t1.0\t10\t9\nchr1:50\tp\t\t0\t1.0\t5\t5\nAll\tall\tall_regions\t0\t1.0\t15\t14\n")
    s = text.summary_statistics(spark, str(tmp_path / "s.tsv"))
    assert s.count() == 3
    from pyspark.sql import functions as F

    s = s.withColumn("sample", F.lit("s"))
    totals = spark.createDataFrame([("s", 20), ("t", 5)], "sample string, total long")
    assert {r["sample"]: (r["on_target"], r["method"], r["fraction"]) for r in analysis.on_target_fractions(totals, s).collect()} == {"s": (10, "region_bed", 0.5), "t": (None, "summary_stats_missing", None)}
    assert {r["method"] for r in analysis.on_target_fractions(totals).collect()} == {"unmeasured"}
    (tmp_path / "p").write_text("0.5\n600\n")
    assert text.background(str(tmp_path / "p")) == (0.5, 600.0) and text.background() == (variants.ALPHA, variants.BETA)
    with pytest.raises(ValueError):
        text.one_bam(str(tmp_path))
    (tmp_path / "a.bam").write_bytes(b"")
    assert text.one_bam(str(tmp_path)).endswith("a.bam")
    (tmp_path / "bad.csv").write_text("sample_name,read1\na,b\n")
    with pytest.raises(ValueError, match="mutation_bed"):
        text.analysis_sheet(str(tmp_path / "bad.csv"))


def test_members_targets_and_bam(spark, files, tmp_path):
    cli.main(["consensus", "--reads", str(files / "x.sam"), "--reference", str(files / "ref.fa"), "--bed", str(files / "r.bed"), "--json", "--only-targets", "--out", str(tmp_path / "o")])
    members = [json.loads(x) for p in (tmp_path / "o" / "members").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted((m["Name"], m["Consensus"], tuple(m["Members"].items())) for m in members) == [("Consensus_read_0_AAAA_Count=3", "ACGTGTAC", (("ACGTGTAC", 3),)), ("Consensus_read_0_CCCC_Count=6", "ACCTACGT", (("ACCTACGT", 6),))]
    rows = [x.split("\t") for x in lines(tmp_path / "o" / "cons")][1:]
    assert rows and {r[3] for r in rows} == {"spot"}
    # what was written as BAM is read again, by its folder
    again = cli.load(spark, str(tmp_path / "o" / "consensus_bam"))
    assert sorted((r["qname"], r["pos"], r["cigar"], r["seq"]) for r in again.collect()) == [("Consensus_read_0_AAAA_Count=3", 0, "4M2D4M", "ACGTGTAC"), ("Consensus_read_0_CCCC_Count=6", 0, "8M", "ACCTACGT"), ("Singleton_read_0_GGGG_Count=1", 0, "2S6M", "TTACGTAC")]


def test_downsample_to_files(files, made, tmp_path):
    cli.main(["downsample", "--reads", str(made / "consensus"), "--out", str(tmp_path / "d")])
    curve = [x.split("\t") for x in lines(tmp_path / "d" / "curve")]
    assert curve[0] == ["rate", "reads", "umis", "families", "saturation"] and [c[1] for c in curve[1:]] == [str(round(r)) for r in range(1, 11)] and curve[-1][2:] == ["3", "2", "1.0"]
    assert lines(tmp_path / "d" / "picture")[0].startswith("<svg") and len(lines(tmp_path / "d" / "thresholds")) > 10


def test_arguments_go_together(files, tmp_path):
    ref = ["--reference", str(files / "ref.fa"), "--out", str(tmp_path)]
    sam = ["--reads", str(files / "x.sam")]
    for argv in (
        ["preprocess", "--read1", str(files / "x.sam"), "--length", "4", "--dual", "--out", "o"], ["preprocess", "--read1", str(files / "x.sam"), "--length", "0", "--out", "o"], ["preprocess", "--read1", "none.fastq", "--length", "4", "--out", "o"],
        ["consensus", *sam, *ref, "--mode", "bed"], ["consensus", *sam, *ref, "--share", "101"], ["consensus", *sam, *ref, "--method", "best"], ["consensus", *sam, *ref, "--only-targets"], ["run", *ref], ["run", *sam, "--sheet", str(files / "r.bed"), *ref], ["track", "--table", str(files / "r.bed"), "--mutations", str(files / "m.bed"), "--ml", "0", "--out", "o"],
    ):
        with pytest.raises(ValueError):
            cli.checked(cli.parser().parse_args(argv))
    with pytest.raises(ValueError, match="0 BAM files"):
        cli.main(["consensus", *ref])


def test_samples_of_a_folder(spark, tmp_path):
    for name in ("b_R1.fastq.gz", "b_R2.fastq.gz", "a_R1.fastq"):
        (tmp_path / name).write_bytes(b"@")
    cli.main(["samples", "--folder", str(tmp_path), "--out", str(tmp_path / "sheet")])
    rows = [x.split("\t") for x in lines(tmp_path / "sheet")]
    assert rows[0] == ["sample_name", "read1", "read2"] and [(r[0], r[1].rsplit("/", 1)[1]) for r in rows[1:]] == [("a", "a_R1.fastq"), ("b", "b_R1.fastq.gz")]
