"""Numbered lines, FASTQ and FASTA over blocks of a few bytes, against plain readers."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from molcount.operators import counts, preprocess
from molcount.sources import lines, text


@pytest.fixture(params=["whole", "blocks"])
def cut(spark, request):
    """Files as they are, or in blocks of a few hundred bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "257", "spark.sql.files.openCostInBytes": "1"} if request.param == "blocks" else {}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield request.param == "blocks"
    for k, v in old.items():
        spark.conf.set(k, v)


def test_numbers(spark, tmp_path, cut):
    rng = random.Random(1)
    want = []
    for name in ("a.txt", "b.txt"):
        rows = ["x" * rng.randrange(0, 60) + str(i) for i in range(120)]
        (tmp_path / name).write_text("\n".join(rows) + "\n")
        want += [(name, i, r) for i, r in enumerate(rows)]
    df = lines.numbered(spark, str(tmp_path))
    assert not cut or df.select("file", "block").distinct().count() > 20
    assert sorted((r["file"].rsplit("/", 1)[1], r["line"], r["value"]) for r in df.collect()) == want


def record(rng, i, mate):
    n = rng.randrange(1, 70)
    return f"r{i}/{mate} y", "".join(rng.choice("ACGT") for _ in range(n)), "".join(rng.choice("@+I!5") for _ in range(n))


def test_fastq(spark, tmp_path, cut):
    rng = random.Random(2)
    want = {}
    for mate, kind in ((1, "fastq"), (2, "fastq.gz"), (3, "fastq")):
        rows = [record(rng, i, mate) for i in range(150)]
        body = "".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in rows)
        (gzip.open if kind.endswith("gz") else open)(tmp_path / f"m{mate}.{kind}", "wt").write(body + ("@cut\nAC\n" if mate == 3 else ""))
        want[mate] = [(i, f"@{n}", s, q) for i, (n, s, q) in enumerate(rows)]
        got = lines.fastq(spark, str(tmp_path / f"m{mate}.{kind}"))
        assert [(r["ordinal"], r["name"], r["seq"], r["qual"]) for r in got.orderBy("ordinal").collect()] == want[mate]
    both = preprocess.paired(lines.fastq(spark, str(tmp_path / "m1.fastq")), lines.fastq(spark, str(tmp_path / "m2.fastq.gz")))
    assert sorted((r["ordinal"], r["name1"], r["seq2"]) for r in both.collect()) == [(a[0], a[1], b[2]) for a, b in zip(want[1], want[2], strict=True)]


def test_fasta(spark, tmp_path, cut):
    rng = random.Random(3)
    seqs = {f"c{k}": "".join(rng.choice("ACGTnacgt") for _ in range(n)) for k, n in enumerate((1000, 0, 64, 65, 7, 3000))}
    (tmp_path / "r.fa").write_text("; comment\n" + "".join(f">{c} about {c}\n" + "".join(s[i : i + 37] + ("\r\n" if i % 2 else "\n") for i in range(0, len(s), 37)) for c, s in seqs.items()))
    c = lines.fasta_chunks(spark, str(tmp_path / "r.fa"), 64).collect()
    got = {}
    for r in c:
        assert r["start"] // 64 == r["chunk"] == (r["start"] + len(r["bases"]) - 1) // 64
        got.setdefault(r["contig"], {}).update({r["start"] + i: b for i, b in enumerate(r["bases"])})
    assert got == {k: dict(enumerate(s.upper())) for k, s in seqs.items() if s}
    chunks = spark.createDataFrame(c)
    assert {r["contig"]: r["length"] for r in lines.lengths(chunks).collect()} == {k: len(s) for k, s in seqs.items() if s}
    places = [("c0", 0), ("c0", 999), ("c0", 1000), ("c5", 64), ("c5", 2999), ("c2", 63), ("c9", 1), ("c0", -1)]
    x = lines.with_reference(spark.createDataFrame(places, "contig string, ref_pos long"), chunks, 64)
    assert sorted((r[0], r[1], r["reference"]) for r in x.collect()) == sorted((k, p, seqs[k][p].upper()) for k, p in places if k in seqs and 0 <= p < len(seqs[k]))
    rows = text.fasta(spark, str(tmp_path / "r.fa"))
    assert {(r[0], r[1]): r[2] for r in rows.collect()} == {(k, i): b for k, s in seqs.items() for i, b in enumerate(s.upper())}
    obs = spark.createDataFrame([("c0", 5, 1, "A", 3), ("c5", 2000, 1, "C", 2)], "contig string, ref_pos long, fsize int, allele string, n long")
    assert sorted(map(str, counts.table(obs, lines.fasta_chunks(spark, str(tmp_path / "r.fa"))).collect())) == sorted(map(str, counts.table(obs, rows).collect()))


def test_a_short_mutation_line_is_named(spark, tmp_path, cut):
    (tmp_path / "m.bed").write_text("# head\n" + "".join(f"chr1\t{i}\t{i}\tm{i}\tA\tC\n" for i in range(40)) + "\nchr1\t5\t5\tbad\tA\n")
    with pytest.raises(Exception, match=r"m\.bed, line 43: chr1"):
        text.mutations(spark, str(tmp_path / "m.bed")).collect()


def test_whole_results_are_parts_in_order(spark, tmp_path):
    calls = spark.range(0, 2000, 1, 8).select(F.concat(F.lit("chr1\t"), F.pmod(F.col("id") * 7919, F.lit(2000)).cast("string"), F.lit("\t.")).alias("value"))
    text.write_vcf(calls, str(tmp_path / "v"))
    got = [x for p in sorted((tmp_path / "v").glob("part-*")) for x in p.read_text().splitlines()]
    assert tuple(got[: len(text.VCF_HEADER)]) == text.VCF_HEADER and [int(x.split("\t")[1]) for x in got[len(text.VCF_HEADER) :]] == list(range(2000))
