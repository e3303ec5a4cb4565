"""BAM: splits, intervals by the index, tags, and the sink's round trip."""

import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan

from molcount.operators import grouping
from molcount.sources import bam, reads


def written(path, rows, rng, contigs=(("chr1", 400_000), ("chr2", 90_000))):
    """A BAM file whose records straddle blocks of odd sizes; rows: (name, flag, ref, pos, cigar, seq, tags bytes)."""
    head = b"BAM\1" + struct.pack("<i", 3) + b"@CO" + struct.pack("<i", len(contigs)) + b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in contigs)
    data = head
    for name, flag, ref, pos, cigar, seq, tags in rows:
        b, _ = bam.record_of(name, flag, ref, pos, 60, cigar, seq, bytes([30 + i % 9 for i in range(len(seq))]), [])
        b = b[4:] + tags
        data += struct.pack("<i", len(b)) + b
    out = b""
    while data:
        n = rng.randrange(40, 3000)
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(data[:n]) + c.flush()
        out += struct.pack("<4sIBBH2sHH", b"\x1f\x8b\x08\x04", 0, 0, 255, 6, b"BC", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data[:n]), len(data[:n]))
        data = data[n:]
    path.write_bytes(out + bam._END)


@pytest.fixture(scope="module")
def file(tmp_path_factory):
    rng = random.Random(6)
    rows = []
    for k in range(1500):
        n = rng.choice((1, 7, 30, 151, 2000 if k % 300 == 0 else 40))
        tags = b"UGZg%d\0" % (k % 5) + b"NMC\x03" + b"XBBs" + struct.pack("<ihh", 2, -5, 6) + b"XFf" + struct.pack("<f", 0.5) + b"XAAq"
        rows.append((f"r{k}:ACGT", 4 if k % 50 == 0 else 0, *sorted([(0, rng.randrange(300_000)), (1, rng.randrange(80_000))])[k % 3 == 0], f"{n}M", "".join(rng.choice("ACGTN") for _ in range(n)), tags))
    rows.sort(key=lambda r: (r[2], r[3]))
    rows.append(("none", 4, -1, -1, "", "ACG", b""))
    path = tmp_path_factory.mktemp("bam") / "x.bam"
    written(path, rows, rng)
    return path, rows


def load(spark, path, **options):
    reads.register(spark)
    return spark.read.format("bam").options(**options).load(str(path))


@pytest.mark.parametrize("split", [1 << 30, 30_000, 3_000, 700])
def test_rows_do_not_depend_on_splits(spark, file, split):
    path, rows = file
    df = load(spark, path, splitBytes=split)
    assert df.rdd.getNumPartitions() == max(1, -(-path.stat().st_size // split))
    got = df.orderBy("ordinal").collect()
    assert [(r["qname"], r["flag"], r["contig"], r["pos"], r["seq"]) for r in got] == [(n, f, (*("chr1", "chr2"), None)[ref], pos, seq) for n, f, ref, pos, _, seq, _ in rows]
    assert got[0]["tags"] == {"UG": got[0]["tags"]["UG"], "NM": "3", "XB": "s,-5,6", "XF": "0.5", "XA": "q"} and got[-1]["tags"] == {}
    assert all(r["quals"] == [30 + i % 9 for i in range(len(r["seq"]))] for r in got) and got[0]["end"] == got[0]["pos"] + len(got[0]["seq"])
    once = load(spark, path).select("ordinal").distinct().count()
    assert once == len(rows)


def test_tag_mode_on_tags(spark, file):
    df = load(spark, file[0], splitBytes=5000).where("contig is not null").withColumns({"barcode": F.lit("ACGT"), "UG": F.col("tags")["UG"]})
    fam = grouping.families_by_tag(df, "UG")
    assert fam.count() == 10 and fam.agg(F.sum("cnt")).first()[0] == len(file[1]) - 1


def test_sink_round_trip_and_intervals(spark, file, tmp_path):
    path, rows = file
    df = load(spark, path).where("contig is not null").select(F.col("qname").alias("name"), "contig", F.col("pos").alias("start"), "cigar", "seq", F.array_join(F.transform("quals", lambda q: F.chr(q + 33)), "").alias("qual"), "flag", "tags")
    lengths = spark.createDataFrame([("chr1", 400_000), ("chr2", 90_000)], "contig string, length long")
    out = tmp_path / "out"
    bam.write_bam(df, lengths, str(out), parts=4)
    assert sorted(p.name for p in out.iterdir()) == sorted(f"part-{i:05d}.bam{e}" for i in range(4) for e in ("", ".bai"))
    back = load(spark, out, splitBytes=4000)
    cols = ["qname", "flag", "contig", "pos", "end", "cigar", "seq", "quals"]
    want = load(spark, path).where("contig is not null")
    assert sorted(map(str, back.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
    assert {tuple(sorted(r["tags"].items())) for r in back.limit(5).collect()} <= {tuple(sorted([("UG", f"g{k}"), ("NM", "3"), ("XB", "s,-5,6"), ("XF", "0.5"), ("XA", "q"), ("RG", "L1")])) for k in range(5)}
    inorder = [(r["contig"], r["pos"]) for r in back.orderBy("file", "ordinal").collect()]
    assert inorder == sorted(inorder)
    # an interval reads its blocks alone, and loses nothing
    for contig, lo, hi in (("chr1", 1000, 9000), ("chr2", 0, 70_000), ("chr1", 299_000, 400_000), ("chr2", 50, 51), ("chrX", 0, 10)):
        reader = bam.BamReader({"path": str(out)})
        filters = [EqualTo(("contig",), contig), LessThan(("pos",), hi), GreaterThan(("end",), lo)]
        assert list(reader.pushFilters(filters)) == filters
        got, blocks = [], 0
        for p in reader.partitions():
            got += [r for r in reader.records(p) if r[3] == contig and r[4] < hi and r[5] > lo]
            blocks += reader.blocks_read
        true = [r for r in rows if r[2] >= 0 and ("chr1", "chr2")[r[2]] == contig and r[3] < hi and r[3] + len(r[5]) > lo]
        assert sorted(r[1] for r in got) == sorted(r[0] for r in true)
        if hi - lo < 10_000:
            assert blocks <= 3
    near = load(spark, out).where("contig = 'chr1' and pos < 9000 and `end` > 1000")
    assert near.rdd.getNumPartitions() < load(spark, out, splitBytes=4000).rdd.getNumPartitions()
    assert near.count() == sum(r[2] == 0 and r[3] < 9000 and r[3] + len(r[5]) > 1000 for r in rows)


def test_a_failed_write_leaves_no_file(spark, tmp_path):
    rows = [(f"n{i}", "chr1", i, "3M", "ACG", "III") for i in range(50)] + [("bad", "chr9", 5, "3M", "ACG", "III")]
    df = spark.createDataFrame(rows, "name string, contig string, start long, cigar string, seq string, qual string")
    with pytest.raises(Exception, match="chr9"):
        bam.write_bam(df, spark.createDataFrame([("chr1", 100)], "contig string, length long"), str(tmp_path / "o"), parts=3)
    assert not list((tmp_path / "o").rglob("*.ba*"))
    df.where("contig = 'chr1'").coalesce(1).write.format("bam").option("contigs", '[["chr1", 100]]').mode("append").save(str(tmp_path / "o"))
    df.where("contig = 'chr1'").coalesce(1).write.format("bam").option("contigs", '[["chr1", 100]]').mode("append").save(str(tmp_path / "o"))
    assert load(spark, tmp_path / "o").count() == 100
    with pytest.raises(Exception, match="not in order"):
        df.where("contig = 'chr1'").orderBy(F.desc("start")).coalesce(1).write.format("bam").option("contigs", '[["chr1", 100]]').mode("append").save(str(tmp_path / "o"))
    assert load(spark, tmp_path / "o").count() == 100


def test_long_cigars(spark, tmp_path):
    cigar = "1M1I" * 40_000
    df = spark.createDataFrame([("long", "chr1", 7, cigar, "AC" * 40_000, None)], "name string, contig string, start long, cigar string, seq string, qual string")
    bam.write_bam(df, spark.createDataFrame([("chr1", 100_000)], "contig string, length long"), str(tmp_path / "o"), parts=1)
    r = load(spark, tmp_path / "o").first()
    assert (r["cigar"], r["end"], len(r["seq"]), r["quals"], r["tags"]) == (cigar, 40_007, 80_000, [], {"RG": "L1"})
