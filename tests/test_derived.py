"""The derived reads: as base by base, and in code that the virtual machine compiles."""

import re

from pyspark.sql import functions as F

from molcount.operators import consensus, grouping, indels
from molcount.plans import derived, registry, store


def lineitem(spark, folder):
    n = 2 * 3 * 5 * 7 * 40
    li = spark.range(n).selectExpr("id * 3 + 1 as l_orderkey", "id * 7 as l_partkey", "if(id % 97 = 5, null, id * 11) as l_suppkey", "cast(id % 7 + 1 as int) as l_linenumber", "cast(id % 50 as double) as l_quantity", "'R' as l_returnflag", "'F' as l_linestatus")
    li.write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_reads_are_as_base_by_base(spark, tmp_path):
    d = lineitem(spark, tmp_path)
    r = derived.reads(spark, d, ("l_orderkey", "l_linenumber", "l_suppkey"))
    p = lambda o: F.col("pos") + o
    ref = lambda o, more: derived.letter(p(o) * 7 + p(o) % 5 + more)
    base = lambda o: F.when(F.col("l_orderkey") % 23 == o, ref(o, 1 + F.col("l_linenumber"))).when((F.lit(o) == 4) & (F.col("l_suppkey") % 25 % 5 == 0), ref(o, 1)).otherwise(ref(o, 0))
    m = "(l_suppkey % 25 * 7919 + case when l_orderkey % 17 = 0 then 1 else 0 end)"
    code = F.concat(*[derived.letter(F.expr(f"{m} div {4**i}")) for i in range(8)])
    got = r.select("seq", F.concat(*[base(o) for o in range(derived.LENGTH)]).alias("want"), "barcode", code.alias("code"))
    assert got.count() > 8000 and got.where("not (seq <=> want) or not (barcode <=> code)").count() == 0


def test_indel_reads_are_as_base_by_base(spark, tmp_path):
    d = lineitem(spark, tmp_path)
    r = derived.reads(spark, d, ("l_orderkey", "l_linenumber", "l_suppkey")).drop("seq").withColumns({"kind": F.expr(derived.KIND), "cut": F.expr(derived.CUT)})
    want = r.select("ordinal", F.concat(*[F.expr(derived.base_at(o)) for o in range(derived.LENGTH)]).alias("want"))
    got = derived.indel_reads(spark, d).join(want, "ordinal")
    assert got.count() > 8000 and got.where("not (seq <=> want)").count() == 0


def test_reads_are_made_by_compiled_code(spark, tmp_path):
    """Methods of over 8,000 bytes are interpreted, at several times the time."""
    d = lineitem(spark, tmp_path)
    for r in (derived.reads(spark, d), derived.indel_reads(spark, d)):
        text = spark._jvm.PythonSQLUtils.explainString(r._jdf.queryExecution(), "codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
        assert sizes and max(sizes) < 7500


def test_blocks_by_cigar_are_those_of_each_read(spark):
    rows = [("a", 5, "ACGTAC", [30] * 6, "6M", 1), ("a", 5, "ACGTAC", [30] * 6, "2M1D4M", 2), ("a", 9, "ACGTAC", [30] * 6, "1S2M2I1M", 3), ("a", 9, "ACGTAC", [30] * 6, None, 4), ("b", 7, "ACGTAC", [30] * 6, "6M", 5)]
    r = spark.createDataFrame(rows, "k string, pos long, seq string, quals array<int>, cigar string, ordinal long")
    b = indels.with_blocks(r)
    for f in (indels.pileup, indels.events):
        got, want = (sorted(map(str, f(x, ["k"]).collect())) for x in (b, r))
        assert got == want and got


def test_reads_are_not_made_twice_for_their_islands(spark, tmp_path, monkeypatch):
    d, written = lineitem(spark, tmp_path), {}
    monkeypatch.setattr(grouping, "kept", lambda df, name: written.setdefault(name, store.kept(df, name)) and written.update({f"{name} from": df.inputFiles()}) or written[name])
    assert grouping.islands(derived.reads(spark, d)).count() > 8000
    assert not any("lineitem" in f for f in written["islands from"]) and any("lineitem" in f for f in written["positions from"])


def test_names_of_reads_are_not_written(spark, tmp_path):
    """Names are counted before; no later step reads them."""
    d = lineitem(spark, tmp_path)
    for a in (derived.assigned(spark, d), derived.assigned_indels(spark, d)):
        assert "qname" not in a.columns and a.count() > 8000 and consensus.singletons(a).count() == 0


def test_single_reads_alone_are_not_written(spark, tmp_path, monkeypatch):
    """One step reads the reads with their clusters, so there is no table of them."""
    d, written = lineitem(spark, tmp_path), []
    monkeypatch.setattr(derived, "kept", lambda df, name: written.append(name) or store.kept(df, name))
    registry.QUERIES["q_singleton_reads"](spark, d).count()
    assert written == ["clusters"]


def test_jumps_are_found_once_for_each_cigar(spark):
    rows = [("a", 5, "ACGTACGT", [30] * 8, c, i) for i, c in enumerate(("8M", "2M1D6M", "2M2I4M", "1S3M1I1D3M", "2M2I2M3D2M", "3M2N5M"))]
    b = indels.with_blocks(spark.createDataFrame(rows, "k string, pos long, seq string, quals array<int>, cigar string, ordinal long"))
    e = indels.events(b, ["ordinal"])
    assert "lambda" not in e._jdf.queryExecution().executedPlan().toString()
    got = sorted(map(tuple, e.collect()))
    assert got == [(1, 7, "D", "", 1), (2, 7, "I", "GT", 2), (3, 9, "I", "A", 1), (4, 7, "I", "GT", 2), (4, 9, "D", "", 3), (5, 8, "D", "", 2)]


def test_each_read_is_taken_apart_once_for_its_jumps(spark):
    """Without a table of CIGAR strings; those without a jump not at all."""
    cigars = ("8M", "2M1D6M", "2M2I4M", "1S3M1I1D3M", "2M2I2M3D2M", "3M2N5M", "2S4M2S", "2=1X5M", "2M1P6M", "2M0I6M", "2I6M", None, "", "3M2SI3M")
    r = spark.createDataFrame([("a", 5, "ACGTACGT", [30] * 8, c, i) for i, c in enumerate(cigars)], "k string, pos long, seq string, quals array<int>, cigar string, ordinal long")
    e = indels.events(r, ["ordinal"])
    plan = e._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
    got = sorted(map(tuple, e.collect()))
    assert got == [(1, 7, "D", "", 1), (2, 7, "I", "GT", 2), (3, 9, "I", "A", 1), (4, 7, "I", "GT", 2), (4, 9, "D", "", 3), (5, 8, "D", "", 2), (13, 8, "I", "TA", 2)]
    assert r.where(r.cigar.rlike(indels.BETWEEN)).count() == 7
