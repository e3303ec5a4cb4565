"""Queries by name and their oracle SQL (DuckDB), over the derived reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.functions import expr
from molcount.operators import analysis, cluster, consensus, counts, grouping, indels, intervals, stats, variants
from molcount.plans import derived
from molcount.plans.store import kept

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- the oracle's common tables ---------------------------------------------------------------
_M = "(l_suppkey % 25 * 7919 + CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END)"
_LETTER = "substr('ACGT', CAST(1 + ({}) % 4 AS INT), 1)"
_BARCODE = "concat(" + ", ".join(_LETTER.format(f"{_M} // {4**i}") for i in range(8)) + ")"


def _base(o: int) -> str:
    p = f"(pos + {o})"
    ref = f"{p} * 7 + {p} % 5"
    true = f"WHEN {o} = 4 AND (l_suppkey % 25) % 5 = 0 THEN {_LETTER.format(ref + ' + 1')} " if o == 4 else ""
    return f"CASE WHEN l_orderkey % 23 = {o} THEN {_LETTER.format(ref + ' + 1 + l_linenumber')} {true}ELSE {_LETTER.format(ref)} END"


READS = f"""src AS (SELECT l_orderkey, l_linenumber, l_suppkey, concat('r', CAST(l_orderkey AS VARCHAR)) AS qname,
  concat('chr', l_returnflag, l_linestatus) AS contig, CAST(1000 + (l_partkey % 40) * 150 + (l_linenumber % 5) AS BIGINT) AS pos,
  {_BARCODE} AS barcode, CAST(20 + CAST(trunc(l_quantity) AS INT) % 20 AS INT) AS phred FROM lineitem),
reads AS (SELECT qname, contig, pos, barcode, concat({", ".join(_base(o) for o in range(derived.LENGTH))}) AS seq,
  l_orderkey * 16 + l_linenumber AS ordinal, phred, CASE WHEN l_orderkey % 13 = 5 THEN CASE WHEN l_linenumber % 2 = 0 THEN 69 ELSE 9 END ELSE 0 END AS flag, concat('g', CAST(l_suppkey % 7 AS VARCHAR)) AS tag FROM src)"""
ISLANDS = """flagged AS (SELECT *, CASE WHEN pos > lag(pos) OVER (PARTITION BY contig ORDER BY pos) + 20 OR lag(pos) OVER (PARTITION BY contig ORDER BY pos) IS NULL THEN 1 ELSE 0 END AS new FROM (SELECT DISTINCT contig, pos FROM reads)),
isl AS (SELECT *, sum(new) OVER (PARTITION BY contig ORDER BY pos) AS island FROM flagged),
reg AS (SELECT contig, pos, min(pos) OVER (PARTITION BY contig, island) AS region_start, max(pos) OVER (PARTITION BY contig, island) + 1 AS region_end FROM isl),
placed AS (SELECT reads.*, region_start, region_end FROM reads JOIN reg USING (contig, pos))"""
FAMILIES = """fam0 AS (SELECT contig, region_start, region_end, barcode, count(DISTINCT qname) AS cnt FROM placed GROUP BY ALL),
fam AS (SELECT * FROM (SELECT *, max(cnt) OVER (PARTITION BY contig, region_start) AS most FROM fam0) WHERE most > 2)"""
CLUSTERS = """per AS (SELECT contig, region_start, list({'bc': barcode, 'cnt': cnt} ORDER BY cnt DESC, barcode) AS xs FROM fam GROUP BY ALL),
fold AS (SELECT contig, region_start, unnest(list_reduce(list_transform(xs, lambda x: [{'bc': x.bc, 'cen': x.bc, 'cnt': x.cnt}]),
  lambda acc, x: list_concat(acc, [{'bc': x[1].bc, 'cen': coalesce(list_filter(acc, lambda s: s.bc = s.cen AND hamming(s.bc, x[1].bc) <= 1)[1].bc, x[1].bc), 'cnt': x[1].cnt}]))) AS c FROM per),
clu AS (SELECT contig, region_start, c.bc AS barcode, c.cen AS centroid, c.cnt AS cnt, CAST(sum(c.cnt) OVER (PARTITION BY contig, region_start, c.cen) AS BIGINT) AS cluster_count FROM fold)"""
ASSIGNED = """asg AS (SELECT placed.*, centroid, cluster_count FROM placed JOIN clu USING (contig, region_start, barcode) WHERE flag & 4 = 0)"""
_F = "contig, region_start, centroid"
COLUMNS = f"""pile AS (SELECT {_F}, cluster_count, pos + o AS ref_pos, substr(seq, CAST(o + 1 AS INT), 1) AS base, phred FROM asg, range(0, {derived.LENGTH}) t(o) WHERE cluster_count > 1),
col0 AS (SELECT {_F}, ref_pos, count(*) AS coverage,
  {", ".join(f"round(sum(CASE WHEN base = '{b}' THEN ln(1 - pow(10.0, -phred / 10.0)) ELSE ln(pow(10.0, -phred / 10.0)) END), 9) AS l{b}, count(*) FILTER (base = '{b}') AS n{b}" for b in "ATCG")} FROM pile GROUP BY ALL),
col1 AS (SELECT *, list_max([{", ".join(f"{{'l': l{b}, 'i': {-i}, 'b': '{b}'}}" for i, b in enumerate("ATCG"))}]) AS best, list_max([{", ".join(f"{{'n': n{b}, 'i': {-i}, 'b': '{b}'}}" for i, b in enumerate("ACGT"))}]) AS top FROM col0),
col2 AS (SELECT *, {" + ".join(f"CASE WHEN best.b <> '{b}' THEN exp(l{b} - best.l) ELSE 0 END" for b in "ATCG")} AS others FROM col1),
col AS (SELECT {_F}, ref_pos, coverage, CASE WHEN coverage >= 50 THEN top.b ELSE best.b END AS base,
  CAST(CASE WHEN coverage >= 50 OR others <= 0 THEN 60 ELSE least(round_even(-10 * log10(greatest(others / (1 + others), 1e-300)), 0), 60) END AS INT) AS quality,
  CASE (CASE WHEN coverage >= 50 THEN top.b ELSE best.b END) WHEN 'A' THEN nA WHEN 'C' THEN nC WHEN 'G' THEN nG ELSE nT END AS agree,
  (CASE WHEN nA > 0 THEN 1 ELSE 0 END + CASE WHEN nC > 0 THEN 1 ELSE 0 END + CASE WHEN nG > 0 THEN 1 ELSE 0 END + CASE WHEN nT > 0 THEN 1 ELSE 0 END) AS kinds FROM col2)"""
BASES = f"""famreads AS (SELECT {_F}, count(*) AS reads, max(cluster_count) AS cluster_count FROM asg WHERE cluster_count > 1 GROUP BY ALL),
good AS (SELECT * FROM (SELECT col.*, reads, cluster_count, max(CASE WHEN kinds > 1 AND 100.0 * agree / reads < 60 THEN 1 ELSE 0 END) OVER (PARTITION BY {_F}) AS poor FROM col JOIN famreads USING ({_F}) WHERE coverage >= 2) WHERE poor = 0)"""
TABLE = f"""sing AS (SELECT {_F}, arg_min({{'pos': pos, 'seq': seq}}, ordinal) AS r FROM asg WHERE cluster_count = 1 GROUP BY ALL),
obs AS (SELECT contig, ref_pos, f AS fsize, base AS allele, sum(CASE WHEN f = 0 THEN cluster_count ELSE 1 END) AS n FROM good, (VALUES {", ".join(f"({f})" for f in expr.FAMILY_SIZES)}) s(f) WHERE f = 0 OR cluster_count >= f GROUP BY ALL
  UNION ALL SELECT contig, r.pos + o, f, substr(r.seq, CAST(o + 1 AS INT), 1), count(*) FROM sing, range(0, {derived.LENGTH}) t(o), (VALUES (0), (1)) s(f) GROUP BY ALL),
wide AS (SELECT contig, ref_pos, fsize, {", ".join(f"CAST(coalesce(sum(n) FILTER (allele = '{a}'), 0) AS BIGINT) AS {a}" for a in expr.ALLELES)} FROM obs GROUP BY contig, ref_pos, fsize),
wide1 AS (SELECT *, {_LETTER.format("ref_pos * 7 + ref_pos % 5")} AS reference, A + C + G + T + D + N AS coverage FROM wide),
wide2 AS (SELECT *, list_max([{", ".join(f"{{'n': CASE WHEN reference <> '{a}' THEN {a} ELSE -1 END, 'i': {-i}, 'a': '{a}'}}" for i, a in enumerate(expr.ALLELES))}]) AS best FROM wide1),
cons AS (SELECT 'sample' AS sample, contig, ref_pos + 1 AS position, reference, {", ".join(expr.ALLELES)}, coverage, fsize, CASE WHEN best.n > 0 AND coverage > 0 THEN best.n ELSE 0 END AS alt_count,
  CASE WHEN best.n > 0 AND coverage > 0 THEN CAST(best.n AS DOUBLE) / coverage ELSE 0.0 END AS alt_frequency, CASE WHEN best.n > 0 AND coverage > 0 THEN best.a ELSE '' END AS alt_allele FROM wide2)"""
_v = lambda x: "'" + x + "'" if isinstance(x, str) else str(x)
_values = lambda rows: ", ".join("(" + ", ".join(map(_v, r)) + ")" for r in rows)
BED = f'bed AS (SELECT contig, CAST(a AS BIGINT) AS start, CAST(b AS BIGINT) AS "end", name, ord FROM (VALUES {_values(derived.BED)}) v(contig, a, b, name, ord))'
MUTATIONS = f"mut AS (SELECT name, contig, CAST(p AS BIGINT) AS position, ref, alt, ord FROM (VALUES {_values(derived.MUTATIONS)}) v(name, contig, p, ref, alt, ord))"
FREADS = f"fr AS (SELECT DISTINCT contig, region_start AS start, region_start + {derived.LENGTH} AS \"end\", cluster_count AS size, cluster_count = 1 AS single, centroid FROM clu)"
STEPS = [READS, ISLANDS, FAMILIES, CLUSTERS, ASSIGNED, COLUMNS, BASES, TABLE]


def sql(upto: str, select: str, *more: str, steps: list[str] = STEPS) -> str:
    """The common tables up to one, more of them, and the query."""
    return "WITH " + ",\n".join([*steps[: steps.index(upto) + 1], *more]) + "\n" + select


# reads with insertions, deletions and clips
_K = "coalesce({}, 0)"
IREADS = f"""src AS (SELECT l_orderkey, l_linenumber, l_suppkey, concat('r', CAST(l_orderkey AS VARCHAR)) AS qname,
  concat('chr', l_returnflag, l_linestatus) AS contig, CAST(1000 + (l_partkey % 40) * 150 + (l_linenumber % 5) AS BIGINT) AS pos,
  {_BARCODE} AS barcode, CAST(20 + CAST(trunc(l_quantity) AS INT) % 20 AS INT) AS phred, {derived.KIND} AS kind, {derived.CUT} AS cut FROM lineitem),
reads AS (SELECT qname, contig, pos, barcode, kind, cut, concat({", ".join(derived.base_at(o) for o in range(derived.LENGTH))}) AS seq, {derived.CIGAR.format(text="VARCHAR")} AS cigar,
  l_orderkey * 16 + l_linenumber AS ordinal, phred, CASE WHEN l_orderkey % 13 = 5 THEN CASE WHEN l_linenumber % 2 = 0 THEN 69 ELSE 9 END ELSE 0 END AS flag FROM src)"""
_AT = "CASE o " + " ".join(f"WHEN {o} THEN {derived.shifted(o)}" for o in range(derived.LENGTH)) + " END"
ICOLUMNS = f"""pile AS (SELECT * FROM (SELECT {_F}, cluster_count, {_AT} AS ref_pos, substr(seq, CAST(o + 1 AS INT), 1) AS base, phred FROM asg, range(0, {derived.LENGTH}) t(o) WHERE cluster_count > 1) WHERE ref_pos IS NOT NULL),
ev AS (SELECT {_F}, pos + cut AS ref_pos, count(*) FILTER (kind = 2) AS ins, count(*) FILTER (kind = 1) AS dele FROM asg WHERE cluster_count > 1 AND kind IN (1, 2) GROUP BY ALL),
col0 AS (SELECT {_F}, ref_pos, count(*) AS coverage,
  {", ".join(f"round(sum(CASE WHEN base = '{b}' THEN ln(1 - pow(10.0, -phred / 10.0)) ELSE ln(pow(10.0, -phred / 10.0)) END), 9) AS l{b}, count(*) FILTER (base = '{b}') AS n{b}" for b in "ATCG")} FROM pile GROUP BY ALL),
col1 AS (SELECT {_F}, ref_pos, {_K.format("coverage")} AS coverage, {", ".join(f"coalesce(l{b}, 0) AS l{b}, coalesce(n{b}, 0) AS n{b}" for b in "ATCG")}, coalesce(ins, 0) AS ins, coalesce(dele, 0) AS dele FROM col0 FULL JOIN ev USING ({_F}, ref_pos)),
col2 AS (SELECT *, list_max([{", ".join(f"{{'l': l{b}, 'i': {-i}, 'b': '{b}'}}" for i, b in enumerate("ATCG"))}]) AS best, list_max([{", ".join(f"{{'n': n{b}, 'i': {-i}, 'b': '{b}'}}" for i, b in enumerate("ACGT"))}]) AS top, coverage + dele AS depth FROM col1 WHERE coverage + dele >= 2),
col3 AS (SELECT *, {" + ".join(f"CASE WHEN best.b <> '{b}' THEN exp(l{b} - best.l) ELSE 0 END" for b in "ATCG")} AS others, dele > top.n AS wins FROM col2),
col4 AS (SELECT *, CASE WHEN depth >= 50 THEN CASE WHEN NOT wins THEN top.b END ELSE best.b END AS simple, CAST(CASE WHEN depth >= 50 OR others <= 0 THEN 60 ELSE least(round_even(-10 * log10(greatest(others / (1 + others), 1e-300)), 0), 60) END AS INT) AS sq FROM col3),
col5 AS (SELECT {_F}, ref_pos, reads, cluster_count, CASE WHEN ins = 0 AND dele > 0 AND wins THEN NULL ELSE simple END AS base, sq, CASE WHEN ins > 0 AND 100.0 * ins / depth >= 60 THEN 'GT' END AS inserted, CASE WHEN ins = 0 AND wins AND 100.0 * dele / depth >= 60 THEN 2 END AS deleted,
  CASE WHEN ins = 0 AND dele > 0 THEN 100.0 * greatest(dele, top.n) / depth < 60 WHEN ins = 0 THEN (CASE WHEN nA > 0 THEN 1 ELSE 0 END + CASE WHEN nC > 0 THEN 1 ELSE 0 END + CASE WHEN nG > 0 THEN 1 ELSE 0 END + CASE WHEN nT > 0 THEN 1 ELSE 0 END) > 1 AND 100.0 * CASE simple WHEN 'A' THEN nA WHEN 'C' THEN nC WHEN 'G' THEN nG ELSE nT END / reads < 60 ELSE false END AS poor
  FROM col4 JOIN (SELECT {_F}, count(*) AS reads, max(cluster_count) AS cluster_count FROM asg WHERE cluster_count > 1 GROUP BY ALL) USING ({_F})),
col6 AS (SELECT a.* FROM col5 a WHERE NOT EXISTS (SELECT 1 FROM col5 b WHERE b.deleted = 2 AND a.contig = b.contig AND a.region_start = b.region_start AND a.centroid = b.centroid AND a.ref_pos = b.ref_pos + 1)),
good AS (SELECT {_F}, ref_pos, cluster_count, base, CASE WHEN base IS NOT NULL THEN sq END AS quality, inserted, CAST(deleted AS INT) AS deleted FROM (SELECT *, bool_or(poor) OVER (PARTITION BY {_F}) AS bad FROM col6) WHERE NOT bad AND (base IS NOT NULL OR inserted IS NOT NULL OR deleted IS NOT NULL))"""
ITABLE = TABLE.replace("arg_min({'pos': pos, 'seq': seq}, ordinal)", "arg_min({'pos': pos, 'seq': seq, 'kind': kind, 'cut': cut}, ordinal)").replace(
    "base AS allele, sum(CASE WHEN f = 0 THEN cluster_count ELSE 1 END) AS n FROM good,", "allele, sum(CASE WHEN f = 0 THEN cluster_count ELSE 1 END) AS n FROM (SELECT contig, ref_pos, cluster_count, unnest([base, CASE WHEN inserted IS NOT NULL THEN 'I' END, CASE WHEN deleted IS NOT NULL THEN 'D' END]) AS allele FROM good) g,"
).replace("WHERE f = 0 OR cluster_count >= f GROUP BY ALL", "WHERE allele IS NOT NULL AND (f = 0 OR cluster_count >= f) GROUP BY ALL")
ITABLE = ITABLE.replace(
    f"UNION ALL SELECT contig, r.pos + o, f, substr(r.seq, CAST(o + 1 AS INT), 1), count(*) FROM sing, range(0, {derived.LENGTH}) t(o), (VALUES (0), (1)) s(f) GROUP BY ALL",
    f"UNION ALL SELECT contig, ref_pos, f, allele, count(*) FROM (SELECT contig, {_AT} AS ref_pos, substr(seq, CAST(o + 1 AS INT), 1) AS allele FROM one, range(0, {derived.LENGTH}) t(o) UNION ALL SELECT contig, pos + cut, CASE kind WHEN 1 THEN 'D' ELSE 'I' END FROM one WHERE kind IN (1, 2)) s1, (VALUES (0), (1)) s(f) WHERE ref_pos IS NOT NULL GROUP BY ALL",
).replace("obs AS (", "one AS (SELECT contig, r.pos AS pos, r.seq AS seq, r.kind AS kind, r.cut AS cut FROM sing),\nobs AS (")
ISTEPS = [IREADS, ISLANDS, FAMILIES, CLUSTERS, ASSIGNED, ICOLUMNS, ITABLE]


# --- grouping -------------------------------------------------------------------------------
@query(sql(FAMILIES, "SELECT contig, region_start, region_end, count(*) AS barcodes, CAST(sum(cnt) AS BIGINT) AS fragments, max(cnt) AS most FROM fam GROUP BY ALL"))
def q_regions(spark, sf_dir):
    return grouping.region_summary(derived.families(spark, sf_dir))


_MERGED = """m0 AS (SELECT *, CASE WHEN lag("end") OVER w + 5 < start OR lag("end") OVER w IS NULL THEN 1 ELSE 0 END AS new FROM bed WINDOW w AS (PARTITION BY contig ORDER BY start, ord)),
m1 AS (SELECT *, sum(new) OVER (PARTITION BY contig ORDER BY start, ord) AS island FROM m0),
merged AS (SELECT contig, min(start) - 5 AS start, arg_max("end", start * 1000 + ord) + 5 AS "end", array_to_string(list_distinct_keep(list(name ORDER BY start, ord)), ',') AS name FROM m1 GROUP BY contig, island)""".replace(
    "list_distinct_keep(list(name ORDER BY start, ord))", "list_reduce(list_transform(list(name ORDER BY start, ord), lambda x: [x]), lambda a, b: CASE WHEN list_contains(a, b[1]) THEN a ELSE list_concat(a, b) END)"
)


_RBED = 'bed AS (SELECT DISTINCT contig, pos AS start, pos + 9 AS "end", tag AS name, CAST(substr(tag, 2) AS INT) AS ord FROM reads)'


@query(sql(READS, "SELECT * FROM merged", _RBED, _MERGED))
def q_merge_regions(spark, sf_dir):
    return intervals.merge_regions(derived.read_regions(spark, sf_dir), 5)


@query(sql(READS, "SELECT * FROM (SELECT *, max(cnt) OVER (PARTITION BY contig, region_start) AS most FROM (SELECT r.contig, m.start AS region_start, m.\"end\" AS region_end, barcode, count(DISTINCT qname) AS cnt FROM reads r JOIN merged m ON r.contig = m.contig AND r.pos < m.\"end\" AND r.pos + 10 > m.start GROUP BY ALL)) WHERE most > 2", BED, _MERGED))
def q_regions_bed(spark, sf_dir):
    merged = intervals.merge_regions(intervals.sort_regions(derived.bed(spark)), 5)
    fam = grouping.families_in_bed(derived.reads(spark, sf_dir), merged)
    most = fam.groupBy("contig", "region_start").agg(F.max("cnt").alias("most"))
    return grouping.without_singleton_regions(fam).join(most, ["contig", "region_start"])


@query(sql(READS, "SELECT contig, tag, barcode, count(DISTINCT qname) AS cnt, min(lo) AS region_start, max(hi) AS region_end FROM (SELECT *, min(pos) OVER (PARTITION BY contig, tag) AS lo, max(pos + 10) OVER (PARTITION BY contig, tag) AS hi FROM reads) GROUP BY contig, tag, barcode"))
def q_regions_tag(spark, sf_dir):
    return grouping.families_by_tag(derived.reads(spark, sf_dir))


@query(sql(READS, "SELECT contig, count(*) AS reads FROM reads GROUP BY contig"))
def q_contigs(spark, sf_dir):
    r = derived.reads(spark, sf_dir)
    return r.groupBy("contig").agg(F.count(F.lit(1)).alias("reads"))


_EDGES = """f2 AS (SELECT *, count(*) OVER (PARTITION BY contig, region_start) AS n FROM fam),
e AS (SELECT DISTINCT a.contig, a.region_start, a.barcode, a.cnt, b.barcode AS other, b.cnt AS other_cnt FROM f2 a JOIN f2 b ON a.contig = b.contig AND a.region_start = b.region_start
 WHERE (a.cnt > b.cnt OR (a.cnt = b.cnt AND a.barcode < b.barcode)) AND hamming(a.barcode, b.barcode) <= 1 AND (a.n <= 30 OR substr(a.barcode, 1, 4) = substr(b.barcode, 1, 4) OR substr(a.barcode, 5) = substr(b.barcode, 5)))"""


@query(sql(FAMILIES, "SELECT * FROM e", _EDGES))
def q_edges(spark, sf_dir):
    return cluster.edges(derived.families(spark, sf_dir), 1)


@query(sql(CLUSTERS, "SELECT * FROM clu"))
def q_clusters(spark, sf_dir):
    return derived.clustered(spark, sf_dir)


# --- consensus --------------------------------------------------------------------------------
@query(sql(COLUMNS, "SELECT * FROM col"))
def q_column_consensus(spark, sf_dir):
    a = derived.assigned(spark, sf_dir, once=True).where("cluster_count > 1")
    c = consensus.columns(consensus.pileup(a, consensus.FAMILY), consensus.FAMILY)
    return c.select(*consensus.FAMILY, "ref_pos", "coverage", "base", "quality", "agree", "kinds")


_ASM = f"""p1 AS (SELECT *, CASE WHEN ref_pos <> lag(ref_pos) OVER (PARTITION BY {_F} ORDER BY ref_pos) + 1 THEN 1 ELSE 0 END AS brk FROM good),
p2 AS (SELECT *, sum(brk) OVER (PARTITION BY {_F} ORDER BY ref_pos) AS part FROM p1),
p3 AS (SELECT {_F}, CAST(part AS INT) AS part, max(cluster_count) AS cluster_count, min(ref_pos) AS start, max(ref_pos) + 1 AS "end", string_agg(base, '' ORDER BY ref_pos) AS seq, string_agg(chr(quality + 33), '' ORDER BY ref_pos) AS qual FROM p2 GROUP BY ALL),
p4 AS (SELECT *, max(part) OVER (PARTITION BY {_F}) + 1 AS parts FROM p3)"""


@query(sql(BASES, "SELECT concat('Consensus_read_', CAST(region_start AS VARCHAR), '_', centroid, CASE WHEN parts > 1 THEN concat('_', chr(part + 97)) ELSE '' END, '_Count=', CAST(cluster_count AS VARCHAR)) AS name, contig, start, \"end\", seq, qual, cluster_count, region_start, centroid FROM p4", _ASM))
def q_position_consensus(spark, sf_dir):
    return consensus.assembled(consensus.position_consensus(derived.assigned(spark, sf_dir)))


@query(sql(ASSIGNED, f"SELECT {_F}, start, m.seq AS seq, m.n AS n, reads, cluster_count FROM (SELECT {_F}, CAST(sum(n) AS BIGINT) AS reads, min(pos) AS start, max(cluster_count) AS cluster_count, first({{'seq': seq, 'n': n}} ORDER BY n DESC, seq) AS m FROM (SELECT {_F}, seq, count(*) AS n, min(pos) AS pos, max(cluster_count) AS cluster_count FROM asg WHERE cluster_count > 1 GROUP BY {_F}, seq) GROUP BY {_F}) WHERE 100.0 * m.n / reads >= 60"))
def q_modal_consensus(spark, sf_dir):
    return consensus.modal_consensus(derived.assigned(spark, sf_dir, once=True))


@query(sql(ASSIGNED, f"SELECT {_F}, concat('{{', string_agg(concat('\"', seq, '\":', CAST(n AS VARCHAR)), ',' ORDER BY seq), '}}') AS members, count(*) AS sequences FROM (SELECT {_F}, seq, count(*) AS n FROM asg WHERE cluster_count > 1 GROUP BY {_F}, seq) GROUP BY {_F}"))
def q_member_hist(spark, sf_dir):
    return consensus.member_histogram(derived.assigned(spark, sf_dir, once=True))


@query()
def q_aligned_consensus(spark, sf_dir):
    """Reads of a family with insertions, deletions and clips, aligned to its most common one; alignments have no SQL."""
    return consensus.aligned_consensus(derived.assigned_indels(spark, sf_dir, once=True))


@query(sql(ICOLUMNS, "SELECT * FROM good", steps=ISTEPS))
def q_indel_consensus(spark, sf_dir):
    return indels.position_consensus(derived.assigned_indels(spark, sf_dir))


_IASM = f"""i1 AS (SELECT *, CASE WHEN ref_pos <> lag(ref_pos + coalesce(deleted, 1)) OVER (PARTITION BY {_F} ORDER BY ref_pos) THEN 1 ELSE 0 END AS brk FROM good),
i2 AS (SELECT *, sum(brk) OVER (PARTITION BY {_F} ORDER BY ref_pos) AS part, max(brk) OVER (PARTITION BY {_F}) AS split FROM i1),
i3 AS (SELECT {_F}, CAST(part AS INT) AS part, max(split) AS split, max(cluster_count) AS cluster_count, min(ref_pos) AS start, string_agg(concat(inserted, base), '' ORDER BY ref_pos) AS seq,
  string_agg(concat(repeat(']', coalesce(length(inserted), 0)), CASE WHEN base IS NOT NULL THEN chr(quality + 33) END), '' ORDER BY ref_pos) AS qual, max(ref_pos + coalesce(deleted, 1)) AS "end",
  string_agg(concat(repeat('I', coalesce(length(inserted), 0)), CASE WHEN base IS NOT NULL THEN 'M' END, repeat('D', coalesce(deleted, 0))), '' ORDER BY ref_pos) AS letters FROM i2 GROUP BY ALL)"""


@query(sql(ICOLUMNS, "SELECT concat('Consensus_read_', CAST(region_start AS VARCHAR), '_', centroid, CASE WHEN split > 0 THEN concat('_', chr(part + 97)) ELSE '' END, '_Count=', CAST(cluster_count AS VARCHAR)) AS name, contig, start, \"end\", seq, qual, array_to_string(list_transform(regexp_extract_all(letters, 'M+|I+|D+'), lambda x: concat(len(x), x[1])), '') AS cigar, cluster_count FROM i3 WHERE seq <> ''", _IASM, steps=ISTEPS))
def q_indel_reads(spark, sf_dir):
    return indels.assembled(indels.position_consensus(derived.assigned_indels(spark, sf_dir))).select("name", "contig", "start", "end", "seq", "qual", "cigar", "cluster_count")


@query(sql(ITABLE, "SELECT * FROM cons", steps=ISTEPS))
def q_cons_indels(spark, sf_dir):
    return derived.table_indels(spark, sf_dir)


@query(sql(ASSIGNED, "SELECT concat('Singleton_read_', CAST(region_start AS VARCHAR), '_', centroid, '_Count=1') AS name, contig, r.pos AS start, CAST(r.pos + 10 + CASE r.kind WHEN 1 THEN 2 WHEN 2 THEN -2 WHEN 3 THEN -2 ELSE 0 END AS BIGINT) AS \"end\", r.seq AS seq, r.cigar AS cigar FROM (SELECT contig, region_start, centroid, arg_min({'pos': pos, 'seq': seq, 'cigar': cigar, 'kind': kind}, ordinal) AS r FROM asg WHERE cluster_count = 1 GROUP BY ALL)", steps=ISTEPS))
def q_singleton_reads(spark, sf_dir):
    return consensus.singleton_reads(consensus.singletons(derived.assigned_indels(spark, sf_dir, once=True))).select("name", "contig", "start", "end", "seq", "cigar")


@query(sql(IREADS, f"SELECT ordinal, ref_pos, base FROM (SELECT ordinal, {_AT} AS ref_pos, substr(seq, CAST(o + 1 AS INT), 1) AS base FROM reads, range(0, {derived.LENGTH}) t(o)) WHERE ref_pos IS NOT NULL", steps=ISTEPS))
def q_cigar_pairs(spark, sf_dir):
    return indels.pileup(derived.indel_reads(spark, sf_dir), []).select("ordinal", "ref_pos", "base")


@query(sql(IREADS, "SELECT ordinal, pos + cut AS ref_pos, CASE kind WHEN 1 THEN 'D' ELSE 'I' END AS kind, CASE kind WHEN 1 THEN '' ELSE substr(seq, CAST(cut + 1 AS INT), 2) END AS text, CAST(2 AS INT) AS n FROM reads WHERE kind IN (1, 2)", steps=ISTEPS))
def q_cigar_indels(spark, sf_dir):
    return indels.events(derived.indel_reads(spark, sf_dir), ["ordinal"])


# --- the count table --------------------------------------------------------------------------
@query(sql(TABLE, "SELECT * FROM cons"))
def q_cons(spark, sf_dir):
    return derived.table(spark, sf_dir)


_ANNOTATED = 'ann AS (SELECT c.*, (SELECT coalesce(string_agg(b.name, \',\' ORDER BY b.ord), \'\') FROM bed b WHERE b.contig = c.contig AND c.position BETWEEN b.start AND b."end") AS name FROM cons c)'


def _annotated(spark, sf_dir):
    t = kept(derived.table(spark, sf_dir), "table")
    a = intervals.annotate_all(t.select("contig", "position").distinct(), derived.bed(spark), F.col("position"), ["contig", "position"])
    return t.join(a, ["contig", "position"])


@query(sql(TABLE, "SELECT * FROM ann", BED, _ANNOTATED))
def q_cons_annotated(spark, sf_dir):
    return _annotated(spark, sf_dir)


@query(sql(TABLE, "SELECT a.* EXCLUDE (name), CASE WHEN a.name = '' THEN (SELECT coalesce(string_agg(b.name, ',' ORDER BY b.ord), '') FROM bed b WHERE b.contig = a.contig AND a.position - 1 BETWEEN b.start AND b.\"end\") ELSE a.name END AS name FROM ann a WHERE fsize = 3", BED, _ANNOTATED))
def q_reannotate(spark, sf_dir):
    return intervals.reannotate(_annotated(spark, sf_dir).where("fsize = 3"), derived.bed(spark), ["contig", "position"])


@query(sql(FAMILIES, "SELECT contig, region_start AS start, region_end AS \"end\", coalesce((SELECT arg_min(b.name, b.ord) FROM bed b WHERE b.contig = f.contig AND f.region_start <= b.\"end\" AND b.start <= f.region_end), '') AS name FROM (SELECT DISTINCT contig, region_start, region_end FROM fam) f", BED))
def q_overlap(spark, sf_dir):
    spans = derived.families(spark, sf_dir).select("contig", F.col("region_start").alias("start"), F.col("region_end").alias("end")).distinct()
    return intervals.first_overlap(spans, derived.bed(spark), ["contig", "start", "end"])


@query(sql(READS, "SELECT contig, pos, coalesce((SELECT arg_min(b.name, b.ord) FROM bed b WHERE b.contig = p.contig AND p.pos BETWEEN b.start AND b.\"end\"), '') AS name FROM (SELECT DISTINCT contig, pos FROM reads) p", BED))
def q_first_annotation(spark, sf_dir):
    return intervals.first_annotation(derived.reads(spark, sf_dir).select("contig", "pos").distinct(), derived.bed(spark), F.col("pos"), ["contig", "pos"])


@query(sql(READS, "SELECT b.contig, least(b.start, coalesce(min(r.pos), b.start)) AS start, greatest(b.\"end\", coalesce(max(r.pos), b.\"end\")) AS \"end\", b.name, b.ord FROM bed b LEFT JOIN reads r ON r.contig = b.contig AND r.pos <= b.\"end\" AND r.pos + 9 >= b.start GROUP BY b.contig, b.start, b.\"end\", b.name, b.ord", BED))
def q_expand_regions(spark, sf_dir):
    return intervals.expand_regions(derived.bed(spark), derived.reads(spark, sf_dir))


@query(sql(READS, "SELECT contig, ref_pos, count(*) AS regions FROM (SELECT DISTINCT r.contig, b.start AS region_start, r.pos + o AS ref_pos FROM reads r JOIN bed b ON r.contig = b.contig AND r.pos < b.\"end\" AND r.pos + 10 > b.start, range(0, 10) t(o)) GROUP BY ALL HAVING count(*) > 1", BED))
def q_duplicate_positions(spark, sf_dir):
    placed = grouping.placed_in_bed(derived.reads(spark, sf_dir), derived.bed(spark))
    return counts.duplicate_positions(consensus.pileup(placed, grouping.REGION))


_WIDENED = """wide0 AS (SELECT m.contig, least(m.start, coalesce(min(r.pos), m.start)) AS start, greatest(m."end", coalesce(max(r.pos), m."end")) AS "end" FROM merged m LEFT JOIN reads r ON r.contig = m.contig AND r.pos <= m."end" AND r.pos + 9 >= m.start GROUP BY m.contig, m.start, m."end"),
famb AS (SELECT *, max(cnt) OVER (PARTITION BY contig, region_start) AS most FROM (SELECT r.contig, m.start AS region_start, m."end" AS region_end, barcode, count(DISTINCT qname) AS cnt FROM reads r JOIN wide0 m ON r.contig = m.contig AND r.pos < m."end" AND r.pos + 10 > m.start GROUP BY ALL))"""


@query(sql(READS, "SELECT contig, region_start, region_end, count(*) AS barcodes, CAST(sum(cnt) AS BIGINT) AS fragments, max(cnt) AS most FROM famb WHERE most > 2 GROUP BY ALL", BED, _MERGED, _WIDENED))
def q_bed_mode(spark, sf_dir):
    placed = grouping.placed(derived.reads(spark, sf_dir), "bed", derived.bed(spark), 5)
    return grouping.region_summary(grouping.without_singleton_regions(grouping.families(placed)))


@query(sql(CLUSTERS, "SELECT * FROM clu"))
def q_cluster_claims(spark, sf_dir):
    return cluster.clusters(derived.families(spark, sf_dir), fold=0)


# --- statistics -------------------------------------------------------------------------------
_THRESHOLDS = f"""rs AS (SELECT contig, start, max("end") AS "end", list(size) FILTER (NOT single) AS sizes, count(*) FILTER (single) AS singletons FROM fr GROUP BY contig, start),
named AS (SELECT rs.*, coalesce((SELECT arg_min(b.name, b.ord) FROM bed b WHERE b.contig = rs.contig AND (rs.start BETWEEN b.start AND b."end" OR rs."end" BETWEEN b.start AND b."end")), '') AS name FROM rs),
th AS (SELECT contig, start, "end", name, f, CAST(coalesce(list_sum(list_filter(sizes, lambda s: s >= f)), 0) + CASE WHEN f <= 1 THEN singletons ELSE 0 END AS BIGINT) AS reads,
  CAST(CASE WHEN f = 0 THEN coalesce(list_sum(sizes), 0) + singletons ELSE coalesce(len(list_filter(sizes, lambda s: s >= f)), 0) + CASE WHEN f <= 1 THEN singletons ELSE 0 END END AS BIGINT) AS umis FROM named, (VALUES {", ".join(f"({f})" for f in expr.FAMILY_SIZES)}) t(f))"""


def _thresholds(spark, sf_dir):
    r = stats.regions(derived.family_reads(spark, sf_dir))
    names = intervals.end_inside(r.select("contig", "start", "end"), derived.bed(spark), ["contig", "start", "end"])
    return stats.thresholds(r.join(names, ["contig", "start", "end"]))


@query(sql(CLUSTERS, "SELECT * FROM th", FREADS, BED, _THRESHOLDS))
def q_region_stats(spark, sf_dir):
    return _thresholds(spark, sf_dir)


@query(sql(CLUSTERS, "SELECT concat_ws(':', t.contig, t.start) AS region, t.name, t.f, CASE WHEN z.reads > 0 THEN CAST(t.reads AS DOUBLE) / z.reads ELSE 0.0 END AS fraction, t.reads, t.umis FROM th t JOIN th z ON t.contig = z.contig AND t.start = z.start AND z.f = 0 UNION ALL SELECT 'All', 'all_regions', f, CAST(sum(reads) AS DOUBLE) / (SELECT sum(reads) FROM th WHERE f = 0), CAST(sum(reads) AS BIGINT), CAST(sum(umis) AS BIGINT) FROM th GROUP BY f", FREADS, BED, _THRESHOLDS))
def q_overall_stats(spark, sf_dir):
    return stats.report(_thresholds(spark, sf_dir))


@query(sql(CLUSTERS, "SELECT f, CAST(coalesce(sum(umis) FILTER (name <> ''), 0) AS BIGINT) AS on_target, CAST(coalesce(sum(umis) FILTER (name = ''), 0) AS BIGINT) AS off_target, CAST(sum(umis) AS BIGINT) AS all_umis, CASE WHEN sum(umis) > 0 THEN CAST(coalesce(sum(umis) FILTER (name <> ''), 0) AS DOUBLE) / sum(umis) ELSE 0.0 END AS fraction FROM th GROUP BY f", FREADS, BED, _THRESHOLDS))
def q_target_coverage(spark, sf_dir):
    return stats.target_coverage(_thresholds(spark, sf_dir))


@query(sql(CLUSTERS, "SELECT CASE WHEN single THEN 1 ELSE size END AS size, count(*) AS n FROM fr GROUP BY 1", FREADS))
def q_family_hist(spark, sf_dir):
    return stats.family_histogram(derived.family_reads(spark, sf_dir)).select(F.col("size").cast("long").alias("size"), "n")


@query()
def q_downsample(spark, sf_dir):
    """A seeded random draw: no SQL gives the same one. Its mean has SQL, and a test holds the draw against it."""
    f = derived.family_reads(spark, sf_dir).withColumn("member", F.xxhash64("centroid"))
    return stats.downsampled(f, ["contig", "start"]).withColumn("rate", F.col("rate").cast("long"))


@query(sql(CLUSTERS, """SELECT contig, start, CAST(rate AS BIGINT) AS rate, max(k) AS reads, round(greatest(sum(1 - p0), 0), 4) AS umis, round(greatest(sum(1 - p0 - p1), 0), 4) AS families FROM prob GROUP BY contig, start, rate""", FREADS,
"""dr AS (SELECT contig, start, rate, size, n, CAST(round_even(rate * n / 10.0, 0) AS BIGINT) AS k FROM (SELECT *, sum(size) OVER (PARTITION BY contig, start) AS n FROM fr), range(1, 11) t(rate)),
prob AS (SELECT *, CASE WHEN n - k < size THEN 0 ELSE exp(lgamma(n - size + 1) - lgamma(n - size - k + 1) - lgamma(n + 1) + lgamma(n - k + 1)) END AS p0,
  CASE WHEN k < 1 OR n - k < size - 1 THEN 0 ELSE size * exp(lgamma(n - size + 1) - lgamma(k) - lgamma(n - size - k + 2) - lgamma(n + 1) + lgamma(k + 1) + lgamma(n - k + 1)) END AS p1 FROM dr)"""))
def q_downsample_expected(spark, sf_dir):
    e = stats.expected_downsampled(derived.family_reads(spark, sf_dir), ["contig", "start"])
    return e.select("contig", "start", F.col("rate").cast("long").alias("rate"), "reads", F.round("umis", 4).alias("umis"), F.round("families", 4).alias("families"))


@query()
def q_downsample_thresholds(spark, sf_dir):
    """The same draw by family-size threshold."""
    f = derived.family_reads(spark, sf_dir).withColumn("member", F.xxhash64("centroid"))
    return stats.downsampled_thresholds(f, ["contig", "start"])


# --- variants and analysis ---------------------------------------------------------------------
@query(sql(TABLE, "SELECT * FROM cons WHERE fsize = 0 AND alt_frequency > 0 AND alt_allele NOT IN ('', 'N') AND alt_count >= 3"))
def q_variants_count(spark, sf_dir):
    return variants.by_count(derived.table(spark, sf_dir), 0)


_BB = f"""cand AS (SELECT * FROM cons WHERE fsize = 1 AND alt_frequency > 0 AND alt_allele NOT IN ('', 'N')),
bb AS (SELECT contig, position, alt_allele, alt_count, coverage, -10 * log10(greatest(1 - list_sum(list_transform(range(0, alt_count), lambda k: exp(lgamma(coverage + 1) - lgamma(k + 1) - lgamma(coverage - k + 1) + lgamma(k + {variants.ALPHA}) + lgamma(coverage - k + {variants.BETA}) - lgamma(coverage + {variants.ALPHA} + {variants.BETA}) + lgamma({variants.ALPHA} + {variants.BETA}) - lgamma({variants.ALPHA}) - lgamma({variants.BETA})))), 1e-10)) AS q FROM cand)"""


@query(sql(TABLE, "SELECT contig, position, alt_allele, alt_count, coverage, CASE WHEN q > 60 THEN 60.0 ELSE round(q, 2) END AS q FROM bb WHERE q >= 0.01", _BB))
def q_variants_bb(spark, sf_dir):
    v = variants.by_background(derived.table(spark, sf_dir), 1)
    return v.select("contig", "position", "alt_allele", "alt_count", "coverage", F.when(F.col("q") > 60, 60.0).otherwise(F.round("q", 2)).alias("q"))


@query(sql(TABLE, "SELECT count(v) AS n, round(avg(v), 9) AS mean, round(var_pop(v), 9) AS variance, round(sum(ln(v)), 4) AS log_sum, round(sum(ln(1 - v)), 4) AS log1_sum FROM (SELECT alt_frequency AS v FROM cons c WHERE fsize = 1 AND alt_frequency > 0 AND alt_frequency < 1 AND alt_allele NOT IN ('', 'N') AND NOT EXISTS (SELECT 1 FROM mut m WHERE m.contig = c.contig AND m.position = c.position))", MUTATIONS))
def q_beta_stats(spark, sf_dir):
    s = variants.beta_statistics(derived.table(spark, sf_dir), derived.mutations(spark), 1)
    return s.select("n", *[F.round(c, p).alias(c) for c, p in (("mean", 9), ("variance", 9), ("log_sum", 4), ("log1_sum", 4))])


@query(sql(TABLE, "SELECT * EXCLUDE (deep) FROM (SELECT *, max(coverage) FILTER (fsize = 0) OVER (PARTITION BY sample, contig, position) AS deep FROM ann) WHERE name <> '' AND deep >= 20 AND fsize IN (2, 3)", BED, _ANNOTATED))
def q_filter_cons(spark, sf_dir):
    return analysis.filter_table(_annotated(spark, sf_dir), (2, 3), 20)


@query(sql(BASES, "SELECT name, contig, start FROM (SELECT concat('Consensus_read_', CAST(region_start AS VARCHAR), '_', centroid, CASE WHEN parts > 1 THEN concat('_', chr(part + 97)) ELSE '' END, '_Count=', CAST(cluster_count AS VARCHAR)) AS name, contig, start, cluster_count FROM p4) WHERE cluster_count >= 5", _ASM))
def q_filter_reads(spark, sf_dir):
    return analysis.filter_reads(consensus.assembled(consensus.position_consensus(derived.assigned(spark, sf_dir))), 5).select("name", "contig", "start")


_ALT = "CASE m.alt " + " ".join(f"WHEN '{a}' THEN c.{a}" for a in expr.ALLELES) + " ELSE 0 END"


@query(sql(TABLE, f"SELECT m.name, m.contig, m.position, m.ref, m.alt, coalesce(c.coverage, 0) AS coverage, coalesce({_ALT}, 0) AS alt_reads, CASE WHEN c.coverage > 0 THEN 100.0 * {_ALT} / c.coverage ELSE 0.0 END AS vaf FROM (SELECT *, row_number() OVER (PARTITION BY contig, position ORDER BY ord DESC) = 1 AS last FROM mut) m LEFT JOIN (SELECT * FROM cons WHERE fsize = 1 AND alt_allele <> '') c ON c.contig = m.contig AND c.position = m.position + 1 AND m.last", MUTATIONS))
def q_track(spark, sf_dir):
    return analysis.track(derived.table(spark, sf_dir), derived.mutations(spark), 1)


@query(sql(TABLE, "SELECT c.* FROM cons c WHERE EXISTS (SELECT 1 FROM mut m WHERE m.contig = c.contig AND m.position + 1 = c.position)", MUTATIONS))
def q_track_subset(spark, sf_dir):
    return analysis.at_mutations(derived.table(spark, sf_dir), derived.mutations(spark))


@query(sql(TABLE, f"SELECT c.sample, c.contig, c.position, m.name AS mutation, m.alt, c.coverage, m.name IS NOT NULL AS is_mutation, CASE WHEN m.alt IS NULL THEN 0 ELSE {_ALT} END AS alt_reads, (m.name IS NOT NULL AND coalesce({_ALT}, 0) > 0) AS alt_matches, CASE WHEN c.coverage > 0 AND m.alt IS NOT NULL THEN 100 * (CAST({_ALT} AS DOUBLE) / c.coverage) ELSE 0.0 END AS vaf, CASE WHEN c.coverage > 0 AND m.alt IS NOT NULL THEN 1e6 * (CAST({_ALT} AS DOUBLE) / c.coverage) ELSE 0.0 END AS ppm FROM cons c LEFT JOIN mut m ON c.contig = m.contig AND c.position = m.position WHERE fsize = 1", MUTATIONS))
def q_mutation_metrics(spark, sf_dir):
    return analysis.metrics(derived.table(spark, sf_dir), derived.mutations(spark), 1)


@query(sql(TABLE, "SELECT 'sample' AS sample, (SELECT count(*) FROM reads) AS total, CAST(coalesce(sum(coverage), 0) AS BIGINT) AS on_target, CAST(coalesce(sum(coverage), 0) AS DOUBLE) / (SELECT count(*) FROM reads) AS fraction FROM cons c WHERE fsize = 0 AND EXISTS (SELECT 1 FROM mut m WHERE m.contig = c.contig AND m.position = c.position)", MUTATIONS))
def q_on_target(spark, sf_dir):
    totals = derived.reads(spark, sf_dir).groupBy(F.lit("sample").alias("sample")).agg(F.count(F.lit(1)).alias("total"))
    return analysis.on_target(derived.table(spark, sf_dir), derived.mutations(spark), totals)


@query(sql(READS, "SELECT concat(qname, ':', substr(seq, 1, 4)) AS name, substr(seq, 1, 4) AS barcode, substr(seq, 7) AS rest, substr(seq, 7) AS seq FROM reads").replace(", substr(seq, 7) AS seq FROM reads", " FROM reads"))
def q_umi_extract(spark, sf_dir):
    from molcount.operators import preprocess

    r = derived.reads(spark, sf_dir)
    x = preprocess.extract(r.select(F.col("qname").alias("name"), "seq", F.col("seq").alias("qual")), 4, 2)
    return x.select(F.split_part("name", F.lit(" "), F.lit(1)).alias("name"), "barcode", F.col("seq").alias("rest"))


@query(sql(CLUSTERS, "SELECT concat_ws(':', contig, start) || chr(9) || concat(contig, ':', start, '-', \"end\") || chr(9) || name || chr(9) || concat('consensus_reads: ', coalesce(len(sizes), 0)) || chr(9) || concat('singletons: ', singletons) AS value FROM named", FREADS, BED, _THRESHOLDS))
def q_stats_lines(spark, sf_dir):
    r = stats.regions(derived.family_reads(spark, sf_dir))
    names = intervals.end_inside(r.select("contig", "start", "end"), derived.bed(spark), ["contig", "start", "end"])
    return stats.lines(r.join(names, ["contig", "start", "end"]))


@query(sql(CLUSTERS, "SELECT 'sample' AS sample, CAST(sum(reads) FILTER (name <> '') AS BIGINT) AS on_target FROM th WHERE f = 0", FREADS, BED, _THRESHOLDS))
def q_on_target_regions(spark, sf_dir):
    s = stats.report(_thresholds(spark, sf_dir)).withColumn("sample", F.lit("sample"))
    return analysis.on_target_of_regions(s)


@query(sql(TABLE, f"SELECT c.sample, c.contig, c.position, m.name AS mutation, {_ALT} AS alt_reads, {_ALT} / 2.5 AS mm_per_ml FROM cons c JOIN mut m ON c.contig = m.contig AND c.position = m.position WHERE fsize = 0", MUTATIONS))
def q_mutations_per_ml(spark, sf_dir):
    volumes = spark.createDataFrame([("sample", 2.5), ("other", 0.0)], "sample string, ml_plasma double")
    m = analysis.metrics(derived.table(spark, sf_dir), derived.mutations(spark), 0).where("is_mutation")
    return analysis.by_volume(m, volumes).select("sample", "contig", "position", "mutation", "alt_reads", "mm_per_ml")


@query(sql(TABLE, "SELECT concat(contig, chr(9), position, chr(9), '.', chr(9), reference, chr(9), alt_allele, chr(9), '.', chr(9), CASE WHEN alt_count < 5 THEN 'a5' ELSE 'PASS' END, chr(9), 'DP=', coverage, ';AD=', alt_count) AS value FROM cons WHERE fsize = 0 AND alt_frequency > 0 AND alt_allele NOT IN ('', 'N') AND alt_count >= 3"))
def q_vcf_lines(spark, sf_dir):
    calls = variants.by_count(derived.table(spark, sf_dir), 0).withColumn("q", F.lit(None).cast("double"))
    return variants.vcf_lines(calls).select(F.regexp_replace("value", ";AF=.*$", "").alias("value"))


@query(sql(TABLE, "SELECT CAST(b AS INT) AS bin, count(q) AS n FROM range(0, 100) g(b) LEFT JOIN (SELECT q, least(floor((q - min(q) OVER ()) / (max(q) OVER () - min(q) OVER ()) * 100), 99) AS at FROM (SELECT CASE WHEN q > 60 THEN 60.0 ELSE round(q, 2) END AS q FROM bb WHERE q >= 0.01)) x ON x.at = g.b GROUP BY 1", _BB))
def q_q_histogram(spark, sf_dir):
    return variants.q_histogram(kept(q_variants_bb(spark, sf_dir), "calls")).select("bin", "n")
