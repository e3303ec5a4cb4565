"""SimHash document fingerprints, in DataFrame functions alone.

Terms are pairs of neighbouring lower-cased words (the last word also alone). Each term hashes to
128 bits; each bit votes with the term's weight, for one if it is set and against it if not, and the
sign of the sum is the bit of the fingerprint. A term weighs as many units as its words have
characters, between 2 and 15, so that short function words count little.

The votes of bits j and j + 32 of a hash word share one 64-bit sum, in lanes of 32 bits, which holds
texts of up to 280 million words. Partial sums are made before the shuffle, so one row of sums for
each document and task is what moves.

Permuted block tables find, for a stated set of documents, all fingerprints within a Hamming radius.

Null or empty texts, and texts of separators only, have no terms: their fingerprint is all zeros.
Ties of a vote give 0. Equal texts have equal fingerprints; rows that repeat are fingerprinted each.

An empty table gives none. Very long texts are read whole. Columns other than doc_id and text, whatever their
names, are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from molcount.llm.common import GAP, Scratch, id_ranges, keyed, partitions

LANES = 0x0000000100000001
BITS = 128
#: Bits in which fingerprints of one search may differ, and the tasks that share a bucket of its tables.
RADIUS, SALTS = 3, 16
#: The documents searched for: those whose doc_id this divides.
ASKED = 50


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text", out: str = "fingerprint") -> DataFrame:
    """keys and the fingerprint, 32 hexadecimal digits, of each row's text; keys must tell rows apart."""
    words = F.split(F.btrim(F.lower(F.col(text)), F.lit(" \t\n\x0b\f\r")), GAP)
    terms = F.explode_outer(F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))).alias("b")))
    term = texts.select(*keys, terms.alias("t")).select(*keys, F.col("t.a").alias("a"), F.col("t.b").alias("b"))
    weight = F.when(F.length("a") > 0, F.least(F.greatest(F.length("a") + F.coalesce(F.length("b"), F.lit(0)), F.lit(2)), F.lit(15))).otherwise(0).cast("long")
    term = term.select(*keys, weight.alias("w"), F.xxhash64("a", "b").alias("h0"), F.xxhash64("b", "a", F.lit(7)).alias("h1"))
    votes = [F.sum(F.shiftrightunsigned(f"h{i}", j).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"v{i}_{j}") for i in (0, 1) for j in range(32)]
    sums = term.groupBy(*keys).agg(F.sum("w").alias("all"), *votes)

    def half(i: int) -> Column:
        low = F.lit(0).cast("long")
        for j in range(32):
            v = F.col(f"v{i}_{j}")
            for lane, at in ((v.bitwiseAND(F.lit(0xFFFFFFFF)), j), (F.shiftrightunsigned(v, 32), j + 32)):
                low = low.bitwiseOR(F.shiftleft((lane * 2 > F.col("all")).cast("long"), at))
        return low

    halves = sums.select(*keys, half(0).alias("f0"), half(1).alias("f1"))
    return halves.select(*keys, F.lower(F.concat(*[F.lpad(F.hex(f), 16, "0") for f in ("f0", "f1")])).alias(out))


def _words(fp: Column) -> list[Column]:
    """The fingerprint as four integers of 32 bits."""
    return [F.conv(F.substring(fp, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def distance(a: Column, b: Column) -> Column:
    """Bits in which two fingerprints differ."""
    out = F.lit(0)
    for x, y in zip(_words(a), _words(b), strict=True):
        out = out + F.bit_count(x.bitwiseXOR(y))
    return out


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - distance(a, b) / F.lit(float(BITS))


def near_fingerprints(asked: DataFrame, fps: DataFrame, radius: int = RADIUS, blocks: int | None = None, salts: int = SALTS) -> DataFrame:
    """(asked, found, distance): for each different fingerprint of asked all different ones of fps within the radius.

    The bits are cut into blocks; two fingerprints within the radius agree on at least
    blocks - radius of them, so a table for each choice of so many blocks, keyed by those bits put
    first, holds each pair in one bucket at least. Equal fingerprints are made one before; other columns of fps are
    taken over, so it may hold a row for each fingerprint with what is known of its texts.
    A pair is kept in the first table where its keys agree, so it is emitted once. A bucket is dealt to
    ``salts`` tasks and those asked about, a stated set, go to each, so a bucket that holds a third of all rows is no task's own.
    """
    blocks = blocks or radius + 2
    size = 32 // blocks
    if size < 1 or not 0 <= radius < blocks:
        raise ValueError("more blocks than the radius are needed, and at most 32")
    at = [(i * 32 // blocks, (i + 1) * 32 // blocks) for i in range(blocks)]
    tables = list(combinations(range(blocks), blocks - radius))
    bits = lambda fp, t: F.concat(*[F.substring(fp, at[b][0] + 1, at[b][1] - at[b][0]) for b in t])
    keys = lambda fp: F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.xxhash64(bits(fp, t)).alias("k")) for i, t in enumerate(tables)]))
    rest = [c for c in fps.columns if c != "fingerprint"]
    salt = F.pmod(F.xxhash64(F.lit(5), "fingerprint"), F.lit(salts)).cast("int")
    found = fps.where("fingerprint is not null").dropDuplicates(["fingerprint"]).select(F.col("fingerprint").alias("found"), *rest, salt.alias("salt"), keys(F.col("fingerprint")).alias("x"))
    one = asked.select(F.col("fingerprint").alias("asked")).where("asked is not null").distinct()
    one = one.select("asked", keys(F.col("asked")).alias("x")).select("asked", "x", F.explode(F.array(*[F.lit(i) for i in range(salts)])).alias("salt"))
    # both sides are shuffled at every size: a row asked about is many rows here, and wider in memory than in a shuffle
    pair = one.select("asked", "x.*", "salt").hint("merge").join(found.select("found", *rest, "x.*", "salt"), ["t", "k", "salt"])
    first = F.coalesce(*[F.when(bits(F.col("asked"), t) == bits(F.col("found"), t), F.lit(i)) for i, t in enumerate(tables)])
    return pair.where(first == F.col("t")).select("asked", "found", distance(F.col("asked"), F.col("found")).alias("distance"), *rest).where(F.col("distance") <= radius)


def near_counts(fps: DataFrame, asked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fingerprint, rows, least: of each different fingerprint of asked the number of rows of fps (doc_id, fingerprint) within the radius, and their least doc_id."""
    each = fps.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("least"))
    near = near_fingerprints(asked, each, radius)
    return near.groupBy(F.col("asked").alias("fingerprint")).agg(F.sum("rows").alias("rows"), F.min("least").alias("least"))


def edited(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, th, text, edited, and place = (bucket, n) in the order of doc_id, where extra rows close the ranges.

    In the edited text the last floor(n / 2) code points are replaced by the first as many of the
    next document (all, if it has fewer); after the last document comes the first. Rows are dealt
    to ranges of doc_id (null: last, in ranges of text hash; ties by text hash), each range is sorted, and the
    first row of the next range stands at the end of each as a row with extra = true.
    """
    spark = docs.sparkSession
    d = keyed(docs)
    bucket, _ = id_ranges(d, ranges or 4 * partitions(spark))
    d = d.withColumn("bucket", bucket)
    order = [F.isnull("doc_id"), F.coalesce(F.col("doc_id"), F.lit(0)), F.col("th")]
    low = d.groupBy("bucket").agg(F.min(F.struct(F.isnull("doc_id").alias("z"), F.coalesce("doc_id", F.lit(0)).alias("i"), "th")).alias("m"))
    firsts = sorted((r["bucket"], r["m"]) for r in low.collect())  # a row for each range
    if firsts:
        close = spark.createDataFrame([(firsts[k - 1][0], None if m["z"] else m["i"], m["th"]) for k, (_, m) in enumerate(firsts)], "to int, doc_id long, th long")
        x = d.alias("d").join(F.broadcast(close.alias("c")), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.th") == F.col("c.th")))
        x = x.select("d.doc_id", "d.text", "d.th", F.col("to").alias("bucket"), F.lit(True).alias("extra"))
        d = d.withColumn("extra", F.lit(False)).unionByName(x)
    else:
        d = d.withColumn("extra", F.lit(False))
    w = Window.partitionBy("bucket").orderBy("extra", *order)
    d = d.withColumns({"n": F.row_number().over(w), "next": F.lead("text").over(w)})
    size = F.length("text")
    cut = F.floor(size / 2).cast("int")
    return d.select("doc_id", "th", "text", "bucket", "n", "extra", size.cast("long").alias("n_chars"), F.concat(F.left("text", size - cut), F.left(F.coalesce("next", F.lit("")), cut)).alias("edited"))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """For each document: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    Of documents whose doc_id ``ASKED`` divides also n_near, the number of other documents whose fingerprints are
    within ``RADIUS``, and near_id, the least doc_id among these and its own; null for all others.
    """
    e = edited(docs)
    keys = ["bucket", "n", "extra", "doc_id", "n_chars", "edited_sha256", "which"]
    sha = F.sha2(F.encode("edited", "utf-8"), 256)
    texts = e.withColumn("edited_sha256", sha).select("bucket", "n", "extra", "doc_id", "n_chars", "edited_sha256", F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("v"))
    texts = texts.select(*keys[:-1], "v.which", "v.text").where("not extra or which = 0")
    f = fingerprints(texts, keys)
    pair = f.groupBy(*keys[:-1]).agg(F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fingerprint"), F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited_fingerprint"))
    w = Window.partitionBy("bucket").orderBy("extra", "n")
    pair = pair.withColumn("next", F.lead("fingerprint").over(w)).where("not extra")
    report = pair.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )
    report = Scratch(docs.sparkSession, "fingerprints").keep(report, "report")
    is_asked = F.coalesce(F.col("doc_id") % ASKED == 0, F.lit(False))
    asked = report.where(is_asked)
    near = near_counts(report.select("doc_id", "fingerprint"), asked)
    asked = asked.join(near, "fingerprint", "left").select(*report.columns, (F.col("rows") - 1).alias("n_near"), F.col("least").alias("near_id"))
    none = F.lit(None).cast("long")
    return asked.unionByName(report.where(~is_asked).select("*", none.alias("n_near"), none.alias("near_id")))
