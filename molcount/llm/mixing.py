"""Mixing of sources to target weights, as a curriculum whose weights change over training.

Targets. The sources' shares of a total demand follow their weights; a source stops at a multiple of
its own size, and what it leaves is shared anew by weight among the rest until none is above.

Curriculum. Each source has a schedule: relative weights at knots of training time 0..1, linear
between them. Scaled so that its integral is the target, the schedule's integral D(t) is the demand
that the source has met by time t. The source's documents stand one after another in a hashed order,
round after round; a copy of a document that starts after x words is due at the time t with D(t) = x,
and its position is the demand of all sources together at that t. Documents are range-sorted by it.

Takes. Round e of a source of size S holds a document's words [e S + o, e S + o + size); the mix
takes what lies below the source's target, rounded to whole words. So a source's taken words equal
that number, only the last document of a source is cut, and with a stop at twice the size no document
is taken more than twice.

The order is a hash of doc_id, text and a seed; ties are rows that repeat, and their takes are split
between them by a stable rule on equal rows, so reruns agree. Null or empty texts have size 0 and
nothing is taken of them. A null source is a source of its own, last in order. An empty table gives
an empty mix.

A source may hold a third of all rows: running sums are made by hashed buckets of a source, then
within a bucket, so no task holds more than a bucket. Only one row for each source goes to the driver.

Very long texts count with all their words; a text is cut only at its source's end.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from molcount.llm.common import GAP, WORD, Scratch, keyed, once, partitions

#: Relative weights at even knots of training time; sources take turns.
RAMPS = ((1.5, 1.0, 0.5), (0.5, 1.0, 1.5))
#: Up to so many sources their schedules are broadcast (a few hundred bytes each).
BROADCAST_SOURCES = 20_000


def targets(sizes: dict, weights: dict, total: Fraction, stop: Fraction = Fraction(2)) -> dict:
    """Words to take of each source: shares of total by weight, none above stop times its size."""
    out: dict = {}
    free = {s for s in sizes if weights[s] > 0}
    while free:
        left = total - sum(out.values())
        all_w = sum(Fraction(weights[s]) for s in free)
        over = {s for s in free if left * Fraction(weights[s]) / all_w > stop * sizes[s]}
        if not over:
            out |= {s: left * Fraction(weights[s]) / all_w for s in free}
            break
        out |= {s: stop * sizes[s] for s in over}
        free -= over
    return {s: out.get(s, Fraction(0)) for s in sizes}


def in_order(sources) -> list:
    """By code point, null last."""
    return sorted((s for s in sources if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in set(sources))


def segments(goal: dict, ramps=RAMPS) -> list[tuple]:
    """(source, i, t, span, d, w, slope, p, pw, pslope): each source's demand d and weight w at the
    start of segment i, and the same of all sources together; knots are shared by all."""
    order = in_order(goal)
    knots = len(ramps[0])
    span = 1.0 / (knots - 1)
    rows, sums = [], [[0.0, 0.0, 0.0] for _ in range(knots - 1)]
    for n, s in enumerate(order):
        ramp = ramps[n % len(ramps)]
        area = sum((a + b) / 2 * span for a, b in zip(ramp, ramp[1:], strict=False))
        w = [float(goal[s]) * x / area for x in ramp]
        d = 0.0
        for i in range(knots - 1):
            slope = (w[i + 1] - w[i]) / span
            rows.append((s, i, i * span, span, d, w[i], slope))
            for k, x in enumerate((d, w[i], slope)):
                sums[i][k] += x
            d += (w[i] + w[i + 1]) / 2 * span
    return [(*r, *sums[r[1]]) for r in rows]


SEGMENT = "source string, seg int, t double, span double, d double, w double, slope double, p double, pw double, pslope double"


def sized(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id, th, source and size, the number of words."""
    d = keyed(docs, "source", *extra)
    return d.select("doc_id", "th", "source", F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"), *extra)


def plan(slim: DataFrame, weigh, share: Fraction, scratch: Scratch, seed: int = 11, ramps=RAMPS) -> DataFrame:
    """For each row of slim (doc_id, th, source, size): source_size, target, taken, and of each round
    its take and position. weigh maps the sources in order to weights; share is of all sizes."""
    spark = slim.sparkSession
    sums = {r["source"]: r["s"] for r in slim.groupBy("source").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).collect()}
    order = in_order(sums)
    goal = targets(sums, dict(zip(order, weigh(order), strict=True)), share * sum(sums.values()))
    table = spark.createDataFrame([(s, sums[s], float(goal[s]), int(goal[s] + Fraction(1, 2))) for s in order], "source string, source_size long, target double, goal long")
    hint = F.broadcast if len(order) <= BROADCAST_SOURCES else lambda x: x

    n = max(slim.count(), 1)
    buckets = max(16, min(256, 4 * partitions(spark)), math.ceil(n / 200_000))
    h = slim.withColumn("hash", F.xxhash64("doc_id", "th", F.lit(seed))).withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int"))
    by_bucket = h.groupBy("source", "bucket").agg(F.sum("size").alias("s"))
    before = by_bucket.withColumn("before", F.sum("s").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).select("source", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    # the same rows, summed within their bucket; both sides are dealt by (source, bucket)
    w = Window.partitionBy("source", "bucket").orderBy("hash", F.isnull("doc_id"), "doc_id", "th").rowsBetween(Window.unboundedPreceding, -1)
    x = h.withColumn("o", F.coalesce(F.sum("size").over(w), F.lit(0)))
    x = x.alias("x").join(before.alias("b"), F.col("x.source").eqNullSafe(F.col("b.source")) & (F.col("x.bucket") == F.col("b.bucket"))).select("x.*", (F.col("x.o") + F.col("b.before")).alias("at"))
    x = x.drop("o").alias("x").join(hint(table.alias("t")), F.col("x.source").eqNullSafe(F.col("t.source"))).select("x.doc_id", "x.th", "x.source", "x.size", "x.at", "t.source_size", "t.target", "t.goal")
    take = lambda e: F.greatest(F.lit(0), F.least(F.col("size"), F.col("goal") - F.col("at") - F.col("source_size") * e)).cast("long")
    x = x.withColumns({"take0": take(0), "take1": take(1)})
    seg = spark.createDataFrame(segments(goal, ramps), SEGMENT)
    for e in (0, 1):
        # the segment where the demand reaches x, found in the array of a source's segments
        x = _positioned(x, seg, hint, e)
    return x.withColumn("taken", F.col("take0") + F.col("take1"))


def _positioned(x: DataFrame, seg: DataFrame, hint, e: int) -> DataFrame:
    per = seg.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("seg", "t", "span", "d", "w", "slope", "p", "pw", "pslope"))).alias("segs"))
    y = x.alias("x").join(hint(per.alias("s")), F.col("x.source").eqNullSafe(F.col("s.source"))).select("x.*", "s.segs")
    start = (F.col("at") + F.col("source_size") * e).cast("double")
    y = y.withColumn("sg", F.element_at(F.filter("segs", lambda s: (s["d"] <= start) | (s["seg"] == 0)), -1))
    rest = start - F.col("sg.d")
    root = F.sqrt(F.greatest(F.col("sg.w") * F.col("sg.w") + 2 * F.col("sg.slope") * rest, F.lit(0.0)))
    tau = F.when(F.col("sg.w") + root > 0, 2 * rest / (F.col("sg.w") + root)).otherwise(F.lit(0.0))
    tau = F.least(F.greatest(tau, F.lit(0.0)), F.col("sg.span"))
    place = F.col("sg.p") + F.col("sg.pw") * tau + F.col("sg.pslope") * tau * tau / 2
    return y.withColumn(f"position{e}", F.when(F.col(f"take{e}") > 0, place)).drop("segs", "sg")


def by_position(x: DataFrame, position: str = "position0") -> DataFrame:
    """Range-sorted: partitions follow one another in training order; rows that are never taken come last."""
    keys = [F.col(position).asc_nulls_last(), F.col("doc_id").asc_nulls_last(), F.col("th")]
    return x.repartitionByRange(partitions(x.sparkSession), *keys).sortWithinPartitions(*keys)


def schedule(x: DataFrame) -> DataFrame:
    """A row for each take (doc_id, th, source, round, taken, position), in training order."""
    takes = F.explode(F.filter(F.array(*[F.struct(F.lit(e).alias("round"), F.col(f"take{e}").alias("taken"), F.col(f"position{e}").alias("position")) for e in (0, 1)]), lambda t: t["taken"] > 0))
    return by_position(x.select("doc_id", "th", "source", takes.alias("t")).select("doc_id", "th", "source", "t.*"), "position")


def turns(order: list) -> list[int]:
    """Weights 3, 1, 2, repeating."""
    return [(3, 1, 2)[k % 3] for k in range(len(order))]


def mix(spark: SparkSession, docs: DataFrame, weigh=turns, share: Fraction = Fraction(3, 2)) -> DataFrame:
    scratch = Scratch(spark, "mix")
    slim = scratch.keep(sized(docs), "sizes")
    return by_position(plan(slim, weigh, share, scratch))


def taken(spark: SparkSession, docs: DataFrame, weigh=turns, share: Fraction = Fraction(3, 2)) -> DataFrame:
    """docs as the mix takes them: a row for each take, in training order. A take of part of a text has its
    first words, joined by one space; a whole take has the text as it is."""
    scratch = Scratch(spark, "mix")
    slim = scratch.keep(sized(docs), "sizes")
    x = plan(slim, weigh, share, scratch)
    each = F.filter(F.array(*[F.struct(F.col(f"position{e}").alias("position"), F.col(f"take{e}").alias("words"), (F.col(f"take{e}") < F.col("size")).alias("part")) for e in (0, 1)]), lambda t: t["words"] > 0)
    keep = x.groupBy("doc_id", "th").agg(F.flatten(F.collect_list(each)).alias("takes"), F.count(F.lit(1)).alias("rows")).where(F.size("takes") > 0).withColumn("single", F.lit(True))
    columns = list(docs.columns)
    rows = once(docs, keep, columns, "takes").select(*columns, F.explode("takes").alias("take_"))
    words = F.slice(F.split(F.btrim("text", F.lit(" \t\n\x0b\f\r")), GAP), F.lit(1), F.col("take_.words").cast("int"))
    rows = rows.withColumn("text", F.when(F.col("take_.part"), F.array_join(words, " ")).otherwise(F.col("text")))
    keys = [F.col("take_.position"), F.col("doc_id").asc_nulls_last()]
    return rows.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).select(*columns)
