"""Pieces that the corpus operators share: keys, range buckets, scratch tables, components.

A document is a row of a table with ``doc_id`` and ``text``; other columns are ignored. Every
operator selects the columns it needs first, so extra or clashing column names do no harm. A null
text counts as the empty one. Rows are told apart by ``doc_id`` together with ``th``, a hash of the
text; ``doc_id`` may be null or repeat, and rows equal in both are copies with equal results.

A small table is broadcast by Spark through the driver's memory, whatever it grows to later. Tables that grow
with the corpus are therefore joined with the hint ``merge``; hot keys are still split.
"""

from __future__ import annotations

import atexit
import gc
import math
import tempfile
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id``, ``text`` (null: empty) and ``th``, the hash that tells texts of one id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("th"), *extra)


def same_doc(a: str, b: str) -> Column:
    """Join condition on the key of ``keyed`` between the aliases a and b."""
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))


def once(docs: DataFrame, keep: DataFrame, columns: list[str], *extra: str) -> DataFrame:
    """The columns of docs, joined to keep (doc_id, th, rows, single, extra) by the key of ``keyed``.

    ``rows`` is the number of rows of docs with the key; where it is over 1 and ``single`` holds, one
    of these equal rows is taken. Only such rows are grouped, so other texts are moved once.
    """
    d = docs.select(*[F.col(c) for c in columns]).withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))
    x = d.alias("d").join(keep.alias("k").hint("merge"), same_doc("d", "k")).select("d.*", "k.rows", "k.single", *[f"k.{c}" for c in extra])
    many = (F.col("rows") > 1) & F.col("single")
    return x.where(~many).unionByName(x.where(many).dropDuplicates(["doc_id", "th"])).select(*columns, *extra)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Scratch:
    """Tables and files of one run in the cluster's shared folder, dropped when no longer needed.

    The folder is ``spark.checkpoint.dir`` of the session. Only where that is unset, as in local
    tests, a temporary folder is made; on a cluster the setting is required.
    """

    _local: str | None = None

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not top:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            Scratch._local = Scratch._local or "file://" + tempfile.mkdtemp(prefix="molcount-")
            top = Scratch._local
        self.root = f"{top.rstrip('/')}/{what}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def keep(self, df: DataFrame, name: str, **options) -> DataFrame:
        """The rows of df, written once and read again: later jobs and lost executors don't redo them."""
        path = f"{self.root}/{name}"
        df.write.options(**{"compression": "zstd"} | options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        try:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the session has ended; a cleaner of the shared folder takes the rest
            pass


def tidy(spark: SparkSession) -> None:
    """Have Python and the JVM notice unreachable shuffles now, so that their files go before the next step writes."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.5)  # the cleaner works beside


def release() -> None:
    """Hands memory that a Python worker has freed back to the system; workers outlive their tasks."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def range_bounds(df: DataFrame, col: str, n: int) -> list:
    """At most n - 1 rising values that cut the rows into ranges of similar counts."""
    if n < 2:
        return []
    at = ",".join(f"{i / n:.9f}D" for i in range(1, n))
    got = df.select(F.expr(f"percentile_approx({col}, array({at}), {max(1000, 4 * n)})").alias("b")).first()["b"]
    return sorted(set(got or []))


def range_bucket(col: Column, bounds: list) -> Column:
    """How many of the bounds are at most col; null goes last. Two levels, so the cost is of the square root."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    lasts = F.array(*[F.lit(g[-1]) for g in groups[:-1]]) if len(groups) > 1 else F.expr("array()").cast("array<bigint>")
    nested = F.array(*[F.array(*map(F.lit, g)) for g in groups])
    coarse = F.size(F.filter(lasts, lambda b: b <= col))
    fine = F.size(F.filter(F.element_at(nested, coarse + 1), lambda b: b <= col))
    return F.when(col.isNull(), F.lit(len(bounds))).otherwise(coarse * step + fine).cast("int")


def id_ranges(docs: DataFrame, n: int) -> tuple[Column, int]:
    """The range of a row (doc_id, th) and the number of ranges, about n, of similar counts.

    Ranges rise with doc_id; a null one is last, and there ranges rise with th, so that rows without
    an id are not one range however many they are.
    """
    bounds = range_bounds(docs, "doc_id", n)
    rows = docs.agg(F.count(F.lit(1)).alias("all"), F.count("doc_id").alias("known")).first()
    spare = math.ceil(n * (rows["all"] - rows["known"]) / max(rows["all"], 1))
    rest = F.floor((F.col("th") / F.lit(2.0**64) + 0.5) * spare).cast("int")
    last = F.lit(len(bounds) + 1) + F.greatest(F.lit(0), F.least(F.lit(max(spare, 1) - 1), rest))
    return F.when(F.col("doc_id").isNull(), last).otherwise(range_bucket(F.col("doc_id"), bounds)).cast("int"), len(bounds) + 1 + spare


#: Edges that one task settles; a table of more is contracted first.
FEW = 200_000


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch, name: str, rounds: int = 60) -> DataFrame:
    """(node, comp): for each node of edges (a, b) the smallest node that it reaches.

    While there are over ``FEW`` edges they are contracted: each node goes to its least neighbour, by
    hash, and on to where that one goes, and the edges between the nodes that were gone to are the next
    table. The order by hash has no long falling chains, so tables shrink by a factor and the rounds are few
    however long the paths are. A task settles the rest, of bounded size, and labels are handed back from
    table to table. Steps are hash aggregates with partial sums and joins that adaptive execution may
    split on hot keys; each is written out, which cuts the lineage.
    """
    turned = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = scratch.keep(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-0")
    tables: list[DataFrame] = []
    while rest.count() > FEW:
        if len(tables) == rounds:
            raise RuntimeError("components did not settle")
        k = len(tables) + 1
        low = turned(rest).groupBy("a").agg(F.min_by("b", F.xxhash64("b")).alias("low"))
        up = scratch.keep(low.select(F.col("a").alias("node"), F.when(F.xxhash64("low") < F.xxhash64("a"), F.col("low")).otherwise(F.col("a")).alias("up")), f"{name}-up{k}")
        at = scratch.keep(up.select("node", "up").join(up.select(F.col("node").alias("up"), F.col("up").alias("to")).hint("merge"), "up").select("node", "to"), f"{name}-to{k}")
        scratch.drop(f"{name}-up{k}")
        tables.append(at)
        a, b = at.select(F.col("node").alias("a"), F.col("to").alias("x")), at.select(F.col("node").alias("b"), F.col("to").alias("y"))
        new = rest.join(a.hint("merge"), "a").join(b.hint("merge"), "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        rest = scratch.keep(new, f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
        tidy(spark)
    labels = scratch.keep(rest.repartition(1).mapInArrow(_settle, "node long, comp long"), f"{name}-few")
    if not tables:
        return labels
    for k in range(len(tables), 0, -1):
        found = labels.select(F.col("node").alias("to"), "comp")
        labels = scratch.keep(tables[k - 1].join(found.hint("merge"), "to", "left").select("node", F.coalesce("comp", "to").alias("comp")), f"{name}-label{k}")
        scratch.drop(f"{name}-to{k}")
    # what is least by hash names a component so far
    least = scratch.keep(labels.groupBy("comp").agg(F.min("node").alias("least")), f"{name}-least")
    return scratch.keep(labels.join(least.hint("merge"), "comp").select("node", F.col("least").alias("comp")), f"{name}-end")


def _settle(batches):
    """(node, comp) of at most ``FEW`` edges (a, b)."""
    held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    a, b = (np.concatenate([x[i] for x in held] or [np.empty(0, dtype=np.int64)]) for i in (0, 1))
    if not len(a):
        return
    node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    comp = np.arange(len(node))
    while len(a):
        # the greater of two roots goes under the lesser one, then all go up to their roots
        np.minimum.at(comp, np.maximum(comp[a], comp[b]), np.minimum(comp[a], comp[b]))
        while not np.array_equal(up := comp[comp], comp):
            comp = up
        rest = comp[a] != comp[b]
        a, b = a[rest], b[rest]
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[comp])], names=["node", "comp"])
