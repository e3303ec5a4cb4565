"""Jaccard join on word shingles with token-combination prefixes.

A document's set holds its different runs of ``WORDS`` lower-cased words (with fewer words, the
whole sequence). Two documents link when their sets' intersection is at least ``percent`` % of the
union; the result is the connected components of the links.

1. Frequency classes. A sketch of counters over all shingles of all documents, of fixed size, sorts
   shingles into rare, frequent and very frequent ones. It orders tokens and picks their class;
   results never depend on it.
2. Prefixes. With classes first and hashes next as the order, a document's prefix is extended until
   any loss of the shingles that a link can spare leaves a tenth of the set's size in keys: a rare
   shingle is a key by itself, a frequent one only in pairs, a very frequent one only in triples,
   among the prefix's shingles in the same of some buckets of the class (the number of buckets goes
   by the set's size). Removing a shingle spoils one unit of a bucket's m - k + 1, so two linked
   documents always share that many keys, by the smaller set's count.
3. Candidates. Documents with equal sets are one class of copies. Rows of a rare shingle's key meet in one
   shuffle; those of the other keys, which may be hot, are counted first and joined back. A class that shares fewer keys with
   all others together than a link needs goes, then keys that nobody else has, and so on some times.
   A key that is left ties its classes to the key's least one: a star for each key, not all pairs.
   The connected components of these stars are blocks; linked documents are in one block.
4. Verification. A block's sets meet in a task, which counts intersections exactly by an inverted
   index. Documents of the block's largest linked group are not compared with one another again. A
   block that is too large for a task is cut into chunks by set size and hash, and every two chunks
   whose sizes allow links meet in a task of their own.

Sets are compared by 64-bit hashes of shingles. Empty and null texts have empty sets and link with
nothing. Rows that repeat are copies. component_id is null where no reachable row has a doc_id.

Very long texts are read whole: a text's size is the number of its shingles.
"""

from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from molcount.llm import wordhash
from molcount.llm.common import Scratch, components, keyed, partitions, release, same_doc, tidy
from molcount.llm.substrings import _merged

WORDS, PERCENT = 5, 80
CELLS, PARTS = 1 << 22, 64
#: Different sets that a task remembers.
SEEN = 500_000
#: Times that classes with too few shared keys are dropped.
PRUNINGS = 3
#: Shingles of sets that one chunk may hold, and documents.
CHUNK_SHINGLES, CHUNK_DOCS = 1_500_000, 1_500
MASK = np.uint64(CELLS - 1)


def shingles(text: bytes, k: int = WORDS) -> np.ndarray:
    """The hashes of a text's set in rising order, each once."""
    w = wordhash.hashes(text.lower().split())
    if not len(w):
        return np.empty(0, dtype=np.uint64)
    return np.unique(wordhash.runs(w, min(k, len(w))) if len(w) >= k else wordhash.mixed(wordhash.runs(w, len(w)) ^ np.uint64(len(w))))


def _texts(batch):
    return batch.column("text").cast(pa.binary())


def frequency_classes(docs: DataFrame, k: int = WORDS) -> np.ndarray:
    """0, 1 or 2 for each cell of the sketch (a byte each, of fixed number)."""
    spark = docs.sparkSession

    def count(batches):
        total, held, n = np.zeros(CELLS, dtype=np.int64), [], 0
        for batch in batches:
            for t in _texts(batch):
                w = wordhash.hashes(t.as_py().lower().split())
                if len(w) >= k:
                    held.append(wordhash.runs(w, k) & MASK)
                    n += len(w)
                if n > CELLS // 4:  # a few MB
                    total += np.bincount(np.concatenate(held).astype(np.int64), minlength=CELLS)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held).astype(np.int64), minlength=CELLS)
        if total.any():
            for i, x in enumerate(total.reshape(PARTS, -1)):
                yield pa.RecordBatch.from_pydict({"part": pa.array([i], pa.int32()), "cells": [zlib.compress(x.astype(np.uint32).tobytes(), 1)]})
        del total, held
        release()

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, c in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(c), np.uint32).astype(np.int64)
                sums[i] = sums[i] + x if i in sums else x
        for i, x in sums.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([i], pa.int32()), "all": [int(x.sum())], "cells": [zlib.compress(x.tobytes(), 1)]})

    scratch = Scratch(spark, "sketch")
    parts = scratch.keep(keyed(docs).select("text").mapInArrow(count, "part int, cells binary").repartition(PARTS, "part").mapInArrow(add, "part int, all long, cells binary"), "cells")
    mean = (parts.agg(F.sum("all")).first()[0] or 0) / CELLS
    often = mean + 6 * mean**0.5 + 24

    def mark(batches):
        for batch in batches:
            for i, c in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(c), np.int64)
                y = (x > often).astype(np.uint8) + (x > 16 * often)
                yield pa.RecordBatch.from_pydict({"part": pa.array([i], pa.int32()), "classes": [zlib.compress(y.tobytes(), 1)]})

    out = np.zeros((PARTS, CELLS // PARTS), dtype=np.uint8)
    for r in parts.select("part", "cells").mapInArrow(mark, "part int, classes binary").collect():  # at most PARTS rows, CELLS bytes before compression
        out[r["part"]] = np.frombuffer(zlib.decompress(r["classes"]), np.uint8)
    scratch.drop()
    return out.ravel()


def spare(n: int, percent: int = PERCENT) -> int:
    """Most shingles of a set of n that a linked set may lack."""
    return n - -(-percent * n // 100)


def extra(n: int) -> int:
    """Keys that must be left of a set of n after any loss that a link can spare."""
    return max(1, n // 10)


def least_shared(n: int, percent: int = PERCENT) -> int:
    """Keys that a set of n shares with any linked one at least."""
    return extra(-(-percent * n // 100))


def level(n: int) -> int:
    return n.bit_length() - 1


def keys(s: np.ndarray, classes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The keys of a set: even ones are rare shingles, odd ones stand for frequent shingles together."""
    n = len(s)
    need = spare(n, percent) + extra(n)
    c = classes[(s & MASK).astype(np.int64)]
    rare = s[c == 0][:need] & ~np.uint64(1)
    if len(rare) == need:
        return rare
    out = rare.tolist()
    often = [(int(k), int(x)) for k in (1, 2) for x in s[c == k].tolist()]
    for lv in {level(max(1, -(-percent * n // 100))), level(n)}:
        buckets, credit = max(1, (1 << lv) // 8), len(rare)
        together = {1: 1 + (lv >= 3), 2: 1 + (lv >= 3) + (lv >= 4)}
        held: dict[tuple, list] = {}
        for k, x in often:
            if credit >= need:
                break
            mine = held.setdefault((k, x % buckets), [])
            m = together[k]
            if len(mine) >= m - 1:
                credit += 1
                out += [xxhash.xxh3_64_intdigest(np.array([lv, m, *p, x], dtype=np.uint64).tobytes()) | 1 for p in combinations(mine, m - 1)]
            mine.append(x)
    return np.array(out, dtype=np.uint64)


class Groups:
    """Union-find over 0..n-1 with group sizes."""

    def __init__(self, n: int):
        self.up, self.size = list(range(n)), [1] * n
        self.top = 0  # a root of a largest group

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            if self.size[i] < self.size[j]:
                i, j = j, i
            self.up[j] = i
            self.size[i] += self.size[j]
            if self.size[i] >= self.size[self.root(self.top)]:
                self.top = i


def linked(sets: list[np.ndarray], percent: int = PERCENT) -> list[int]:
    """For each set a member of its connected group under links, the same for all of the group."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    tokens = np.unique(np.concatenate(sets), return_inverse=True)[1] if n else np.empty(0, dtype=np.int64)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(tokens, kind="stable")
    posting, counts = owner[order], np.bincount(tokens)
    first = np.concatenate([[0], np.cumsum(counts)])
    begin = np.concatenate([[0], np.cumsum(sizes)])
    central = np.add.reduceat(counts[tokens], begin[:-1]) if n else []
    g = Groups(n)

    def compare(i: int) -> None:
        t = tokens[begin[i] : begin[i + 1]]
        t = t[counts[t] > 1]
        if not len(t):
            return
        lens = counts[t]
        at = np.repeat(first[t] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
        both = np.bincount(posting[at], minlength=n)
        union = sizes + sizes[i] - both
        for j in np.flatnonzero(100 * both >= percent * union).tolist():
            g.join(i, j)

    # the most central ones first: they gather most of a group of near copies; who is in the largest
    # group need not be compared, as others are compared with it, so the turns end when all the rest has been
    turn = np.argsort(-np.asarray(central), kind="stable").tolist()
    while turn:
        spared = []
        for i in turn:
            if g.size[g.root(i)] > 1 and g.root(i) == g.root(g.top):
                spared.append(i)
            else:
                compare(i)
        turn = [i for i in spared if g.root(i) != g.root(g.top)]
    return [g.root(i) for i in range(n)]


def join(spark: SparkSession, docs: DataFrame, scratch: Scratch, percent: int = PERCENT, k: int = WORDS) -> DataFrame:
    """For each row: doc_id, th, n_shingles, component_id and kept (one row of each component)."""
    d = keyed(docs)
    classes = spark.sparkContext.broadcast(frequency_classes(docs, k))  # CELLS bytes

    def index(batches):
        from pyspark import TaskContext

        nth, often, seen = TaskContext.get().partitionId() << 40, classes.value, set()
        for batch in batches:
            n, a, b, key = [], [], [], []
            for t in _texts(batch):
                s = shingles(t.as_py(), k)
                h = xxhash.xxh3_128_digest(s.tobytes())
                n.append(len(s))
                a.append(int.from_bytes(h[:8], "little", signed=True))
                b.append(int.from_bytes(h[8:], "little", signed=True))
                # one of a task's copies of a set gives its keys, so copies don't weigh on the joins
                new = len(s) and h not in seen
                if new and len(seen) < SEEN:
                    seen.add(h)
                key.append(keys(s, often, percent).view(np.int64) if new else np.empty(0, dtype=np.int64))
            if n:
                rid = np.arange(nth, nth + len(n))
                nth += len(n)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in key])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(rid), batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(a), pa.array(b), pa.ListArray.from_arrays(offsets, np.concatenate(key))], names=["rid", "doc_id", "th", "n", "ck", "ck2", "keys"])
        seen.clear()
        release()

    rows = scratch.keep(d.select("doc_id", "th", "text").mapInArrow(index, "rid long, doc_id long, th long, n long, ck long, ck2 long, keys array<long>"), "index")
    classes.destroy()  # rows are written, so nothing asks for it again
    first = F.min(F.struct(F.isnull("doc_id").alias("z"), "doc_id", "rid")).alias("first")
    copies = scratch.keep(rows.where("n > 0").groupBy("ck", "ck2").agg(F.min("rid").alias("nid"), F.max("n").alias("n"), F.count_if(F.size("keys") > 0).alias("m"), first), "copies")
    # a set's hash may stand for two sets, at worst; then the lesser need holds
    need = copies.groupBy("ck").agg(F.sum("m").alias("m"), F.min(F.greatest(F.floor(F.ceil(F.col("n") * percent / 100.0 - 1e-9) / 10), F.lit(1))).alias("need"))
    live = rows.select(F.explode("keys").alias("key"), "ck")
    for turn in range(PRUNINGS):
        both = _shared(live, scratch, f"shared{turn}").select("key", "ck")
        # counted where they lie by class, so the rows are moved once and not joined to their own counts
        both = both.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("ck"))).join(need.hint("merge"), "ck")
        live = scratch.keep(both.where("n >= need * m").select("key", "ck"), f"live{turn}")
        if turn:
            scratch.drop(f"live{turn - 1}")
        tidy(spark)
    stars = scratch.keep(_shared(live, scratch, "shared").where("ck <> a").select("a", F.col("ck").alias("b")).distinct(), "stars")
    blocks = components(spark, stars, scratch, "blocks")
    tidy(spark)
    verified = _verify(spark, d, rows, copies, blocks, scratch, percent, k)
    groups = components(spark, verified, scratch, "groups")
    c = copies.alias("c").join(groups.alias("g").hint("merge"), F.col("c.nid") == F.col("g.node"), "left").select("c.ck", "c.ck2", "c.first", F.coalesce("g.comp", "c.nid").alias("comp"))
    c = scratch.keep(c, "labels")
    least = scratch.keep(c.groupBy("comp").agg(F.min("first").alias("least")), "least")
    c = scratch.keep(c.join(least.hint("merge"), "comp").select("ck", "ck2", F.col("least.doc_id").alias("component_id"), F.col("least.rid").alias("least_rid")), "classes")
    out = rows.select("rid", "doc_id", "th", "n", "ck", "ck2").join(c.hint("merge"), ["ck", "ck2"], "left")
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), (F.col("rid") == F.coalesce("least_rid", "rid")).alias("kept"), "rid")


def _shared(live: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(key, ck, a): the rows of live (key, ck) whose key several classes have, with the key's least class.

    A rare shingle's key has no more rows than its class of frequency allows, so its rows meet in one shuffle.
    The other keys may be as hot as the corpus has it: they are counted with partial sums and joined back.
    """
    odd = F.col("key").bitwiseAND(F.lit(1)) == 1
    w = Window.partitionBy("key")
    rare = live.where(~odd).withColumns({"a": F.min("ck").over(w), "z": F.max("ck").over(w)}).where("a < z").select("key", "ck", "a")
    # what is joined back to its own rows is written first: between plain exchanges a hot key can be split
    often = live.where(odd)
    known = scratch.keep(often.groupBy("key").agg(F.min("ck").alias("a"), F.max("ck").alias("z")).where("a < z").select("key", "a"), name)
    return rare.unionByName(often.join(known.hint("merge"), "key").select("key", "ck", "a"))


def _verify(spark, d, rows, copies, blocks, scratch, percent, k) -> DataFrame:
    """(a, b): links between classes of copies that keep their groups connected."""
    c = copies.join(blocks.withColumnRenamed("node", "ck").withColumnRenamed("comp", "block").hint("merge"), "ck").select("block", "nid", "n")
    # sizes within a factor of 100 / percent are in the same or neighbouring bins
    c = c.withColumn("bin", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int"))
    per_bin = c.groupBy("block", "bin").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("all"))
    whole = per_bin.groupBy("block").agg(F.sum("docs").alias("docs"), F.sum("all").alias("all")).where((F.col("docs") <= CHUNK_DOCS) & (F.col("all") <= CHUNK_SHINGLES)).select("block", F.lit(True).alias("small"))
    whole = scratch.keep(whole, "whole")
    w = Window.partitionBy("block").orderBy("bin")
    chunks = F.ceil(F.greatest(F.col("docs") / CHUNK_DOCS, F.col("all") / CHUNK_SHINGLES)).cast("int")
    bins = per_bin.withColumn("c", chunks).withColumns({"down": F.when(F.lag("bin").over(w) == F.col("bin") - 1, F.lag("c").over(w)).otherwise(0), "up": F.when(F.lead("bin").over(w) == F.col("bin") + 1, F.lead("c").over(w)).otherwise(0)}).select("block", "bin", "c", "down", "up")
    bins = scratch.keep(bins, "bins")
    c = scratch.keep(c.join(whole.hint("merge"), "block", "left").join(bins.hint("merge"), ["block", "bin"]), "cut")
    mine = F.pmod(F.xxhash64("nid"), F.col("c")).cast("int")
    name = lambda b0, c0, b1, c1: F.struct(b0.alias("b0"), c0.alias("c0"), b1.alias("b1"), c1.alias("c1"))
    other = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), f)).otherwise(F.array().cast("array<struct<b0:int,c0:int,b1:int,c1:int>>"))
    b = F.col("bin")
    tasks = F.when(F.col("small"), F.array(name(F.lit(-1), F.lit(0), F.lit(-1), F.lit(0)))).otherwise(
        F.concat(other(F.col("c"), lambda j: name(b, F.least(mine, j), b, F.greatest(mine, j))), other(F.col("down"), lambda j: name(b - 1, j, b, mine)), other(F.col("up"), lambda j: name(b, mine, b + 1, j)))
    )
    c = c.select("block", "nid", "n", tasks.alias("tasks"))
    picked = rows.select(F.col("rid").alias("nid"), "doc_id", "th").join(c.hint("merge"), "nid")
    # rows that repeat have one text; the task drops the second
    texts = d.alias("d").join(picked.alias("p").hint("merge"), same_doc("d", "p")).select("d.text", "p.block", "p.nid", "p.tasks")

    def sets(batches):
        for batch in batches:
            s = [shingles(t.as_py(), k).tobytes() for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("nid"), batch.column("tasks"), pa.array(s, pa.binary())], names=["block", "nid", "tasks", "hashes"])
        release()

    kind = "array<struct<b0:int,c0:int,b1:int,c1:int>>"
    x = texts.select("block", "nid", "tasks", "text").mapInArrow(sets, f"block long, nid long, tasks {kind}, hashes binary")
    x = x.select("block", "nid", F.explode("tasks").alias("t"), "hashes").select("block", "nid", "t.*", "hashes")
    order = ["block", "b0", "c0", "b1", "c1"]

    def compare(batches):
        last, ids, held = None, [], []

        def done():
            root = linked(held, percent)
            return [(ids[r], ids[i]) for i, r in enumerate(root) if r != i]

        for batch in batches:
            out = []
            for *key, nid, h in zip(*[batch.column(c).to_pylist() for c in [*order, "nid", "hashes"]], strict=True):
                if key != last:
                    if len(ids) > 1:
                        out += done()
                    last, ids, held = key, [], []
                if ids and ids[-1] == nid:
                    continue
                ids.append(nid)
                held.append(np.frombuffer(h, np.uint64))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out, strict=True)], names=["a", "b"])
        if len(ids) > 1 and (out := done()):
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out, strict=True)], names=["a", "b"])

    x = x.repartition(partitions(spark), *order).sortWithinPartitions(*order, "nid").select(*order, "nid", "hashes")
    return scratch.keep(_merged(x, compare, "a long, b long"), "verified")


def report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return join(spark, docs, Scratch(spark, "jaccard")).select("doc_id", "n_shingles", "component_id")
