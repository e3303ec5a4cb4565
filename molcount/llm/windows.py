"""Removal of word windows that an earlier document holds, by level-wise doubling.

A word goes if a window of ``length`` words covers it whose words also start somewhere in a document
with a smaller doc_id. Windows stay within documents; texts are judged as they came.

Levels. A window can be held by an earlier document only if its shorter runs are. So runs of the
first level's words are counted first (``length`` halved as often as leaves ``SHORTEST`` or more);
where such a run is in an earlier document too, its windows are followed at twice that run, and so on
to the full length; a level looks only at the text that the level before left. At each level but the last a window is represented by one of its
runs, the least by hash (leftmost of equals), which depends on the window's words alone: if an
earlier document has the window, it has that run. So a level counts a fraction of the runs.

Short levels compare 64-bit hashes (a collision only costs work); the last level compares 128 bits.
Counts are minima of doc_id by hash with partial sums, and the join back to the runs may be split on
hot hashes, so a window that a third of all documents share stays in no single task.

Documents whose text is equal to that of a document with a smaller doc_id are removed at once if they
have ``length`` words, and are not followed. A null doc_id is larger than all others and no smaller
than another null one. Rows that share a doc_id count as one document: none removes from the other.
Null or empty texts have no words.

Very long texts are read whole, as all their windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.llm import wordhash
from molcount.llm.common import Scratch, keyed, same_doc, tidy
from molcount.llm.substrings import _merged, spans_of

LENGTH, SHORTEST = 13, 7
LAST = (1 << 63) - 1
RUNS = "h long, o long, rid long, span long, doc_id long, th long, at long"
PIECES = "doc_id long, th long, at long, words binary"
#: Words whose runs are found together.
BLOCK = 200_000


def levels(length: int) -> list[int]:
    """Run lengths, each at most twice the one before, up to the window."""
    out = [length]
    while out[0] >= 2 * SHORTEST - 1:
        out.insert(0, -(-out[0] // 2))
    return out


def _order(doc) -> int:
    return LAST if doc is None else doc


def _words(text) -> np.ndarray:
    return wordhash.hashes(text.as_py().split())


def _texts(batches):
    """(doc_id, th, 0, word hashes)"""
    for batch in batches:
        for doc, th, text in zip(batch.column("doc_id").to_pylist(), batch.column("th").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
            yield doc, th, 0, _words(text)


def _of_pieces(batches):
    for batch in batches:
        for doc, th, at, raw in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "th", "at", "words")], strict=True):
            yield doc, th, at, np.frombuffer(raw, np.uint64)


def _blocks(rows):
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[3])
        if n >= BLOCK:
            yield held
            held, n = [], 0
    if held:
        yield held


def _runs(source, k: int, length: int):
    """Runs of k words that stand for windows: hash, order, row, first and last window (packed), and the row's key."""

    def run(batches):
        from pyspark import TaskContext

        nth = TaskContext.get().partitionId() << 40
        for held in _blocks(source(batches)):
            docs, ths, ats, words = zip(*held, strict=True)
            g, who, first, last = wordhash.anchors_of(np.concatenate(words), np.array([len(w) for w in words]), k, length)
            order = np.array([_order(d) for d in docs])[who]
            col = lambda v: pa.array(v, pa.int64()).take(pa.array(who))
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(order), pa.array(nth + who), pa.array((first << 32) | (last - first)), col(docs), col(ths), col(ats)], names=[c.split()[0] for c in RUNS.split(", ")])
            nth += len(held)

    return run


def _cut(w: np.ndarray, ranges: list, length: int):
    """(from, words) of the united windows first..last of a run of words."""
    mask = np.zeros(len(w) + 1, dtype=np.int32)
    for x in ranges:
        mask[x >> 32] += 1
        mask[(x >> 32) + (x & 0xFFFFFFFF) + length] -= 1
    return [(a, w[a:b].tobytes()) for a, b in spans_of(np.cumsum(mask[:-1]) > 0)]


def _pieces(rows) -> pa.RecordBatch:
    doc, th, at, w = zip(*rows, strict=True) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(th, pa.int64()), pa.array(at, pa.int64()), pa.array(w, pa.binary())], names=["doc_id", "th", "at", "words"])


def _flushed(rows):
    """Pieces in batches of some MB."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[3])
        if size > 8_000_000:
            yield _pieces(held)
            held, size = [], 0
    if held:
        yield _pieces(held)


def _cut_texts(length: int):
    def rows(batches):
        for batch in batches:
            for doc, th, text, ranges in zip(batch.column("doc_id").to_pylist(), batch.column("th").to_pylist(), batch.column("text").cast(pa.binary()), batch.column("ranges").to_pylist(), strict=True):
                yield from ((doc, th, a, b) for a, b in _cut(_words(text), ranges, length))

    return lambda batches: _flushed(rows(batches))


def _cut_pieces(length: int):
    def rows(batches):
        for batch in batches:
            for doc, th, at, raw, ranges in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "th", "at", "words", "ranges")], strict=True):
                yield from ((doc, th, at + a, b) for a, b in _cut(np.frombuffer(raw, np.uint64), ranges, length))

    return lambda batches: _flushed(rows(batches))


def _followed(spark, scratch, source: DataFrame, n: int, k: int, length: int, copies: DataFrame) -> DataFrame:
    """(doc_id, th, at, ranges): the windows whose runs of k more than one document has, by row of the source."""
    first = n == 0
    columns = ["doc_id", "th", "text"] if first else ["doc_id", "th", "at", "words"]
    runs = scratch.keep(_merged(source.select(*columns), _runs(_texts if first else _of_pieces, k, length), RUNS), f"runs{n}")
    several = scratch.keep(runs.groupBy("h").agg(F.min("o").alias("low"), F.max("o").alias("high")).where("low < high").select("h"), f"several{n}")
    tidy(spark)
    # runs of the first document too: later ones are held against it
    live = runs.select("h", "rid", "span").join(several, "h").groupBy("rid").agg(F.collect_set("span").alias("ranges"))
    live = live.join(runs.select("rid", "doc_id", "th", "at").distinct(), "rid")
    live = live.alias("d").join(copies.alias("c"), same_doc("d", "c"), "left_anti")
    out = scratch.keep(live.groupBy("doc_id", "th", "at").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), f"ranges{n}")
    scratch.drop(f"runs{n}")
    scratch.drop(f"several{n}")
    return out


def _pieces_of(spark, scratch, source: DataFrame, ranges: DataFrame, n: int, length: int) -> DataFrame:
    """The words of followed windows."""
    if n == 0:
        found = source.alias("d").join(ranges.alias("r"), same_doc("d", "r")).select("d.doc_id", "d.th", "d.text", "r.ranges")
        return scratch.keep(_merged(found, _cut_texts(length), PIECES), f"pieces{n}")
    found = source.alias("d").join(ranges.alias("r"), same_doc("d", "r") & (F.col("d.at") == F.col("r.at"))).select("d.doc_id", "d.th", "d.at", "d.words", "r.ranges")
    return scratch.keep(_merged(found, _cut_pieces(length), PIECES), f"pieces{n}")


def _copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    texts = keyed(docs).select("doc_id", "th", F.xxhash64(F.lit(5), "text").alias("t2"), F.coalesce("doc_id", F.lit(LAST)).alias("o"))
    one = texts.groupBy("th", "t2").agg(F.min("o").alias("low"), F.max("o").alias("high")).where("low < high")
    one = scratch.keep(one, "one")  # so that a text that a third of the rows have is no task of its own
    return scratch.keep(texts.join(one, ["th", "t2"]).where("o > low").select("doc_id", "th").distinct(), "copies")


def held(spark: SparkSession, docs: DataFrame, scratch: Scratch, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(copies, starts): (doc_id, th) of texts that an earlier document has whole, and (doc_id, th, a) of held windows elsewhere."""
    copies = _copies(docs, scratch)
    source = keyed(docs)
    for n, k in enumerate(levels(length)[:-1]):
        ranges = _followed(spark, scratch, source, n, k, length, copies)
        tidy(spark)
        source = _pieces_of(spark, scratch, source, ranges, n, length)
        tidy(spark)
        if n:
            scratch.drop(f"pieces{n - 1}")
    full = scratch.keep(_merged(source, _full_windows(length), "h0 long, h1 long, o long, doc_id long, th long, a long"), "windows")
    scratch.drop(f"pieces{len(levels(length)) - 2}")
    low = scratch.keep(full.groupBy("h0", "h1").agg(F.min("o").alias("low"), F.max("o").alias("high")).where("low < high").select("h0", "h1", "low"), "low")
    tidy(spark)
    late = full.select("h0", "h1", "doc_id", "th", "a").join(low, ["h0", "h1"]).where(F.coalesce("doc_id", F.lit(LAST)) > F.col("low"))
    return copies, late.select("doc_id", "th", "a")


def _full_windows(length: int):
    def run(batches):
        for held in _blocks(_of_pieces(batches)):
            docs, ths, ats, words = zip(*held, strict=True)
            w, sizes = np.concatenate(words), np.array([len(x) for x in words])
            n = np.maximum(sizes - length + 1, 0)
            who = np.repeat(np.arange(len(sizes)), n)
            nth = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
            s = nth + np.repeat(np.cumsum(sizes) - sizes, n)
            h0, h1 = wordhash.runs(w, length)[s], wordhash.runs(w, length, wordhash.ODD2)[s]
            col = lambda v: pa.array(v, pa.int64()).take(pa.array(who))
            order = np.array([_order(d) for d in docs])[who]
            yield pa.RecordBatch.from_arrays([pa.array(h0.view(np.int64)), pa.array(h1.view(np.int64)), pa.array(order), col(docs), col(ths), pa.array(np.array(ats)[who] + nth)], names=["h0", "h1", "o", "doc_id", "th", "a"])

    return run


def report(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """n_words, n_removed and kept_sha256 of each document."""
    if length < 8:
        raise ValueError("a window has 8 words at least")
    scratch = Scratch(spark, "windows")
    copies, starts = held(spark, docs, scratch, length)
    marks = starts.select("doc_id", "th", F.col("a").cast("int").alias("a")).unionByName(copies.select("doc_id", "th", F.lit(-1).alias("a")))
    lists = scratch.keep(marks.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("a")).alias("at")), "starts")
    tidy(spark)

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text, at in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), batch.column("at"), strict=True):
                w = text.as_py().split()
                gone = 0
                if at.is_valid:
                    a = at.values.to_numpy()
                    if a[0] < 0:
                        gone = len(w) if len(w) >= length else 0
                        w = [] if gone else w
                    else:
                        mask = np.zeros(len(w) + 1, dtype=np.int32)
                        np.add.at(mask, a, 1)
                        np.add.at(mask, a + length, -1)
                        keep = (np.cumsum(mask[:-1]) == 0).tolist()
                        total = len(w)
                        w = [x for x, k in zip(w, keep, strict=True) if k]
                        gone = total - len(w)
                rows.append((doc, len(w) + gone, gone, hashlib.sha256(b" ".join(w)).hexdigest()))
            if rows:
                doc, n, gone, sha = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    d = keyed(docs)
    return d.alias("d").join(lists.alias("s"), same_doc("d", "s"), "left").select("d.doc_id", "d.text", "s.at").mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
