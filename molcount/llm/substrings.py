"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte goes if it is covered by a string of ``length`` bytes that also starts anywhere else, in the
same document or another. Matches stay within documents; texts are judged as they came.

1. Buckets. Each string of ``length`` bytes has an anchor: the least of its runs of ``GRAM`` bytes by
   a rolling hash, the leftmost of equals. Equal strings have equal anchors at equal places, so a
   bucket of suffixes is the set of strings with one anchor hash. Strings of one document with one
   anchor are neighbours; their union, at most 2 length - GRAM bytes, is the anchor's context.
2. Only anchor hashes that occur twice are followed. Contexts that are equal as a whole (by digest)
   settle all their strings without moving bytes; one of each goes on to be compared.
3. Suffix sorting. A task takes whole buckets, block by block. Sampled suffixes (places whose
   remainder by 7 is in the difference cover {0, 1, 3}) are ranked by prefix doubling up to
   length - 8 bytes. Any two suffixes have a shift below 7 at which both meet the sample, so two
   strings are equal if the rank there and the up to 8 bytes around it are: sorting by both names the
   strings. Memory is bounded by a block (``BLOCK`` bytes), whatever the size of the corpus.
4. A bucket of over ``WIDE`` different contexts would not be bounded; its strings are counted by
   128-bit digest instead, with partial sums, so that no task holds the bucket. Neighbouring strings
   are first taken in blocks of ``STEP``: if their union is found again all of them are, and if what
   they have in common is not found again none is; only other blocks are taken string by string.
5. Covered spans are merged by document and cut out.

Aggregates that are joined back to their own rows are written first. Between two plain exchanges
adaptive execution splits a key that holds a third of the rows.

Null or empty texts, and texts shorter than ``length``, keep all. Rows that repeat are copies of each
other. Very long texts are hashed in slices. Contexts and wide buckets rest on 64 bits of digest
beside the 44 bits of the anchor and on 128 bits; all other comparisons are of bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.llm import wordhash
from molcount.llm.common import Scratch, keyed, partitions, release, same_doc, tidy

LENGTH, GRAM = 400, 256
#: Bytes of a passage of over 50 words: 99 of 100 such passages are longer.
PASSAGE, PASSAGE_GRAM = 204, 80
BLOCK, WIDE, STEP = 3_000_000, 400, 8
SLICE = 1 << 19
COVER, PERIOD = (0, 1, 3), 7

_state: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value for each byte, and powers of an odd base and of its inverse."""
    if _state.get("n", 0) < n:
        base = 0x9E3779B97F4A7C15 | 1
        inverse = pow(base, -1, 1 << 64)
        up, down = np.full(n, base, dtype=np.uint64), np.full(n, inverse, dtype=np.uint64)
        up[0] = down[0] = 1
        _state.update(n=n, up=np.cumprod(up, dtype=np.uint64), down=np.cumprod(down, dtype=np.uint64))
        _state["bytes"] = wordhash.mixed(np.arange(1, 257, dtype=np.uint64) * wordhash.ODD)
    return _state["bytes"], _state["up"], _state["down"]


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k bytes."""
    n = len(b) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    value, up, down = _powers(len(b) if len(b) > SLICE + 2 * LENGTH else SLICE + 2 * LENGTH)
    sums = np.empty(len(b) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(value[b] * up[: len(b)], out=sums[1:])
    return wordhash.mixed((sums[k:] - sums[:-k]) * down[:n])


def byte_anchors(text: bytes, length: int, gram: int):
    """(hash, place, first, last) of the anchors of all strings of ``length`` bytes of a text."""
    b = np.frombuffer(text, np.uint8)
    for lo in range(0, max(len(b) - length + 1, 0), SLICE):
        g = gram_hashes(b[lo : lo + SLICE + length - 1], gram)
        place, first, last = wordhash.anchors(g, length - gram + 1)
        yield g[place] >> wordhash.PLACE_BITS, place + lo, first + lo, last + lo


def repeated(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at starts share their first ``length`` bytes with another, by difference-cover ranks.

    length must be a multiple of 7 plus 8 (400 is); each start has ``length`` bytes after it.
    """
    deep = length - 8
    if len(starts) < 2:
        return np.zeros(len(starts), dtype=bool)
    rows = -(-len(text) // PERIOD) + 2
    t = np.zeros(rows * PERIOD + length + 16, dtype=np.uint64)
    t[: len(text)] = text
    # ranks of the sample at 7 bytes, then by pairs of ranks at 14, 28 ... up to deep bytes
    cols = []
    for d in COVER:
        x = np.zeros(rows, dtype=np.uint64)
        for i in range(PERIOD):
            x = (x << np.uint64(8)) | t[d + i : d + i + rows * PERIOD : PERIOD][:rows]
        cols.append(x)
    rank = np.unique(np.stack(cols, axis=1).ravel(), return_inverse=True)[1].reshape(rows, len(COVER)).astype(np.int64)
    size = PERIOD
    while size < deep:
        step = min(size, deep - size) // PERIOD
        later = np.zeros_like(rank)
        later[: rows - step] = rank[step:]
        rank = np.unique((rank * (int(rank.max()) + 1) + later).ravel(), return_inverse=True)[1].reshape(rows, len(COVER))
        size += step * PERIOD
    column = np.full(PERIOD, -1)
    column[list(COVER)] = range(len(COVER))
    out = np.zeros(len(starts), dtype=bool)
    for shift in range(PERIOD):
        at = starts + shift
        mine = np.flatnonzero(column[at % PERIOD] >= 0)
        if len(mine) < 2:
            continue
        s, p = starts[mine], at[mine]
        name = rank[p // PERIOD, column[p % PERIOD]]
        around = np.zeros(len(mine), dtype=np.uint64)
        for i in [*range(shift), *range(shift + deep, length)]:
            around = (around << np.uint64(8)) | t[s + i]
        order = np.lexsort((around, name))
        same = (name[order[1:]] == name[order[:-1]]) & (around[order[1:]] == around[order[:-1]])
        twin = np.zeros(len(mine), dtype=bool)
        twin[order[1:]] |= same
        twin[order[:-1]] |= same
        out[mine] |= twin
    return out


def spans_of(mask: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true, as (from, to)."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


SPANS = "doc_id long, th long, a long, b long"


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ([], [], [], []))], names=["doc_id", "th", "a", "b"])


def covered(spark: SparkSession, docs: DataFrame, scratch: Scratch, length: int = LENGTH, gram: int = GRAM, wide: int = WIDE) -> DataFrame:
    """(doc_id, th, a, b): spans of bytes that repeated strings cover; they may overlap."""
    return _covered(spark, keyed(docs), scratch, length, gram, wide)


def _covered(spark: SparkSession, d: DataFrame, scratch: Scratch, length: int, gram: int, wide: int) -> DataFrame:
    """``covered`` of rows (doc_id, th, text); rows equal in the first two are copies."""
    if length % PERIOD != 1 or not 1 < gram < length:
        raise ValueError("length must leave 1 when divided by 7, and exceed the anchor's run")

    def find(batches):
        from pyspark import TaskContext

        nth = TaskContext.get().partitionId() << 40
        for batch in batches:
            cols = batch.column("text").cast(pa.binary())
            for doc, th, text in zip(batch.column("doc_id").to_pylist(), batch.column("th").to_pylist(), cols, strict=True):
                raw = text.as_buffer()
                if raw.size < length:
                    continue
                view = memoryview(raw)
                for h, place, first, last in byte_anchors(view, length, gram):
                    n = len(h)
                    digest = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.array(digest, dtype=np.uint64).view(np.int64)), pa.array([doc] * n, pa.int64()), pa.array(np.full(n, th)), pa.array(np.arange(nth, nth + n)), pa.array(first), pa.array(last), pa.array((place - first).astype(np.int32))], names=["h", "c", "doc_id", "th", "nth", "first", "last", "lead"])
                    nth += n

    found = scratch.keep(_merged(d.select("doc_id", "th", "text"), find, "h long, c long, doc_id long, th long, nth long, first long, last long, lead int"), "anchors")
    shared = found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("n > 1").select("h", (F.col("c0") != F.col("c1")).alias("several"))
    occ = scratch.keep(found.join(scratch.keep(shared, "hashes"), "h"), "shared")
    scratch.drop("anchors")
    by_context = occ.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("one"), F.first("several").alias("several"))
    by_context = scratch.keep(by_context.where("n > 1 or several"), "by_context")
    alike = by_context.where("n > 1").select("h", "c")
    whole = occ.join(alike, ["h", "c"]).select("doc_id", "th", F.col("first").alias("a"), (F.col("last") + length).alias("b"))
    # one of each different context of a bucket is compared by its bytes
    ones = by_context.where("several")
    per = scratch.keep(ones.groupBy("h").agg(F.count(F.lit(1)).alias("contexts")), "per")
    ones = ones.join(per, "h").select("h", "n", F.col("one").alias("nth"), (F.col("contexts") > wide).alias("wide"))
    picked = occ.select("h", "nth", "doc_id", "th", "first", "last", "lead").join(ones, ["h", "nth"])
    lists = picked.groupBy("doc_id", "th").agg(F.collect_list(F.struct("h", "nth", "n", "wide", "first", "last", "lead")).alias("at"))
    # rows that repeat have one text; any of them gives the bytes
    texts = d.alias("d").join(lists.alias("l"), same_doc("d", "l")).select("d.doc_id", "d.th", "d.text", "l.at")

    def cut(batches):
        for batch in batches:
            for doc, th, text, at in zip(batch.column("doc_id").to_pylist(), batch.column("th").to_pylist(), batch.column("text").cast(pa.binary()), batch.column("at").to_pylist(), strict=True):
                view = memoryview(text.as_buffer())
                yield pa.RecordBatch.from_pydict({"h": [x["h"] for x in at], "nth": [x["nth"] for x in at], "n": [x["n"] for x in at], "wide": [x["wide"] for x in at], "doc_id": pa.array([doc] * len(at), pa.int64()), "th": [th] * len(at), "first": [x["first"] for x in at], "lead": pa.array([x["lead"] for x in at], pa.int32()), "bytes": [bytes(view[x["first"] : x["last"] + length]) for x in at]})

    contexts = scratch.keep(_merged(texts, cut, "h long, nth long, n long, wide boolean, doc_id long, th long, first long, lead int, bytes binary"), "contexts")

    def sort_block(rows: list[tuple]) -> list[tuple]:
        """rows: (doc_id, th, first, n, bytes) of whole buckets."""
        text = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
        counts = np.array([len(r[4]) - length + 1 for r in rows])
        begin = np.concatenate([[0], np.cumsum([len(r[4]) for r in rows])])[:-1]
        before = np.concatenate([[0], np.cumsum(counts)])
        starts = np.repeat(begin, counts) + np.arange(before[-1]) - np.repeat(before[:-1], counts)
        twin = repeated(text, starts, length)
        return [(doc, th, first + a, first + b - 1 + length) for k, (doc, th, first, n, _) in enumerate(rows) if n == 1 for a, b in spans_of(twin[before[k] : before[k + 1]])]

    def suffix_sort(batches):
        rows, last, seen, size = [], None, set(), 0
        for batch in batches:
            for h, nth, n, doc, th, first, b in zip(*[batch.column(c).to_pylist() for c in ("h", "nth", "n", "doc_id", "th", "first", "bytes")], strict=True):
                if h != last:
                    last, seen = h, set()
                    if size >= BLOCK:
                        yield _spans(sort_block(rows))
                        rows, size = [], 0
                if nth in seen:  # a row that repeats
                    continue
                seen.add(nth)
                rows.append((doc, th, first, n, b))
                size += len(b)
        if rows:
            yield _spans(sort_block(rows))

    def block_digests(batches):
        """Blocks are counted from the anchor, so equal strings are in like blocks. A block of which a context
        has only some strings has no union; what all its strings have in common is in any of them."""
        for batch in batches:
            rows = []
            for nth, n, doc, th, first, lead, b in zip(*[batch.column(c).to_pylist() for c in ("nth", "n", "doc_id", "th", "first", "lead", "bytes")], strict=True):
                k = len(b) - length + 1
                for j in range(lead % STEP - STEP if lead % STEP else 0, k, STEP):
                    lo, hi = max(j, 0), min(j + STEP, k)
                    common = np.frombuffer(xxhash.xxh3_128_digest(b[j + STEP - 1 : j + length]), "<i8").tolist()
                    union = np.frombuffer(xxhash.xxh3_128_digest(b[j : j + STEP - 1 + length]), "<i8").tolist() if hi - lo == STEP else [nth, -1 - j]
                    rows.append((*union, *common, nth, n, doc, th, first + lo, hi - lo))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["u0", "u1", "c0", "c1", "nth", "n", "doc_id", "th", "first", "k"])

    def digests(batches):
        for batch in batches:
            for nth, n, doc, th, first, b, at in zip(*[batch.column(c).to_pylist() for c in ("nth", "n", "doc_id", "th", "first", "bytes", "at")], strict=True):
                i = np.concatenate([np.arange(x["first"] - first, x["first"] - first + x["k"]) for x in at])
                x = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b[j : j + length]) for j in i.tolist()), "<i8").reshape(-1, 2)
                k = len(i)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x[:, 0])), pa.array(np.ascontiguousarray(x[:, 1])), pa.array(np.full(k, nth)), pa.array(np.full(k, n)), pa.array([doc] * k, pa.int64()), pa.array(np.full(k, th)), pa.array(first + i)], names=["d0", "d1", "nth", "n", "doc_id", "th", "first"])

    narrow = contexts.where("not wide").select("h", "nth", "n", "doc_id", "th", "first", "bytes").repartition(partitions(spark), "h").sortWithinPartitions("h").mapInArrow(suffix_sort, SPANS)
    wide_ones = contexts.where("wide").select("nth", "n", "doc_id", "th", "first", "lead", "bytes")
    blocks = scratch.keep(_merged(wide_ones, block_digests, "u0 long, u1 long, c0 long, c1 long, nth long, n long, doc_id long, th long, first long, k long"), "blocks")
    unions = scratch.keep(blocks.groupBy("u0", "u1").agg(F.min("nth").alias("ux"), F.max("nth").alias("uy")), "unions")
    common = blocks.groupBy("c0", "c1").agg(F.min("nth").alias("x"), F.max("nth").alias("y")).where("x <> y").select("c0", "c1")
    common = scratch.keep(common, "common")
    again = blocks.join(common, ["c0", "c1"]).join(unions, ["u0", "u1"])
    whole_blocks = again.where("n = 1 and ux <> uy").select("doc_id", "th", F.col("first").alias("a"), (F.col("first") + F.col("k") - 1 + length).alias("b"))
    # of blocks found again as a whole one stands for all
    single = again.where("ux = uy or nth = ux").groupBy("nth").agg(F.collect_set(F.struct("first", "k")).alias("at"))
    big = scratch.keep(_merged(wide_ones.join(single, "nth"), digests, "d0 long, d1 long, nth long, n long, doc_id long, th long, first long"), "wide")
    twins = big.groupBy("d0", "d1").agg(F.min("nth").alias("x"), F.max("nth").alias("y")).where("x <> y").select("d0", "d1")
    twins = scratch.keep(twins, "twins")
    wide_spans = big.where("n = 1").join(twins, ["d0", "d1"]).select("doc_id", "th", F.col("first").alias("a"), (F.col("first") + length).alias("b")).unionByName(whole_blocks)
    return whole.unionByName(narrow).unionByName(wide_spans)


def _merged(df: DataFrame, run, schema: str, rows: int = 20_000) -> DataFrame:
    """mapInArrow whose small output batches are joined to larger ones."""
    names = [c.split()[0] for c in schema.split(", ")]

    def merged(batches):
        held, n, size = [], 0, 0
        for b in run(batches):
            held.append(b.select(names))
            n += b.num_rows
            size += b.nbytes
            if n >= rows or size > 16_000_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n, size = [], 0, 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
        del held
        release()

    return df.mapInArrow(merged, schema)


def merged_spans(spans: DataFrame) -> DataFrame:
    """(doc_id, th, at): each document's spans, sorted, as an array of (a, b)."""
    return spans.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("at"))


def union_spans(at: list, size: int) -> list[tuple[int, int]]:
    """Sorted spans, united where they overlap or touch."""
    out: list[list[int]] = []
    for s in at:
        if out and s["a"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["b"])
        else:
            out.append([s["a"], s["b"]])
    return [(a, min(b, size)) for a, b in out]


def with_spans(docs: DataFrame, lists: DataFrame, *extra: str) -> DataFrame:
    """Every document with its lists of spans (null: none)."""
    found = [f"s.{c}" for c in lists.columns if c not in ("doc_id", "th")]
    return keyed(docs, *extra).alias("d").join(lists.alias("s"), same_doc("d", "s"), "left").select("d.*", *found)


def spans_of_docs(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, wide: int = WIDE) -> DataFrame:
    """``covered``, written; what led to it is dropped."""
    scratch = Scratch(spark, "covered")
    kept = Scratch(spark, "spans").keep(covered(spark, docs, scratch, length, gram, wide), "spans")
    scratch.drop()
    tidy(spark)
    return kept


def cut(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """docs with repeated bytes cut out of text; a character that a cut splits goes whole."""
    spans = spans_of_docs(spark, docs, length, gram)
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "th", "at")]
    x = with_spans(docs, merged_spans(spans), *rest)

    def run(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.binary())
            out = []
            for t, at in zip(text, batch.column("at").to_pylist(), strict=True):
                if not at:
                    out.append(t.as_py().decode())
                    continue
                view, here, kept = memoryview(t.as_buffer()), 0, []
                for a, b in union_spans(at, len(view)):
                    kept.append(bytes(view[here:a]).decode(errors="ignore"))
                    here = b
                kept.append(bytes(view[here:]).decode(errors="ignore"))
                out.append("".join(kept))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string()), *[batch.column(c) for c in rest]], names=["doc_id", "text", *rest])

    return x.mapInArrow(run, docs.select("doc_id", "text", *rest).schema)


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def report(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, wide: int = WIDE) -> DataFrame:
    """n_bytes, n_removed, n_spans and kept_sha256 of each document."""
    lists = merged_spans(spans_of_docs(spark, docs, length, gram, wide))

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text, at in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), batch.column("at").to_pylist(), strict=True):
                view = memoryview(text.as_buffer())
                keep, here, gone = hashlib.sha256(), 0, 0
                cuts = union_spans(at or [], len(view))
                for a, b in cuts:
                    keep.update(view[here:a])
                    here, gone = b, gone + b - a
                keep.update(view[here:])
                rows.append((doc, len(view), gone, len(cuts), keep.hexdigest()))
            if rows:
                doc, n, gone, cuts, sha = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(cuts, pa.int64()), pa.array(sha)], names=[c.split()[0] for c in REPORT.split(", ")])

    return with_spans(docs, lists).select("doc_id", "text", "at").mapInArrow(run, REPORT)
