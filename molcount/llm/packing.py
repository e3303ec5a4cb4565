"""Packing of documents into sequences of a fixed length, as a cutting-stock problem.

A document is its ids and an end id. Each run of ``width`` ids is a sequence of its own; what is left
of a document, its rest, is an item. Items of one length are alike, so the problem is of the size of
the length histogram, however many documents there are:

- a linear program chooses how often each pattern (a multiset of lengths that fits a sequence) is
  used, at the padding-inclusive length as cost; a sequence whose length is a power of two has no
  padding. A rest may also go to the lane, where rests stand end to end and are cut at sequence
  borders: that costs its length and ``CUT`` for the cut.
- columns are priced by knapsack dynamic programming over the program's duals; the best patterns of
  each round enter by the simplex rule, until a lower bound is within ``GAP`` or after ``ROUNDS``.
- pattern counts are rounded down, then up by largest fraction where enough items are left; what
  remains is filled best-fit, and the rest goes to the lane. The lane's last, short sequence is cut
  into powers of two.

Documents are ranked within their length, and ranks are mapped to sequences and offsets by a table
with a row for each pattern and length, which is bounded by width alone and is broadcast. Ranks come
from counts by (input partition, length), so a length that very many documents share is never in one
task. Null or empty texts are documents of the end id alone. Documents that repeat are packed each.

Very long texts are cut into as many sequences as they fill. Documents of one length are ranked as they stand in the input's
partitions; equal rows may change places, which changes no padding.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from molcount.llm.common import Scratch
from molcount.llm.encoding import blocks, default_path, encoder

CUT, GAP, ROUNDS = 16.0, 0.001, 700
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def costs(width: int) -> np.ndarray:
    """Padded length of a sequence by its length."""
    c = np.full(width + 1, float(width))
    for k in range(width.bit_length()):
        if 1 << k <= width:
            c[1 << k] = 1 << k
    c[0] = 0
    return c


def knapsack(value: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: most value of items of exactly c in total; last[c]: an item (by index) of that choice."""
    by = np.full(width + 1, -np.inf)
    index = np.zeros(width + 1, dtype=np.int64)
    by[lengths], index[lengths] = value, np.arange(len(lengths))
    best, last = np.full(width + 1, -np.inf), np.zeros(width + 1, dtype=np.int64)
    best[0] = 0
    for c in range(1, width + 1):
        x = best[c - 1 :: -1] + by[1 : c + 1] if c > 1 else best[:1] + by[1:2]
        k = int(x.argmax())
        best[c], last[c] = x[k], index[k + 1]
    return best, last


def patterns(demand: dict[int, int], width: int) -> list[tuple[Counter, float]]:
    """The linear program by column generation: patterns of lengths with their (fractional) counts."""
    lengths = np.array(sorted(demand), dtype=np.int64)
    m = len(lengths)
    if not m:
        return []
    d = np.array([demand[x] for x in lengths.tolist()], dtype=float)
    pay = costs(width)
    inverse, cost, x = np.eye(m), lengths + CUT, d.copy()
    basis: list[Counter | None] = [None] * m  # None: the lane's column of that row
    duals = cost.copy()
    for turn in range(ROUNDS):
        best, last = knapsack(duals, lengths, width)
        with np.errstate(invalid="ignore"):
            gain = best - pay
        gain[0] = -np.inf
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(np.isfinite(best) & (best > 0), pay / best, np.inf)[1:].min()
        total = float(cost @ x)
        if total - float(duals @ d) * min(1.0, ratio) <= GAP * total:
            break
        entered = False
        for c in np.argsort(-gain)[:6].tolist():
            if not gain[c] > 1e-7:
                break
            items, left = Counter(), c
            while left:
                items[int(last[left])] += 1
                left -= int(lengths[last[left]])
            rows, times = np.array(list(items)), np.array(list(items.values()), dtype=float)
            if float(duals[rows] @ times) - pay[c] <= 1e-7:  # no gain after the last pivot
                continue
            column = inverse[:, rows] @ times
            up = column > 1e-9
            if not up.any():
                continue
            step = np.where(up, x / np.where(up, column, 1), np.inf)
            r = int(step.argmin())
            t = step[r]
            x -= t * column
            x[r] = t
            np.maximum(x, 0, out=x)
            row = inverse[r] / column[r]
            inverse -= np.outer(column, row)
            inverse[r] = row
            basis[r], cost[r] = items, pay[c]
            duals = cost @ inverse
            entered = True
        if not entered:
            break
        if turn % 150 == 149:
            duals = cost @ inverse
    return [(Counter({int(lengths[i]): n for i, n in b.items()}), float(v)) for b, v in zip(basis, x, strict=True) if b is not None and v > 1e-9]


def rounded(demand: dict[int, int], width: int) -> tuple[list[tuple[Counter, int]], dict[int, int]]:
    """Whole counts of patterns, and the items that are left for the lane."""
    left = {k: v for k, v in demand.items() if v}
    chosen: list[tuple[Counter, int]] = []
    parts = []
    for p, v in sorted(patterns(left, width), key=lambda y: -y[1]):
        n = min(int(v + 1e-6), *(left[k] // a for k, a in p.items()))
        if n > 0:
            chosen.append((p, n))
            for k, a in p.items():
                left[k] -= n * a
        parts.append((v - int(v + 1e-6), p))
    for _, p in sorted(parts, key=lambda y: -y[0]):
        if all(left[k] >= a for k, a in p.items()):
            chosen.append((p, 1))
            for k, a in p.items():
                left[k] -= a
    # best fit, largest first, over what rounding left: less than one pattern's items for each row
    bins: list[list] = []
    room: dict[int, list[int]] = {}
    for k in sorted(left, reverse=True):
        for _ in range(left[k] if left[k] < 4096 else 0):
            free = next((f for f in range(k, width + 1) if room.get(f)), None)
            if free is None:
                bins.append([k])
                room.setdefault(width - k, []).append(len(bins) - 1)
            else:
                b = room[free].pop()
                bins[b].append(k)
                room.setdefault(free - k, []).append(b)
    pay = costs(width)
    for b in bins:
        if pay[sum(b)] - sum(b) <= CUT * len(b):
            chosen.append((Counter(b), 1))
            for k in b:
                left[k] -= 1
    return chosen, {k: v for k, v in left.items() if v}


def table(demand: dict[int, int], width: int, first: int) -> tuple[dict[int, np.ndarray], int, int, int]:
    """For each length the rows (first rank, sequence, offset, copies; copies 0: the lane, with the first
    place in offset); first: the first sequence id to give out; then the lane's first sequence, its tokens and the next id."""
    chosen, lane = rounded(demand, width)
    rows: dict[int, list] = {k: [] for k in demand}
    used = dict.fromkeys(demand, 0)
    seq = first
    for p, n in chosen:
        at = 0
        for k in sorted(p, reverse=True):
            rows[k].append((used[k], seq, at, p[k]))
            used[k] += n * p[k]
            at += k * p[k]
        seq += n
    place = 0
    for k in sorted(lane, reverse=True):
        rows[k].append((used[k], seq, place, 0))
        place += k * lane[k]
    tail = place % width
    return {k: np.array(v, dtype=np.int64) for k, v in rows.items() if v}, seq, place, seq + place // width + tail.bit_count()


def lane_cuts(at: int, length: int, tokens: int, width: int) -> list[tuple[int, int, int]]:
    """(sequence after the lane's first, offset, length) of the pieces of a rest that lies at ``at`` in the lane."""
    out, full = [], tokens // width
    tail, starts = tokens % width, []
    s = full * width
    for k in range(tail.bit_length() - 1, -1, -1):
        if tail >> k & 1:
            starts.append((s, 1 << k))
            s += 1 << k
    end = at + length
    while at < end:
        if at < full * width:
            seq, lo, size = at // width, at // width * width, width
        else:
            j = next(j for j, (s, z) in enumerate(starts) if s <= at < s + z)
            seq, (lo, size) = full + j, starts[j]
        n = min(end, lo + size) - at
        out.append((seq, at - lo, n))
        at += n
    return out


def encoded(docs: DataFrame, path: str, width: int, end: int) -> DataFrame:
    """A row for each document: its full runs' crcs, its rest's ids, and its numbers among the partition's rows."""

    def run(batches):
        from pyspark import TaskContext

        enc, task = encoder(path), TaskContext.get().partitionId()
        kind = "<u2" if max(enc.size - 1, end) < 1 << 16 else "<u4"
        tail, ranks, runs = np.array([end], dtype="<u4").tobytes(), Counter(), 0
        for batch in batches:
            for b in blocks(batch, ["doc_id", "text"]):
                cols: dict[str, list] = {k: [] for k in ("doc_tokens", "runs_before", "rest", "nth", "crcs", "ids")}
                for x in enc.encode([t or "" for t in b["text"]]):
                    x += tail
                    n = len(x) // 4
                    full, rest = divmod(n, width)
                    cols["doc_tokens"].append(n)
                    cols["runs_before"].append(runs)
                    cols["rest"].append(rest)
                    cols["nth"].append(ranks[rest])
                    cols["crcs"].append([zlib.crc32(x[4 * width * i : 4 * width * (i + 1)]) for i in range(full)])
                    cols["ids"].append(np.frombuffer(x[4 * width * full :], "<u4").astype(kind).tobytes())
                    ranks[rest] += 1
                    runs += full
                yield pa.RecordBatch.from_arrays(
                    [pa.array(b["doc_id"], pa.int64()), pa.array([task] * len(b["doc_id"]), pa.int32()), pa.array(cols["doc_tokens"], pa.int64()), pa.array(cols["runs_before"], pa.int64()), pa.array(cols["rest"], pa.int32()), pa.array(cols["nth"], pa.int64()), pa.array(cols["crcs"], pa.list_(pa.int64())), pa.array(cols["ids"], pa.binary())],
                    names=["doc_id", "task", "doc_tokens", "runs_before", "rest", "nth", "crcs", "ids"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, task int, doc_tokens long, runs_before long, rest int, nth long, crcs array<long>, ids binary")


def pack(spark: SparkSession, docs: DataFrame, width: int = 1024, path: str | None = None, end: int = 0) -> DataFrame:
    """A row for each piece."""
    scratch = Scratch(spark, "pack")
    path = path or default_path()
    rows = scratch.keep(encoded(docs, path, width, end), "encoded")
    # numbers before each input partition: of full runs, and of rests of each length
    counts = rows.groupBy("task", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("crcs")).alias("runs"))
    ahead = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = scratch.keep(counts.withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))), "counts")
    by_task = counts.groupBy("task").agg(F.sum("runs").alias("runs"))
    by_task = by_task.select("task", F.coalesce(F.sum("runs").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("runs_first"))  # a row for each input partition
    demand = {r["rest"]: r["n"] for r in counts.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # fewer rows than width
    runs = counts.agg(F.sum("runs")).first()[0] or 0
    places, lane_first, lane_tokens, _ = table(demand, width, runs)
    shared = spark.sparkContext.broadcast((places, lane_first, lane_tokens))
    x = rows.join(counts.select("task", "rest", "before"), ["task", "rest"]).join(F.broadcast(by_task) if rows.rdd.getNumPartitions() <= 100_000 else by_task, "task")

    def run(batches):
        places, lane_first, lane_tokens = shared.value
        for batch in batches:
            out: list[tuple] = []
            for doc, total, before, first, rest, nth, ahead, crcs, ids in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "runs_before", "runs_first", "rest", "nth", "before", "crcs", "ids")], strict=True):
                out += [(doc, i * width, width, c, total, first + before + i, 0) for i, c in enumerate(crcs)]
                if not rest:
                    continue
                raw = np.frombuffer(ids, "<u2" if len(ids) == 2 * rest else "<u4").astype("<u4").tobytes()
                t, rank, at = places[rest], nth + ahead, len(crcs) * width
                k = int(np.searchsorted(t[:, 0], rank, side="right")) - 1
                lo, seq, off, copies = t[k].tolist()
                if copies:
                    out.append((doc, at, rest, zlib.crc32(raw), total, seq + (rank - lo) // copies, off + (rank - lo) % copies * rest))
                else:
                    done = 0
                    for s, o, n in lane_cuts(off + (rank - lo) * rest, rest, lane_tokens, width):
                        out.append((doc, at + done, n, zlib.crc32(raw[4 * done : 4 * (done + n)]), total, lane_first + s, o))
                        done += n
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=[c.split()[0] for c in PIECES.split(", ")])

    return x.mapInArrow(run, PIECES)
