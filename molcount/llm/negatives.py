"""Hard negatives by vantage-point trees over norm-augmented vectors.

Vectors are integers, floor(256 x) of each component. An added component sqrt(M - |x|^2), with M the
largest squared norm (0 for an anchor), makes the inner product a falling function of the Euclidean
distance: d^2 = |a|^2 + M - 2 <a, x>. So a window of scores is an annulus around the anchor.

1. Cells. A vantage-point tree over a sample of at most ``2 * SAMPLE`` rows has ``TOP`` leaves at most, its
   cells. Every row goes down that tree to its cell; each cell knows the least and the largest distance of
   all its rows to each vantage point above it. A cell of over ``CELL_MAX`` rows is dealt to parts by hash.
2. Traversal. A task holds one cell's rows under a tree of their own, with buckets of ``BUCKET`` rows. An
   anchor's buckets that meet its annulus are taken nearest first, from the inner radius outwards, until
   the next one is farther than the last of the rows wanted (equal scores go by id, so equal distances
   are still opened).
3. Turns. An anchor asks the ``NEAR`` nearest cells first; what they give narrows the annulus, and then
   it asks all other cells that still meet it. Bounds are exact up to rounding, which a margin covers, so no row is lost.

This is done twice: for the positives (all scores, the same label) and for the negatives (one annulus
for each positive, other labels). An anchor meets cells, not rows: no pairs are formed beside the search.

Rows with a null label, a null vector, or a null or non-finite component take no part. Equal rows (id,
label and vector) count once. Rows that share an id but are unlike are rows of their own, and not "other"
rows of each other. A null id takes part, last among ties, and comes back as null. Vectors of unlike length do not meet. Components
beyond 131072 in size count as that. Other columns are ignored, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from molcount.llm.common import Scratch, partitions

SAMPLE, CELL, CELL_MAX, TOP, BUCKET, NEAR = 20_000, 2_048, 32_768, 1_024, 256, 2
SCALE, LIMIT = 256, 131_072.0
NO_ID = (1 << 63) - 1
_LOW, _HIGH = -(1 << 62), 1 << 62


def usable(col: str) -> F.col:
    """Not null, and no component null or non-finite."""
    return F.coalesce(F.col(col).isNotNull() & F.forall(col, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))), F.lit(False))


def _matrix(col, dim: int) -> np.ndarray:
    """Rows of a list column, all of one length."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(col.flatten(), dtype=np.float64).reshape(len(col), dim)


class Tree:
    """A vantage-point tree; leaves have, for each vantage point above them, the range of their rows' distances to it.

    x: rows with the added component last. ``vantage`` (leaf, level) are row numbers of x, -1 beyond a leaf's depth.
    """

    def __init__(self, x: np.ndarray, leaf: int, depth: int = 64, seed: int = 5):
        self.x, rng = x, np.random.default_rng(seed)
        self.leaves: list[np.ndarray] = []
        paths: list[list[tuple[int, float, float]]] = []
        self.splits: list[tuple[int, float, int, int]] = []  # vantage, radius, near and far child (a leaf: ~number)
        todo = [(np.arange(len(x)), [], -1, 0)]
        while todo:
            rows, above, parent, side = todo.pop()
            above = [(v, *self._range(x, rows, v)) for v in above]
            if len(rows) <= leaf or len(above) >= depth:
                name = ~len(self.leaves)
                self.leaves.append(rows)
                paths.append(above)
            else:
                name = len(self.splits)
                v = self._chosen(rows, rng)
                d = np.linalg.norm(x[rows] - x[v], axis=1)
                order = np.argsort(d, kind="stable")
                half = len(rows) // 2
                self.splits.append((v, float(d[order[half - 1]]), 0, 0))
                up = [a[0] for a in above] + [v]
                todo += [(rows[order[half:]], up, name, 3), (rows[order[:half]], up, name, 2)]
            if parent >= 0:
                s = list(self.splits[parent])
                s[side] = name
                self.splits[parent] = tuple(s)
        self.levels = max(map(len, paths), default=0)
        self.vantage = np.full((len(paths), self.levels), -1)
        self.low, self.high = np.zeros(self.vantage.shape), np.full(self.vantage.shape, np.inf)
        for i, p in enumerate(paths):
            for j, (v, lo, hi) in enumerate(p):
                self.vantage[i, j], self.low[i, j], self.high[i, j] = v, lo, hi

    @staticmethod
    def _range(x: np.ndarray, rows: np.ndarray, v: int) -> tuple[float, float]:
        d = np.linalg.norm(x[rows] - x[v], axis=1)
        return float(d.min()), float(d.max())

    def _chosen(self, rows: np.ndarray, rng) -> int:
        """Of a few rows the one whose distances to others spread most."""
        some, to = rng.choice(rows, min(6, len(rows)), replace=False), rng.choice(rows, min(64, len(rows)), replace=False)
        spread = [np.linalg.norm(self.x[to] - self.x[v], axis=1).std() for v in some]
        return int(some[int(np.argmax(spread))])

    def bounds(self, to_vantage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(queries, leaves): least and largest possible distances; to_vantage: the distance of each query to each row that is a vantage point (queries, levels of leaves)."""
        lo = np.maximum(to_vantage - self.high[None], self.low[None] - to_vantage)
        hi = to_vantage + self.high[None]
        known = (self.vantage >= 0)[None]
        return np.maximum(np.where(known, lo, 0).max(axis=2, initial=0), 0), np.where(known, hi, np.inf).min(axis=2, initial=np.inf)

    def spread(self, distance) -> np.ndarray:
        """(queries, leaves, levels) of distance(row numbers): a column for each vantage point used."""
        used = np.unique(self.vantage[self.vantage >= 0])
        d = distance(used)
        out = np.zeros((d.shape[0], *self.vantage.shape))
        where = np.searchsorted(used, np.maximum(self.vantage, 0)) if len(used) else np.zeros(self.vantage.shape, dtype=int)
        return d[:, np.minimum(where, max(len(used) - 1, 0))] if len(used) else out


def augmented(x: np.ndarray, most: int) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))[:, None]], axis=1)


def radius(norm: np.ndarray, most: int, score) -> np.ndarray:
    """The distance at which a row of a score lies from an anchor of a squared norm."""
    return np.sqrt(np.maximum(norm + most - 2.0 * score, 0))


def first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by falling score, then rising id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


class Cell:
    """The rows of a cell under their tree, and the answer to one anchor's windows.

    Rows stand in order of their leaf and, in it, of their label, so that a leaf is one product and the rows of
    a label are a slice. Products are bounded by the largest squared norm: below 2^53 doubles hold them exactly.
    """

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, most: int):
        self.most, self.tree = most, Tree(augmented(x, most), BUCKET)
        order = np.concatenate([rows[np.argsort(labels[rows], kind="stable")] for rows in self.tree.leaves])
        self.x = x[order] if most < 2**53 else x[order].astype(np.int64)
        self.ids, self.labels, self.vantage_x = ids[order], labels[order], x
        self.cuts = np.cumsum([0, *map(len, self.tree.leaves)]).tolist()
        self.some = set(ids.tolist())
        self.margin = 1e-6 * (1 + 2 * math.sqrt(most))

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        norm = (q * q).sum(1)
        d = self.tree.spread(lambda rows: radius(norm[:, None], self.most, q @ self.vantage_x[rows].T))
        return (norm, *self.tree.bounds(d))

    def eligible(self, leaf: int, q: np.ndarray, own: int, label: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of a leaf's rows of the label, or of other labels, without those of the anchor's own id."""
        lo, hi = self.cuts[leaf], self.cuts[leaf + 1]
        a, z = lo + np.searchsorted(self.labels[lo:hi], (label, label + 1))
        if same:
            s, i = self.x[a:z] @ q, self.ids[a:z]
        else:
            s, i = self.x[lo:hi] @ q, self.ids[lo:hi]
            if a < z:
                s, i = np.concatenate([s[: a - lo], s[z - lo :]]), np.concatenate([i[: a - lo], i[z - lo :]])
        if own in self.some:
            s, i = s[i != own], i[i != own]
        return s, i

    def answer(self, q: np.ndarray, norm: float, own: int, label: int, near: np.ndarray, far: np.ndarray, windows: list[tuple[int, int]], same: bool, k: int) -> list[tuple[int, int, int]]:
        """(window, score, id): for each window the first k rows of the same label, or of others.

        One traversal serves all windows: leaves nearest first, from the innermost radius to the farthest
        distance at which a window can still gain a row.
        """
        q = q.astype(self.x.dtype)
        at = lambda score: math.sqrt(max(norm + self.most - 2.0 * score, 0.0))
        # window: the least score that still counts, the largest, and the rows found
        open_ = [[w, lo, hi, np.empty(0, dtype=self.x.dtype), np.empty(0, dtype=np.int64)] for w, (lo, hi) in enumerate(windows) if lo <= hi]
        if not open_:
            return []
        inner, last = at(float(max(w[2] for w in open_))) - self.margin, at(float(min(w[1] for w in open_))) + self.margin
        meets = np.flatnonzero((near <= last) & (far >= inner))
        for b in meets[np.argsort(near[meets], kind="stable")].tolist():
            if near[b] > last:
                break
            s, i = self.eligible(b, q, own, label, same)
            if not len(s):
                continue
            most, gained = s.max(), False
            for w in open_:
                if most < w[1]:
                    continue
                ok = (s >= w[1]) & (s <= w[2])
                if not ok.any():
                    continue
                s_, i_ = np.concatenate([w[3], s[ok]]), np.concatenate([w[4], i[ok]])
                top = first(s_, i_, k)
                w[3], w[4] = s_[top], i_[top]
                if len(top) == k and w[3][-1] > w[1]:
                    w[1], gained = w[3][-1], True
            if gained:
                last = at(float(min(w[1] for w in open_))) + self.margin
        return [(w[0], int(s), int(i)) for w in open_ for s, i in zip(w[3], w[4], strict=True)]


class Top:
    """The tree of cells of vectors of one length: routes rows, and bounds the distance of anchors to cells."""

    def __init__(self, sample: np.ndarray, cells: int, most: int):
        self.most = most
        depth = max(0, min(math.ceil(math.log2(max(cells, 1))), int(math.log2(max(len(sample), 1) / 8)) if len(sample) >= 16 else 0))
        self.tree = Tree(augmented(sample, most), 1, depth) if len(sample) else None
        self.depth = self.tree.levels if self.tree else 0
        self.parts: dict[int, int] = {}

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's cell, and its distances to the vantage points above it."""
        n = len(x)
        path = np.zeros((n, self.depth))
        if not self.depth:
            return np.zeros(n, dtype=np.int64), path
        y, t = augmented(x, self.most), self.tree
        at, level = np.zeros(n, dtype=np.int64), 0
        while (open_ := np.flatnonzero(at >= 0)).size:
            for node in np.unique(at[open_]).tolist():
                rows = np.flatnonzero(at == node)
                v, r, near, far = t.splits[node]
                d = np.linalg.norm(y[rows] - t.x[v], axis=1)
                path[rows, level] = d
                at[rows] = np.where(d <= r, near, far)
            level += 1
        return ~at, path

    def learn(self, cell: int, n: int, low: list, high: list) -> None:
        """The true ranges of all rows of a cell take the place of the sample's."""
        self.parts[cell] = -(-n // CELL_MAX)
        for j in range(self.depth):
            if self.tree.vantage[cell, j] >= 0:
                self.tree.low[cell, j], self.tree.high[cell, j] = low[j], high[j]

    def slim(self) -> None:
        """Only the vantage points' rows are kept of the sample."""
        if self.tree is None:
            return
        used = np.unique([s[0] for s in self.tree.splits]).astype(int)
        place = {v: i for i, v in enumerate(used.tolist())}
        self.tree.x = self.tree.x[used]
        self.tree.splits = [(place[v], *rest) for v, *rest in self.tree.splits]
        self.tree.vantage = np.array([[place[v] if v >= 0 else -1 for v in row] for row in self.tree.vantage.tolist()], dtype=int).reshape(self.tree.vantage.shape)
        self.tree.leaves = []

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        norm = (q * q).sum(1)
        if not self.depth:
            return norm, np.zeros((len(q), 1)), np.full((len(q), 1), np.inf)
        x = self.tree.x[:, :-1]
        d = self.tree.spread(lambda rows: radius(norm[:, None], self.most, q @ x[rows].T))
        return (norm, *self.tree.bounds(d))


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, label, ints, dim of the rows that take part, equal rows once; every seventh id has the next label."""
    v = vectors.select("vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    v = v.where(F.col("label").isNotNull() & usable("embedding"))
    ints = F.transform("embedding", lambda e: F.floor(F.least(F.greatest(e, F.lit(-LIMIT)), F.lit(LIMIT)) * SCALE).cast("int"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    v = v.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"), label.alias("label"), ints.alias("ints"))
    return v.dropDuplicates(["vec_id", "label", "ints"]).withColumn("dim", F.size("ints"))


def _cells(spark: SparkSession, rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, dict[int, Top]]:
    """Every row with its cell and part, and the tree of each vector length."""
    norm = F.aggregate("ints", F.lit(0).cast("long"), lambda s, e: s + e.cast("long") * e.cast("long"))
    sizes = {r["dim"]: (r["n"], r["most"]) for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("most")).collect()}  # vector lengths
    n = sum(s[0] for s in sizes.values())
    share = min(1.0, SAMPLE / max(n, 1))
    drawn = rows.where(F.pmod(F.xxhash64("ints", "vec_id", F.lit(17)), F.lit(1 << 31)) < int(share * (1 << 31))).select("dim", "ints").limit(2 * SAMPLE).collect()
    tops = {}
    for dim, (count, most) in sizes.items():
        of_dim = [r["ints"] for r in drawn if r["dim"] == dim]
        tops[dim] = Top(np.array(of_dim, dtype=np.float64).reshape(len(of_dim), dim), min(TOP, -(-count // CELL)), most)
    shared = spark.sparkContext.broadcast(tops)

    def place(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            cell, paths = np.zeros(len(dims), dtype=np.int64), [[]] * len(dims)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                cell[at], path = shared.value[dim].route(_matrix(b.column("ints").take(pa.array(at)), dim))
                for i, p in zip(at.tolist(), path.tolist(), strict=True):
                    paths[i] = p
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(paths, pa.list_(pa.float64()))], names=[*b.schema.names, "cell", "path"])

    placed = scratch.keep(rows.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(place, "vec_id long, label long, ints array<int>, dim int, rid long, cell long, path array<double>"), "placed")
    depth = max((t.depth for t in tops.values()), default=0)
    ranges = [f(F.get("path", F.lit(j))).alias(f"{name}{j}") for j in range(depth) for name, f in (("lo", F.min), ("hi", F.max))]
    large = []
    for r in placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), *ranges).collect():  # TOP cells for each length at most
        tops[r["dim"]].learn(r["cell"], r["n"], [r[f"lo{j}"] for j in range(depth)], [r[f"hi{j}"] for j in range(depth)])
        if r["n"] > CELL_MAX:
            large.append((r["dim"], r["cell"], -(-r["n"] // CELL_MAX)))
    shared.unpersist()
    for t in tops.values():
        t.slim()
    parts = spark.createDataFrame(large, "dim int, cell long, parts int")
    placed = placed.join(F.broadcast(parts), ["dim", "cell"], "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("rid"), F.col("parts")), F.lit(0)).cast("int"))
    return placed.select("dim", "cell", "part", "rid", "vec_id", "label", "ints"), tops


_KEY = ["dim", "cell", "part"]
_ROW = "dim int, cell long, part int, visit boolean, rid long, vec_id long, label long, ints array<int>, lo array<long>, hi array<long>"


def _asked(spark, members: DataFrame, anchors: DataFrame, tops, same: bool, k: int, turn: int) -> DataFrame:
    """(rid, w, score, id): what the cells of a turn give to anchors (rid, vec_id, label, dim, ints, lo, hi, floor)."""

    def visits(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                c = pa.RecordBatch.from_arrays([x.take(pa.array(np.flatnonzero(dims == dim))) for x in b.columns], names=b.schema.names)
                top = tops.value[dim]
                norm, near, far = top.bounds(_matrix(c.column("ints"), dim))
                margin = 1e-6 * (1 + 2 * math.sqrt(top.most))
                los, his, floors = (c.column(x).to_pylist() for x in ("lo", "hi", "floor"))
                rows, cells, new = [], [], []
                for i, (lo, hi, floor) in enumerate(zip(los, his, floors, strict=True)):
                    meets = lambda low, i=i, hi=hi: np.any([(near[i] <= radius(norm[i], top.most, float(a)) + margin) & (far[i] >= radius(norm[i], top.most, float(z)) - margin) for a, z in zip(low, hi, strict=True) if a <= z], axis=0) if any(a <= z for a, z in zip(low, hi, strict=True)) else np.zeros(near.shape[1], dtype=bool)
                    at = np.flatnonzero(meets(lo))
                    at = at[np.argsort(near[i][at], kind="stable")]
                    low = [max(a, z) for a, z in zip(lo, floor, strict=True)] if turn else lo
                    if turn:
                        at = at[NEAR:]
                        at = at[meets(low)[at]]
                    else:
                        at = at[:NEAR]
                    rows += [i] * len(at)
                    cells += at.tolist()
                    new += [low] * len(at)
                parts = np.array([top.parts.get(x, 0) for x in cells], dtype=np.int64)
                if not parts.sum():
                    continue
                take = np.repeat(np.arange(len(cells)), parts)
                part = np.concatenate([np.arange(p) for p in parts.tolist()])
                of = pa.array(np.array(rows)[take])
                t = len(take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(t, dim), pa.int32()), pa.array(np.array(cells, dtype=np.int64)[take]), pa.array(part, pa.int32()), pa.array(np.full(t, True)), *(c.column(x).take(of) for x in ("rid", "vec_id", "label", "ints")), pa.array([new[i] for i in take.tolist()], pa.list_(pa.int64())), c.column("hi").take(of)],
                    names=[x.split(" ")[0] for x in _ROW.split(", ")],
                )

    asked = anchors.mapInArrow(visits, _ROW)
    none = F.lit(None).cast("array<long>")
    held = members.select(*_KEY, F.lit(False).alias("visit"), "rid", "vec_id", "label", "ints", none.alias("lo"), none.alias("hi"))
    both = held.unionByName(asked).repartition(partitions(spark), *_KEY).sortWithinPartitions(*_KEY, "visit")

    def run(batches):
        """A cell's rows come before its visits; the rows are held, visits pass by."""
        last, rows, cell = None, [], None
        for b in batches:
            keys = np.stack([np.asarray(b.column(x)) for x in (*_KEY, "visit")], axis=1).astype(np.int64)
            cut = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if lo == hi:
                    continue
                key, visit, piece = tuple(keys[lo][:3].tolist()), bool(keys[lo][3]), b.slice(lo, hi - lo)
                if key != last:
                    last, rows, cell = key, [], None
                if not visit:
                    rows.append(piece.select(["vec_id", "label", "ints"]))
                    continue
                if cell is None:
                    if not rows:
                        continue
                    t = pa.Table.from_batches(rows)
                    rows = []
                    cell = Cell(_matrix(t.column("ints"), key[0]), t.column("vec_id").to_numpy(), t.column("label").to_numpy(), tops.value[key[0]].most)
                q = _matrix(piece.column("ints"), key[0])
                for at in range(0, len(q), 256):
                    norm, near, far = cell.bounds(q[at : at + 256])
                    rid, own, label = (piece.column(x).slice(at, 256).to_pylist() for x in ("rid", "vec_id", "label"))
                    windows = [list(zip(a, z, strict=True)) for a, z in zip(piece.column("lo").slice(at, 256).to_pylist(), piece.column("hi").slice(at, 256).to_pylist(), strict=True)]
                    found = [(rid[i], *f) for i in range(len(rid)) for f in cell.answer(q[at + i], norm[i], own[i], label[i], near[i], far[i], windows[i], same, k)]
                    if found:
                        a, w, s, x = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(w, pa.int32()), pa.array(s, pa.int64()), pa.array(x, pa.int64())], names=["rid", "w", "score", "id"])

    return both.mapInArrow(run, "rid long, w int, score long, id long")


def _searched(spark, members: DataFrame, anchors: DataFrame, tops, same: bool, k: int, scratch: Scratch, name: str) -> DataFrame:
    """(rid, w, score, id, rank): the first k of each window (lo, hi) of the anchors, after both turns."""
    ranked = lambda x: x.withColumn("rank", F.row_number().over(Window.partitionBy("rid", "w").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
    first_ = scratch.keep(ranked(_asked(spark, members, anchors.withColumn("floor", F.col("lo")), tops, same, k, 0)), f"{name}-0")
    kth = first_.where(F.col("rank") == k).groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("kth"))  # a window each
    floor = F.transform("lo", lambda lo, i: F.coalesce(F.try_element_at("kth", i), lo))
    rest = anchors.join(kth, "rid", "left").withColumn("floor", floor).drop("kth")
    more = _asked(spark, members, rest.select(*anchors.columns, "floor"), tops, same, k, 1)
    return scratch.keep(ranked(first_.drop("rank").unionByName(more)), name)


def mine(spark: SparkSession, vectors: DataFrame, every: int = 50, positives: int = 5, k: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors have ids divisible by ``every``. A negative's score is between ``low`` and ``high`` percent of the positive's.
    """
    scratch = Scratch(spark, "negatives")
    rows = scratch.keep(integers(vectors), "rows")
    members, tops = _cells(spark, rows, scratch)
    members = scratch.keep(members, "members")
    scratch.drop("placed")
    shared = spark.sparkContext.broadcast(tops)  # TOP vantage points for each length at most
    anchors = scratch.keep(members.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != NO_ID)).select("rid", "vec_id", "label", "dim", "ints"), "anchors")
    whole = anchors.withColumns({"lo": F.array(F.lit(_LOW)), "hi": F.array(F.lit(_HIGH))})
    pos = _searched(spark, members, whole, shared, True, positives, scratch, "positives").select("rid", F.col("rank").alias("p_rank"), F.col("score").alias("p_score"), F.col("id").alias("p_id"))
    # windows stand in order of the positives; that of a negative score is empty
    lo, hi = F.expr(f"(p_score * {low} + 99) div 100"), F.expr(f"p_score * {high} div 100")
    w = pos.withColumns({"a": F.when(F.col("p_score") < 0, F.lit(1)).otherwise(lo), "z": F.when(F.col("p_score") < 0, F.lit(0)).otherwise(hi)})
    w = w.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("p_rank", "a", "z"))).alias("x"))  # ``positives`` windows at most
    asked = anchors.join(w, "rid").withColumns({"lo": F.transform("x", lambda y: y["a"].cast("long")), "hi": F.transform("x", lambda y: y["z"].cast("long"))}).drop("x")
    neg = _searched(spark, members, asked, shared, False, k, scratch, "negatives")
    out = neg.withColumn("p_rank", F.col("w") + 1).join(pos, ["rid", "p_rank"]).join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
    id_ = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select("anchor_id", id_("p_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), id_("id").alias("negative_id"), F.col("p_score").alias("positive_score"), F.col("score").alias("negative_score"))
