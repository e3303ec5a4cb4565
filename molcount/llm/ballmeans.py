"""Centroid clustering of integer vectors by balls.

A cluster is a ball: its centroid and its radius, the largest distance of a member. Once centroids have
moved, a member x of cluster c at distance d from c can only have come nearer to a centroid e with
|c - e| <= 2 d. So only clusters within twice the ball's radius are neighbours of c; members within half
the distance of the nearest neighbour are its stable core and keep their cluster without a comparison;
the others lie in annuli between the halves of the neighbours' distances in rising order, and those of
the i-th annulus are compared exactly with the first i neighbours alone. Equality counts as near, as ties go to the smaller number.

The first assignment compares with all centroids. Each round is one pass over the vectors without a
shuffle; it writes the vectors with their clusters and, beside them, a row of sums for each task and
cluster, which alone are read to move the centroids. The driver holds ``K`` centroids and their sums.

Kept are vectors of exactly ``DIM`` components, none null or non-finite; others are in no result. All distances and
sums are exact integers; components beyond 524288 in size count as that. Equal rows are rows of their own. A null vec_id
is assigned as others are, but is no first centroid; of equal hashes the smaller vector comes first. Fewer vectors than centroids make as many
centroids as there are; an empty table gives none. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from molcount.llm.common import Scratch
from molcount.llm.negatives import usable

K, DIM, ROUNDS, SCALE, LIMIT = 40, 64, 5, 256, 524_288.0
BLOCK = 8_192


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows; doubles hold them below 2^53, else long integers are used."""
    if not x.size or not c.size:
        return np.zeros((len(x), len(c)), dtype=np.int64)
    most = float(max(np.abs(x).max(), np.abs(c).max()))
    if 4 * most * most * x.shape[1] < 2**53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - y) ** 2).sum(1) for y in c], axis=1)


class Balls:
    """Centroids with, for each cluster, its neighbours in order of distance."""

    def __init__(self, centers: np.ndarray, radius: np.ndarray | None):
        """radius: no member is farther from its centroid than this; None before the first assignment."""
        self.centers, self.first = centers, radius is None
        self.neighbours: list[np.ndarray] = []
        self.apart: list[np.ndarray] = []
        if radius is not None:
            between = squared(centers, centers)
            for c in range(len(centers)):
                others = np.array([e for e in range(len(centers)) if e != c and between[c, e] <= 4.0 * radius[c] ** 2], dtype=np.int64)
                order = np.argsort(between[c, others], kind="stable")
                self.neighbours.append(others[order])
                self.apart.append(between[c, others][order])

    def assign(self, x: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each row's nearest centroid (ties: the smaller number), its squared distance, and the number of distances taken."""
        if self.first:
            d = squared(x, self.centers)
            near = d.argmin(1)
            return near, d[np.arange(len(x)), near], d.size
        out, dist, taken = cluster.copy(), np.zeros(len(x), dtype=np.int64), len(x)
        for c in np.unique(cluster).tolist():
            rows = np.flatnonzero(cluster == c)
            own = squared(x[rows], self.centers[c : c + 1])[:, 0]
            best, number = own.copy(), np.full(len(rows), c)
            annulus = np.searchsorted(self.apart[c], 4 * own, side="right")  # 0: the stable core
            for i in np.unique(annulus[annulus > 0]).tolist():
                at, near = np.flatnonzero(annulus == i), self.neighbours[c][:i]
                d = squared(x[rows[at]], self.centers[near])
                taken += d.size
                # the least distance, then the least number
                least = d.min(1)
                e = np.where(d == least[:, None], near[None, :], len(self.centers)).min(1)
                better = (least < best[at]) | ((least == best[at]) & (e < number[at]))
                best[at], number[at] = np.where(better, least, best[at]), np.where(better, e, number[at])
            out[rows], dist[rows] = number, best
        return out, dist, taken


_STATE = "vec_id long, ints array<long>, cluster int, distance long, sums array<long>"


def _pass(source: DataFrame, balls: Balls, spark: SparkSession) -> DataFrame:
    """The rows with their new clusters, and for each task and cluster a row: sums, then the count, the summed and the largest distance, and the distances taken."""
    shared = spark.sparkContext.broadcast(balls)  # K centroids and their neighbours

    def run(batches):
        b = shared.value
        k = len(b.centers)
        sums, numbers = np.zeros((k, DIM), dtype=np.int64), np.zeros((k, 4), dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(lo, BLOCK)
                x = np.asarray(piece.column("ints").flatten(), dtype=np.int64).reshape(piece.num_rows, DIM)
                cluster, d, taken = b.assign(x, piece.column("cluster").to_numpy().astype(np.int64))
                np.add.at(sums, cluster, x)
                numbers[:, 0] += np.bincount(cluster, minlength=k)
                np.add.at(numbers[:, 1], cluster, d)
                np.maximum.at(numbers[:, 2], cluster, d)
                numbers[0, 3] += taken
                yield pa.RecordBatch.from_arrays([piece.column("vec_id"), piece.column("ints"), pa.array(cluster, pa.int32()), pa.array(d, pa.int64()), pa.nulls(piece.num_rows, pa.list_(pa.int64()))], names=["vec_id", "ints", "cluster", "distance", "sums"])
        some = np.flatnonzero(numbers.any(1))
        rows = np.concatenate([sums, numbers], axis=1)[some].tolist()
        yield pa.RecordBatch.from_arrays([pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.list_(pa.int64())), pa.array(some, pa.int32()), pa.nulls(len(some), pa.int64()), pa.array(rows, pa.list_(pa.int64()))], names=["vec_id", "ints", "cluster", "distance", "sums"])

    return source.select("vec_id", "ints", "cluster").mapInArrow(run, _STATE)


def _totals(state: DataFrame) -> dict[int, list[int]]:
    """The sums of all tasks by cluster: K rows."""
    at = F.get("sums", F.col("i"))
    x = state.where("sums is not null").select("cluster", "sums", F.explode(F.sequence(F.lit(0), F.lit(DIM + 3))).alias("i"))
    total = F.when(F.col("i") == DIM + 2, F.max(at)).otherwise(F.sum(at)).alias("v")
    out: dict[int, list[int]] = {}
    for r in x.groupBy("cluster", "i").agg(total).collect():
        out.setdefault(r["cluster"], [0] * (DIM + 4))[r["i"]] = r["v"]
    return out


def cluster(spark: SparkSession, vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each kept vector, and compared: the distances taken in all passes."""
    scratch = Scratch(spark, "balls")
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    v = v.where(usable("embedding") & (F.size("embedding") == DIM))
    ints = F.transform("embedding", lambda e: F.floor(F.least(F.greatest(e, F.lit(-LIMIT)), F.lit(LIMIT)) * SCALE).cast("long"))
    state = v.select("vec_id", ints.alias("ints"), F.lit(0).alias("cluster"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    start = state.where("vec_id is not null").select(digest.alias("h"), "ints").orderBy("h", "ints").limit(k).collect()
    if not start:  # no vector that could be a centroid
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, compared long")
    centers, radius, compared = np.array([r["ints"] for r in start], dtype=np.int64), None, 0
    for turn in range(rounds + 1):
        state = scratch.keep(_pass(state.where("ints is not null"), Balls(centers, radius), spark), f"turn-{turn}")
        if turn:
            scratch.drop(f"turn-{turn - 1}")
        totals = _totals(state)
        compared += sum(t[DIM + 3] for t in totals.values())
        if turn == rounds:
            break
        moved = np.array([[s // totals[c][DIM] for s in totals[c][:DIM]] if c in totals and totals[c][DIM] else centers[c].tolist() for c in range(len(centers))], dtype=np.int64)
        # a member was within its ball, and is within the ball widened by its centroid's way; rounded up
        way = np.sqrt(((moved - centers) ** 2).sum(1).astype(np.float64))
        radius = (np.sqrt(np.array([totals[c][DIM + 2] if c in totals else 0 for c in range(len(centers))], dtype=np.float64)) + way) * (1 + 1e-9) + 1e-6
        centers = moved
    inertia = sum(t[DIM + 1] for t in totals.values())
    of = [(c, t[DIM + 1], inertia, hashlib.sha256(",".join(map(str, centers[c].tolist())).encode()).hexdigest(), compared) for c, t in totals.items() if t[DIM]]
    facts = spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, compared long")  # K rows at most
    out = state.where("ints is not null").select("vec_id", "cluster", "distance")
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared")
